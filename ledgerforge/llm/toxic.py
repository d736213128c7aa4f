"""Abusive, hateful or sexual language, found as maximum-scoring segments (problem 8).

Words and pairs of words get log-odds with an informative Dirichlet prior: how
often documents labelled bad use them against all other documents, or against
those labelled ok where that says more, the prior being the corpus itself. A list
of plain terms of abuse enters as pseudo-counts beside the labels: texts that the
list says it has seen. Every text, disguises undone, is a sequence of such scores,
less a drift; one linear scan (Ruzzo and Tompa) yields all maximal segments, that
is passages. A passage of score S in a text of n words is significant if its
extreme-value expectation K n exp(-lambda S) is small. K and lambda are read off
the passages of ordinary labelled texts: how many a word holds, and how fast they
get rare with their score. For passages with a listed term n is bounded.

Labels are the only sample: at most ``MOST_LABELS`` of them, by hash, fit the
scores. Counts and prior cover every document, and every document is scored
whole, without a shuffle of texts. Only shares of the labelled texts and of the
corpus count, so scores are alike at every size and at any frequency of abuse.

Defined results: null and empty texts score 0; a document whose labels disagree
counts as bad if most of them are; without labels the list of terms decides;
equal texts score alike.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documented bound of the labelled sample that fits the scores.
MOST_LABELS = 20_000
#: Words that a passage with a listed term is judged over at most.
STRETCH = 40
#: The pseudo-counts of the list: of as many texts as are labelled, but at least so many, these shares of bad and of ordinary ones use a listed term.
LISTED_BAD, LISTED_OK, LEAST_SAMPLE = 0.1, 5e-5, 100
#: The share of the bad texts with a listed term that may be labelled ok by mistake.
LABEL_NOISE = 0.1
#: What calibration begins with: passages in words of ordinary text, and their middle score.
PRIOR_PASSAGES, PRIOR_WORDS, PRIOR_SCORE = 50.0, 50_000.0, 0.28

# Plain terms of abuse, hate and sexual address, Indonesian and English.
TERMS = frozenset(
    """anjing bajingan bangsat bejat bego belatung bercinta berengsek bodoh brengsek bugil dungu goblok jancuk jembut kampret keparat kontol kotoran kuhajar
    laknat lonte memek mesum monyet ngentot ngesex ngewe perek pelacur sinting sialan tai telanjang tolol
    arsehole ass asshole bastard bitch crap cunt dick dickhead dumbass faggot filthy fuck fucking idiot imbecile jerk moron naked nigger nude pig porn pussy
    retard scum scumbag shit slut stupid tits vermin whore""".split()
)
_WORD = re.compile(r"[^\W_]+(?:[@$!*#]+[^\W_]+)*[$@]?|[$@][^\W_]+")
_SPELLED = re.compile(r"(?<![^\W_])[^\W_](?:([.\-_·•'/|+~ ])[^\W_])(?:\1[^\W_]{1,2})+(?![^\W_])")
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff]")
_LEET = str.maketrans("013457@$!8", "oieastasib")
_LEET_DIGITS = str.maketrans("013457@$8", "oieastasb")
_RUN = re.compile(r"([^\W_])\1+")
_TIME = re.compile(r"\[\d\d:\d\d\]")
_CODE = re.compile(r"(?<![^\W_])[a-z]{2,4}-\d{3,}(?![^\W_])")
_LOOKALIKE = str.maketrans("аеорсухіѕԁ", "aeopcyxisd")


def _plain(word: str) -> str:
    """A term as tokens() gives it: stretched letters count once."""
    return _RUN.sub(r"\1", word)


#: The terms, also in the plural and with the Indonesian ending for your.
_PLAIN = frozenset(_plain(t) for t in TERMS) | frozenset(_plain(t) + end for t in TERMS for end in ("s", "mu"))
_BY_SIZE: dict[int, list[str]] = {}
for _t in sorted(_PLAIN):
    _BY_SIZE.setdefault(len(_t), []).append(_t)


@lru_cache(maxsize=100_000)
def _word(w: str) -> str:
    """One word without its disguise: signs and digits for letters, stars for any letter, stretched letters."""
    if w.isdigit():
        return "#"
    if w.isalpha():
        return _RUN.sub(r"\1", w)
    letters = sum(c.isalpha() for c in w)
    if letters < 2 or letters * 2 < len(w):
        return "#"
    if "*" in w or "#" in w or "!" in w:
        w = _RUN.sub(r"\1", w)
        mask = re.compile("".join("." if c in "*#" else "[il]" if c == "!" else re.escape(c) for c in w.translate(_LEET_DIGITS)))
        for t in _BY_SIZE.get(len(w), ()):
            if mask.fullmatch(t):
                return t
    return _RUN.sub(r"\1", re.sub(r"[*#]", "", w.translate(_LEET)))


def tokens(text: str) -> list[str]:
    """Words in lower case with disguises undone: hidden marks, spelled-out and stretched words, digits and signs for letters, look-alike letters.

    Numbers become ``#``.
    """
    s = _HIDDEN.sub("", unicodedata.normalize("NFKC", text)).lower()
    if not s.isascii():
        s = "".join(c for c in unicodedata.normalize("NFD", s.translate(_LOOKALIKE)) if not unicodedata.combining(c))
    s = _SPELLED.sub(lambda m: m[0].replace(m[1], "") if any(c.isalpha() for c in m[0]) else m[0], _CODE.sub(" 0 ", _TIME.sub(" ", s)))
    return [_word(w) for w in _WORD.findall(s)]


def grams(words: list[str]) -> list[str]:
    """Words and pairs of neighbouring words, numbers left out."""
    return [w for w in words if w != "#"] + [f"{a} {b}" for a, b in zip(words, words[1:]) if a != "#" and b != "#"]


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal scoring segments, in linear time (Ruzzo and Tompa)."""
    found: list[list[float]] = []  # left sum, right sum, start, end
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        own = [total, total + s, i, i + 1]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= own[0]:
                j -= 1
            if j < 0 or found[j][1] >= own[1]:
                found.append(own)
                break
            own = [found[j][0], own[1], found[j][2], own[3]]
            del found[j:]
    return [(int(a), int(b), r - l) for l, r, a, b in found]


def word_scores(words: list[str], table: dict[str, float], drift: float) -> list[float]:
    """The score of each word: the best of its own and of the pairs that it ends or begins, less the drift."""
    n = len(words)
    own = [table.get(w, 0.0) for w in words]
    pair = [table.get(f"{a} {b}", 0.0) for a, b in zip(words, words[1:])]
    return [max(own[i], pair[i - 1] if i else 0.0, pair[i] if i < n - 1 else 0.0) - drift for i in range(n)]


def score_text(text: str | None, table: dict[str, float], drift: float, decay: float, k: float) -> tuple[float, int, float, str]:
    """(score, words, expectation, passage) of the passage that chance explains least.

    A passage is judged over the whole text, but one that holds a listed term that the labels let stand over ``STRETCH`` words
    at most: a plain insult does not become chance because much other text surrounds it.
    """
    words = tokens(text or "")
    n = max(len(words), 1)
    best = (0.0, len(words), float(n), "")
    for a, b, s in segments(word_scores(words, table, drift)):
        if s <= best[0] and best[2] <= k * min(n, STRETCH) * math.exp(-decay * s):
            continue
        passage = words[a:b]
        listed = any(w in _PLAIN and w in table for w in passage)
        found = (s, len(words), k * (min(n, STRETCH) if listed else n) * math.exp(-decay * s), " ".join(passage))
        if not best[3] or (found[2], -s) < (best[2], -best[0]):
            best = found
    return best


def bad_documents(labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """(doc_id, bad) of the labelled sample: bad if most labels say so, half being enough."""
    lab = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.avg(F.when(F.lower(F.trim("label")) == "ok", 0.0).otherwise(1.0)).alias("r"))
    return lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", (F.col("r") >= 0.5).alias("bad"))


def fit(docs: DataFrame, labels: DataFrame, strength: float = 10.0, least: int = 3, drift: float = 2.0, top: float = 6.0, certainty: float = 1.6) -> tuple[dict[str, float], float, float, float]:
    """(scores of words and pairs, drift, lambda, K).

    strength: documents that the prior is worth; least: bad documents that must use a word; top: the largest score;
    certainty: standard errors that a learned score is lowered by. Each distinct labelled text counts once, so neither
    copies nor the share of bad documents unlist a term.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: list[Counter[str]] = [Counter(), Counter(), Counter(), Counter()]
        for pdf in batches:
            for t, is_bad, half in zip(pdf["text"], pdf["bad"], pdf["half"]):
                seen[2 * int(half) + (not is_bad)].update(set(grams(tokens(t))))
        yield pd.DataFrame([(g, *(c[g] for c in seen)) for g in set().union(*seen)], columns=["gram", "bad0", "ok0", "bad1", "ok1"])

    # copies of a text are one labelled text: bad if most of its labels say so
    sample = docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").isNotNull().alias("full")).where("full").join(F.broadcast(bad_documents(labels)), "doc_id")
    once = sample.groupBy("h").agg(F.min("doc_id").alias("doc_id"), (F.avg(F.col("bad").cast("int")) >= 0.5).alias("bad")).select("doc_id", "bad").collect()
    # half of the labelled texts, by hash, calibrates what the other half has taught
    half = {r.doc_id: xxhash.xxh64_intdigest(str(r.doc_id)) % 2 for r in once}
    size = [sum(r.bad == bad and half[r.doc_id] == h for r in once) for h in (0, 1) for bad in (True, False)]
    counts: dict[str, tuple[int, int, int, int]] = {}
    marked: DataFrame | None = None
    if once:
        chosen = docs.sparkSession.createDataFrame([(r.doc_id, r.bad, half[r.doc_id]) for r in once], "doc_id bigint, bad boolean, half int")
        marked = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select("text", "bad", "half")
        each = ("bad0", "ok0", "bad1", "ok1")
        summed = marked.mapInPandas(count, "gram string, " + ", ".join(f"{c} long" for c in each)).groupBy("gram").agg(*[F.sum(c).alias(c) for c in each])
        counts = {r[0]: tuple(r)[1:] for r in summed.where((F.col("bad0") + F.col("bad1") >= least) | F.col("gram").isin(*_PLAIN)).collect()}
    wanted = frozenset(g for g, n in counts.items() if n[0] + n[2] >= least) | _PLAIN

    def count_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs_with: Counter[str] = Counter()
        times: Counter[str] = Counter()
        n = words = 0
        for pdf in batches:
            for t in pdf["text"]:
                ws = tokens(t)
                g = [x for x in grams(ws) if x in wanted]
                docs_with.update(set(g))
                times.update(g)
                n, words = n + 1, words + len(ws)
        rows = [(g, k, times[g]) for g, k in docs_with.items()] + [(None, n, words)]
        yield pd.DataFrame(rows, columns=["gram", "n", "times"])

    total = {r[0]: (r[1], r[2]) for r in docs.select("text").where("text is not null").mapInPandas(count_all, "gram string, n long, times long").groupBy("gram").agg(F.sum("n"), F.sum("times")).collect()}
    n_docs, n_words = total.get(None, (0, 0))

    def scores(bad: list[int], ok: list[int], fewest: int) -> dict[str, float]:
        """The table that the halves at these positions teach."""
        n_bad, n_ok = sum(size[i] for i in bad), sum(size[i] for i in ok)
        table: dict[str, float] = {}
        for g in wanted:
            k, _ = total.get(g, (0, 0))
            share = (k + 0.5) / (n_docs + 1.0)
            n = counts.get(g, (0, 0, 0, 0))
            b, o = sum(n[i] for i in bad), sum(n[i] for i in ok)
            if g in _PLAIN:
                best = listed_score(b, n_bad, max(0.0, o - LABEL_NOISE * b), n_ok)
            elif b < fewest:
                continue
            else:
                up = (b + strength * share) / (n_bad + strength)
                best = 0.0
                # unlabelled bad documents are among the others, but not among the ok ones
                for rest, n_rest in ((max(k - b, 0), max(n_docs - n_bad, 0)), (o, n_ok)):
                    down = (rest + strength * share) / (n_rest + strength)
                    spread = math.sqrt(1.0 / (b + strength * share) + 1.0 / (rest + strength * share))
                    best = max(best, math.log(up / down) - certainty * spread)
            if best > drift:
                table[g] = min(best, top)
        return table

    halves = [scores([2 * h], [2 * h + 1], max(1, (least + 1) // 2)) for h in (0, 1)]
    return scores([0, 2], [1, 3], least), drift, *_calibrate(marked, halves, drift)


def _calibrate(marked: DataFrame | None, tables: list[dict[str, float]], drift: float) -> tuple[float, float]:
    """(lambda, K) of the passages that the table of one half of the labelled texts finds in the ordinary ones of the other.

    Scores above 0 thin out by half within their median, a word begins K of them. The median doesn't mind the few bad
    texts that are labelled ok. Beside the texts stand the prior's passages.
    """
    rows: list = []
    if marked is not None:

        def passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found: Counter[float] = Counter()
            n = 0
            for pdf in batches:
                for t, half in zip(pdf["text"], pdf["half"]):
                    ws = tokens(t)
                    n += len(ws)
                    found.update(round(s, 2) for *_, s in segments(word_scores(ws, tables[1 - int(half)], drift)))
            yield pd.DataFrame([(s, k) for s, k in found.items()] + [(-1.0, n)], columns=["score", "n"])

        # scores are rounded to hundredths: what comes back is bounded by their range
        rows = marked.where("not bad").select("text", "half").mapInPandas(passages, "score double, n long").groupBy("score").agg(F.sum("n").alias("n")).collect()
    words = sum(r.n for r in rows if r.score < 0)
    seen = sorted([(r.score, r.n) for r in rows if r.score >= 0] + [(PRIOR_SCORE, PRIOR_PASSAGES)])
    total, upto, half = sum(n for _, n in seen), 0.0, PRIOR_SCORE
    for half, n in seen:
        upto += n
        if upto * 2 >= total:
            break
    return math.log(2) / max(half, 0.01), total / (PRIOR_WORDS + words)


def listed_score(b: float, n_bad: int, ok: float, n_ok: int) -> float:
    """The log-odds of a listed term in b of n_bad bad and ok of n_ok ordinary labelled texts, its list being worth as many texts again.

    Of those the list says ``LISTED_BAD`` and ``LISTED_OK`` to use it. Shares decide: neither the size of the sample, beyond
    ``LEAST_SAMPLE``, nor how often the corpus uses the term, nor copies change its score.
    """
    m, n = max(n_bad, LEAST_SAMPLE), max(n_ok, LEAST_SAMPLE)
    return math.log((b + LISTED_BAD * m) / (n_bad + m)) - math.log((ok + LISTED_OK * n) / (n_ok + n))


def score_documents(docs: DataFrame, table: dict[str, float], drift: float, decay: float, k: float) -> DataFrame:
    """(doc_id, source, score, n_words, expectation, passage): expectation is the number of such passages that chance would give."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, src, t in zip(pdf["doc_id"], pdf["source"], pdf["text"]):
                rows.append((i, src, *score_text(t, table, drift, decay, k)))
            yield pd.DataFrame(rows, columns=["doc_id", "source", "score", "n_words", "expectation", "passage"])

    return docs.select("doc_id", "source", "text").mapInPandas(run, "doc_id bigint, source string, score double, n_words int, expectation double, passage string")
