"""Evaluation texts that leak into training texts (problem 6).

Every window of ``window`` words of every item gets a SimHash, its words
weighted by rarity among the items. A document's windows are looked up in a
multi-index: the 64 bits are cut into radius + 1 blocks, so two fingerprints
within the radius agree on one block at least, and no window within the radius
is missed. A hit proposes where the item would lie in the document; the exact
similarity of the aligned words, weighted, over every stretch of twelve decides.

Windows of five are not all: twelve words of which two are changed hold four
unchanged ones in a row, not always five. So every run of as many words as a
stretch is sure to hold proposes too, words with misread or changed letters
standing for the item's word: nothing that the check would accept on aligned
words is left out for want of a proposal.

The items are a fixed, checked number and go to every task; documents are read
once, whole, and never shuffled.

Defined results: null or empty texts and items yield nothing; an item of fewer
than twelve words must be repeated whole; a document that holds an item twice,
or equal items, gives one row a document and item.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.names import MISREAD, edit

MOST_ITEMS = 20_000
#: Item words up to so many letters are looked up by what is left of them without two letters, longer ones are compared with all of their length.
MOST_LETTERS = 24

_WORD = re.compile(r"[^\W_]+")
_GROUP = re.compile(r"(?<=\d)[.,'/-](?=\d)")
_LETTERS = re.compile(r"[a-z]")
#: Letters that stand where a misread digit or letter stood, folded alike.
_FOLD = str.maketrans("0145689dfiq", "oiasgbgoelo")


def words_of(text: str) -> list[str]:
    """Words in lower case; numbers and dates without marks inside; digits inside words read as letters."""
    out = []
    for w in _WORD.findall(_GROUP.sub("", text.lower())):
        if w.isdigit() or w.isalpha():
            out.append(w)
        elif w.isascii() and _LETTERS.search(w) and sum(c.isdigit() for c in w) * 2 <= len(w):
            out.append(w.upper().translate(MISREAD).lower())
        else:
            out.append(w)
    return out


_BITS = np.arange(64, dtype=np.uint64)


def word_signs(words: list[str]) -> np.ndarray:
    """+1 or -1 for each of 64 bits of each word's hash."""
    h = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)
    return (((h[:, None] >> _BITS) & np.uint64(1)).astype(np.int8) * 2 - 1).astype(np.int16)


def fingerprints(ids: np.ndarray, signs: np.ndarray, window: int) -> np.ndarray:
    """SimHashes of all windows of ``ids``, rows of weighted ``signs``."""
    n = len(ids) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for a in range(0, n, 65_536):
        b = min(n, a + 65_536)
        total = signs[ids[a:b]].copy()
        for j in range(1, window):
            total += signs[ids[a + j : b + j]]
        out[a:b] = np.packbits(total > 0, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


class Index:
    """Fingerprints of all item windows by block."""

    def __init__(self, items: list[tuple[int, str]], window: int, radius: int, stretch: int, most_changed: int, least_weight: float = 0.65) -> None:
        self.window, self.radius, self.stretch, self.changed, self.least = window, radius, stretch, most_changed, least_weight
        self.items = [(i, words_of(t)) for i, t in items if t]
        self.items = [(i, w) for i, w in self.items if w]
        seen = Counter(w for _, ws in self.items for w in set(ws))
        self.rare = {w: max(1, round(4 * math.log((1 + len(self.items)) / n))) for w, n in seen.items()}
        self.other = max(1, round(4 * math.log(1 + len(self.items))))
        self.vocabulary = {w: k for k, w in enumerate(sorted(seen))}
        signs = word_signs(list(self.vocabulary)) if seen else np.zeros((0, 64), dtype=np.int16)
        self.signs = signs * np.array([self.rare[w] for w in self.vocabulary], dtype=np.int16)[:, None] if seen else signs
        prints, item, at = [], [], []
        self.coded = []
        for k, (_, ws) in enumerate(self.items):
            ids = np.array([self.vocabulary[w] for w in ws])
            self.coded.append(ids)
            f = fingerprints(ids, self.signs, min(window, len(ids)))
            prints.append(f)
            item.append(np.full(len(f), k))
            at.append(np.arange(len(f)))
        self.prints = np.concatenate(prints) if prints else np.zeros(0, dtype=np.uint64)
        self.item = np.concatenate(item) if item else np.zeros(0, dtype=np.int64)
        self.at = np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
        blocks = radius + 1
        width = 64 // blocks
        self.blocks = [(np.uint64(width * b), np.uint64((1 << (width if b < blocks - 1 else 64 - width * b)) - 1)) for b in range(blocks)]
        self.tables = []
        for shift, mask in self.blocks:
            key = (self.prints >> shift) & mask
            order = np.argsort(key, kind="stable")
            self.tables.append((key[order], order))
        self._seeds()

    def _seeds(self) -> None:
        """What ``runs`` reads: pairs of neighbouring words of all items, and the item words by what is left without one or two letters."""
        size = np.array([len(c) for c in self.coded], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(size))) if len(size) else np.zeros(1, dtype=np.int64)
        self.owner = np.repeat(np.arange(len(size)), size)
        flat = np.concatenate(self.coded) if len(size) else np.zeros(0, dtype=np.int64)
        need = np.minimum(size, self.stretch)
        changed = self.changed * need // 12
        #: Equal words in a row that any accepted stretch of the item holds; pairs are the least that is looked up.
        self.run = np.maximum(2, -((changed - need) // (changed + 1)))
        inside = np.flatnonzero(self.owner[1:] == self.owner[:-1])
        key = flat[inside] * len(self.vocabulary) + flat[inside + 1]
        order = np.argsort(key, kind="stable")
        self.pairs, self.pair_at = key[order], inside[order]
        self.near: dict[str, tuple[int, ...]] = {}
        self.without: dict[str, list[str]] = {}
        self.wide: dict[int, list[str]] = {}
        for w in self.vocabulary:
            if len(w) > MOST_LETTERS:
                self.wide.setdefault(len(w), []).append(w)
            elif len(w) >= 3:
                for x in _without(w.translate(_FOLD), 1 if len(w) < 8 else 2):
                    self.without.setdefault(x, []).append(w)

    def codes(self, word: str) -> tuple[int, ...]:
        """The item words that a word of a document may stand for: itself and all that are alike."""
        got = self.near.get(word)
        if got is None:
            other: set[str] = {word} & self.vocabulary.keys()
            if len(word) >= 4:
                for n in (len(word) - 1, len(word), len(word) + 1):
                    other.update(w for w in self.wide.get(n, ()) if _alike(word, w))
                if len(word) <= MOST_LETTERS + 1:
                    near = {w for x in _without(word.translate(_FOLD), 1 if len(word) < 7 else 2) for w in self.without.get(x, ())}
                    other.update(w for w in near if _alike(word, w))
            if len(self.near) >= 300_000:
                self.near.clear()
            got = self.near[word] = tuple(sorted(self.vocabulary[w] for w in other))
        return got

    def runs(self, ids: np.ndarray, unique: list[str], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, item word) where runs of alike words begin that are long enough to propose a place; ids: positions in ``unique``."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if len(ids) < 2 or not len(self.pairs):
            return none
        codes = [self.codes(w) for w in unique]
        count = np.array([len(c) for c in codes])
        begin = np.concatenate(([0], np.cumsum(count)[:-1]))
        flat = np.array([c for cs in codes for c in cs], dtype=np.int64)
        p = np.flatnonzero((count[ids[:-1]] > 0) & (count[ids[1:]] > 0) & (owner[:-1] == owner[1:]))
        a, b = ids[p], ids[p + 1]
        n = count[a] * count[b]
        which = np.repeat(np.arange(len(p)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key = flat[begin[a[which]] + k // count[b[which]]] * len(self.vocabulary) + flat[begin[b[which]] + k % count[b[which]]]
        lo, hi = np.searchsorted(self.pairs, key, "left"), np.searchsorted(self.pairs, key, "right")
        n = hi - lo
        q = self.pair_at[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        total = len(self.owner)
        at = np.unique(np.repeat(p[which], n) * total + q)  # pairs of one diagonal follow at total + 1
        there = lambda x: at[np.minimum(np.searchsorted(at, x), len(at) - 1)] == x
        if not len(at):
            return none
        enough, ahead = np.ones(len(at), dtype=bool), np.ones(len(at), dtype=bool)
        run = self.run[self.owner[at % total]]
        for m in range(1, int(run.max()) - 1):
            ahead &= there(at + m * (total + 1))
            enough &= ahead | (run - 1 <= m)
        at = at[enough]
        if not len(at):
            return none
        at = at[~there(at - (total + 1))]  # the first of each run
        return at // total, at % total

    def hits(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(i, j) of all pairs of a fingerprint and an item window within the radius."""
        if not len(self.prints) or not len(prints):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        a, b = [], []
        for (shift, mask), (keys, order) in zip(self.blocks, self.tables):
            key = (prints >> shift) & mask
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            n = hi - lo
            i = np.repeat(np.arange(len(prints)), n)
            j = order[np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())] if n.sum() else np.zeros(0, dtype=np.int64)
            near = np.bitwise_count(prints[i] ^ self.prints[j]) <= self.radius
            a.append(i[near])
            b.append(j[near])
        pair = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
        return pair[:, 0], pair[:, 1]

    def holds(self, words: list[str], k: int, at: set[tuple[int, int]]) -> bool:
        """Whether the words repeat item k in a row near one of the proposed places (document, item)."""
        item = self.items[k][1]
        need = min(self.stretch, len(item))
        for d in sorted({i - j for i, j in at}):
            lo, hi = max(0, -d), min(len(item), len(words) - d)
            if hi - lo < need:
                continue
            same = np.fromiter((_alike(words[p + d], item[p]) for p in range(lo, hi)), dtype=bool, count=hi - lo)
            if self._long(same, item, lo, need):
                return True
        for i, j in sorted(at):
            if self._aligned(words, item, i, j, need):
                return True
        return False

    def _long(self, same: np.ndarray, item: list[str], lo: int, need: int) -> bool:
        total = np.concatenate(([0], np.cumsum(same)))
        good = np.flatnonzero(total[need:] - total[:-need] >= need - self.changed * need // 12)
        if not len(good):
            return False
        weight = np.array([self.rare[w] for w in item[lo : lo + len(same)]], dtype=float)
        w, m = np.concatenate(([0], np.cumsum(weight))), np.concatenate(([0], np.cumsum(weight * same)))
        return bool(np.any((m[good + need] - m[good]) >= self.least * (w[good + need] - w[good])))

    def _aligned(self, words: list[str], item: list[str], i: int, j: int, need: int) -> bool:
        """A walk from a hit both ways, past changed, added, lost, cut or misread words; any stretch of it counts that begins and ends with a word found."""
        back, ahead = self._walk(words[:i][::-1], item[:j][::-1], True), self._walk(words[i:], item[j:], False)
        steps = [*reversed(back), *ahead]
        found = np.flatnonzero([x[1] == 0 for x in steps])
        if not len(found):
            return False
        n, lost, got, all_ = np.concatenate((np.zeros((4, 1)), np.cumsum(np.array(steps, dtype=float).T, axis=1)), axis=1)
        if n[-1] < need:
            return False
        span = lambda x: x[found + 1][None, :] - x[found][:, None]
        passed = span(n)
        return bool(np.any((passed >= need) & (span(lost) * 12 <= self.changed * passed) & (span(got) >= 1.15 * self.least * span(all_))))

    def _walk(self, a: list[str], b: list[str], reverse: bool) -> list[tuple[int, int, float, float]]:
        """(item words passed, words changed, weight matched, weight passed) of each step; 0 words changed: the word was found."""
        p = q = 0
        steps: list[tuple[int, int, float, float]] = []
        weight = lambda m: float(sum(self.rare.get(w, 1) for w in b[q : q + m]))
        while q < len(b) and p < len(a):
            w = weight(1)
            if _alike(a[p], b[q]):
                steps.append((1, 0, w, w))
                p, q = p + 1, q + 1
                continue
            joined = a[p + 1] + a[p] if reverse and p + 1 < len(a) else a[p] + a[p + 1] if p + 1 < len(a) else ""
            if joined and _alike(joined, b[q]):
                steps.append((1, 0, w, w))
                p, q = p + 2, q + 1
                continue
            glued = b[q + 1] + b[q] if reverse and q + 1 < len(b) else b[q] + b[q + 1] if q + 1 < len(b) else ""
            if glued and _alike(a[p], glued):
                steps.append((2, 0, weight(2), weight(2)))
                p, q = p + 1, q + 2
                continue
            for x, y in _PAST:
                if p + x < len(a) and q + y < len(b) and _alike(a[p + x], b[q + y]):
                    steps.append((y, max(x, y), 0.0, weight(y)))
                    p, q = p + x, q + y
                    break
            else:
                break
        return steps


#: Words of the document and of the item that are passed where neither is found: one changed, added or lost, then two of them.
_PAST = ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (2, 0), (0, 2))


def _without(word: str, most: int) -> set[str]:
    """The word and what is left of it without up to ``most`` letters."""
    out = last = {word}
    for _ in range(most):
        last = {w[:k] + w[k + 1 :] for w in last for k in range(len(w))}
        out = out | last
    return out


def _alike(a: str, b: str) -> bool:
    return a == b or _misread(a, b)


@lru_cache(maxsize=200_000)
def _misread(a: str, b: str) -> bool:
    if len(a) < 4 or abs(len(a) - len(b)) > 1 or (a.isdigit() and b.isdigit()):
        return False
    x, y = a.translate(_FOLD), b.translate(_FOLD)
    return x == y or edit(x, y, 1 if len(b) < 8 else 2) <= (1 if len(b) < 8 else 2)


def find_leaks(docs: DataFrame, items: list[tuple[int, str]], id_col: str = "doc_id", text_col: str = "text", window: int = 5, radius: int = 3, stretch: int = 12, most_changed: int = 2, least_weight: float = 0.65) -> DataFrame:
    """(doc_id, item_id) of all documents that repeat at least ``stretch`` words of an item in a row.

    most_changed: of twelve words in a row so many may be changed at most; least_weight: the share of their
    weight (rarity) that must be equal.
    """
    if len(items) > MOST_ITEMS:
        raise ValueError(f"more than {MOST_ITEMS} items; split them into several runs")
    args = (items, window, radius, stretch, most_changed, least_weight)
    made: list[Index] = []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not made:
            made.append(Index(*args))
        index = made[0]
        for pdf in batches:
            ids, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
            for a, b in portions([len(t) for t in texts]):
                yield scan(ids[a:b], texts[a:b], index)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null").mapInPandas(run, "doc_id bigint, item_id bigint")


def portions(sizes: list[int], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Runs of neighbours of about ``most`` characters: what is worked on at once is bounded, but for one text longer than that."""
    a = total = 0
    for i, n in enumerate(sizes):
        if i > a and total + n > most:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def scan(ids: list[int], texts: list[str], index: Index) -> pd.DataFrame:
    """Leaks of some documents: their windows are hashed together, those across two documents dropped."""
    words = [words_of(t) for t in texts]
    flat = [w for ws in words for w in ws]
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    start = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    out: list[tuple[int, int]] = []
    if len(flat) >= index.window and len(index.prints):
        codes, unique = pd.factorize(np.array(flat, dtype=object))
        weight = np.array([index.rare.get(w, index.other) for w in unique], dtype=np.int16)
        prints = fingerprints(codes, word_signs(list(unique)) * weight[:, None], index.window)
        whole = owner[: len(prints)] == owner[index.window - 1 :]
        at = np.flatnonzero(whole)
        i, j = index.hits(prints[at])
        i, j = at[i], index.first[index.item[j]] + index.at[j]
        more, item_at = index.runs(codes, list(unique), owner)
        i, j = np.concatenate((i, more)), np.concatenate((j, item_at))
        places: dict[tuple[int, int], set[tuple[int, int]]] = {}
        for d, p, k, q in zip(owner[i].tolist(), (i - start[owner[i]]).tolist(), index.owner[j].tolist(), (j - index.first[index.owner[j]]).tolist()):
            places.setdefault((d, k), set()).add((p, q))
        out += [(ids[d], index.items[k][0]) for (d, k), places_ in places.items() if index.holds(words[d], k, places_)]
    # items shorter than a window can only be repeated whole
    for k, (item_id, item) in enumerate(index.items):
        if len(item) < index.window:
            out += [(ids[d], item_id) for d, ws in enumerate(words) if any(ws[p : p + len(item)] == item for p in range(len(ws) - len(item) + 1))]
    return pd.DataFrame(sorted(set(out)), columns=["doc_id", "item_id"]).astype("int64")
