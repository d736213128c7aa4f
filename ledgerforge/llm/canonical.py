"""Mapping free-entered values to a canonical list (problem 2).

A multi-pattern automaton over canonical names and aliases finds every mention
embedded in a value; mentions that overlap are settled by length, the longest
first. A value with mentions of exactly one entry is that entry's. Values
without a mention go to token-set similarity: the set of a value's words against
the sets of the entries that an inverted index on words, words with a slip and
beginnings of words proposes, so a value meets the few entries that share a word
with it and not the list. What stays unmatched, or is as similar to two entries,
is reported with an empty key.

Only distinct values are mapped, so the shuffle is one pre-aggregated distinct;
the list is collected once and sent to the executors, behind a check of its
size. Defined results: null and blank values are no rows; values equal but for
case or blanks are different rows, as stored; an empty list maps all to ''.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.names import MISREAD, Name, edit, fold, lines_agree, read_name, slips, swapped, token_set_similarity

#: The largest canonical list that is sent to every executor; a larger one must be joined.
MOST_ENTRIES = 50_000

#: Two names are one if every word has a partner that is at most one slip away: 0.8, two words of which one has a slip being 0.9.
LEAST_SIMILAR = 0.8

#: Spellings of units besides those of the list itself.
UNIT_ALIASES = {
    "PCS": "PCS PC PIECE PIECES EACH EA BUAH BH BIJI BJ",
    "CTN": "CTN CARTON CARTOON KARTON KARTOON KRT KTN KAR CAR CASE DUS DOS KARDUS",
    "BOX": "BOX BX KOTAK KTK",
    "PAK": "PAK PACK PCK PK PKT BKS BUNGKUS PACKET",
    "LSN": "LSN LUSIN DOZEN DOZ DZ",
    "GRS": "GRS GROS GROSS",
    "KODI": "KODI KD SCORE",
    "GR": "G GR GRM GRAM",
    "ONS": "ONS ONZ HECTOGRAM",
    "KG": "KG KGS KILO KILOGRAM",
    "KW": "KW KWT KWINTAL KUINTAL QUINTAL",
    "TON": "TON TONNE",
    "ML": "ML CC MILILITER MILLILITRE",
    "LTR": "L LT LTR LITER LITRE LITTER",
    "BTL": "BTL BOTOL BOTTLE",
    "KLG": "KLG KALENG CAN TIN",
    "SAK": "SAK ZAK SACK BAG",
    "JRG": "JRG JRGN JERIGEN JERIKEN JERRYCAN",
    "ROLL": "ROLL ROLLS ROL GULUNG",
    "SET": "SET",
    "BAL": "BAL BALL BALE",
    "TRAY": "TRAY BAKI",
    "RCG": "RCG RENCENG RENTENG",
    "PLT": "PLT PALET PALLET",
    "RIM": "RIM REAM",
}


class Mentions:
    """Aho-Corasick automaton of patterns with their entries; the longest non-overlapping matches on word bounds."""

    def __init__(self, patterns: dict[str, set[str]]) -> None:
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        for p, keys in patterns.items():
            self.auto.add_word(p, (len(p), tuple(sorted(keys))))
        self.any = bool(patterns)
        if self.any:
            self.auto.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, tuple[str, ...]]]:
        if not self.any:
            return []
        found = [(n, end + 1 - n, keys) for end, (n, keys) in self.auto.iter(text)]
        found = [(n, a, k) for n, a, k in found if (a == 0 or not text[a - 1].isalnum()) and (a + n == len(text) or not text[a + n].isalnum())]
        taken: list[tuple[int, int, tuple[str, ...]]] = []
        for n, a, k in sorted(found, key=lambda x: (-x[0], x[1])):
            if all(a + n <= b or c <= a for b, c, _ in taken):
                taken.append((a, a + n, k))
        return sorted(taken)


def line_words(names: list[str]) -> tuple[str, ...]:
    """The lines of business of a list of legal names: last words that several names share."""
    last: dict[str, int] = defaultdict(int)
    for n in names:
        w = [x for x in re.findall(r"[A-Z]+", n.upper()) if x != "TBK"]
        if len(w) > 2:
            last[w[-1]] += 1
    return tuple(sorted(w for w, n in last.items() if n > 1))


class TokenIndex:
    """An inverted index of names by their words: as they are, with one slip, as beginnings, and glued."""

    def __init__(self, names: list[tuple[str, Name]]) -> None:
        self.names = names
        self.slips: dict[str, set[int]] = defaultdict(set)
        self.heads: dict[str, set[int]] = defaultdict(set)
        for i, (_, n) in enumerate(names):
            for w in n.words:
                for x in slips(w):
                    self.slips[x].add(i)
                f = fold(w)
                for k in range(1, len(f) + 1):
                    self.heads[f[:k]].add(i)
            for x in slips("".join(n.words)):
                self.slips[x].add(i)

    def proposed(self, name: Name) -> set[int]:
        """All entries that can be similar at ``LEAST_SIMILAR``: at least one whole word, or all of them glued, has a partner there."""
        keys: set[str] = set()
        for w, short in zip(name.words, name.short):
            if not short:
                keys |= slips(w)
        if not any(name.short):
            for order in (name.words, name.words[::-1]):
                keys |= slips("".join(order))
        out = {i for k in keys for i in self.slips.get(k, ())}
        # where only cut words are left over, entries that begin with one of them
        if all(s or len(w) < 4 for w, s in zip(name.words, name.short)):
            out |= {i for w, s in zip(name.words, name.short) if s for i in self.heads.get(fold(w), ())}
        return out

    def closest(self, name: Name) -> list[tuple[float, str]]:
        """(similarity, key) of the entries of an agreeing line of business at ``LEAST_SIMILAR`` or above."""
        near = ((token_set_similarity(name, self.names[i][1]), self.names[i][0]) for i in self.proposed(name) if lines_agree(name, self.names[i][1]))
        return [(s, k) for s, k in near if s >= LEAST_SIMILAR]


def issuer_matcher(entries: list[tuple[str, str | None, str | None]], lines: tuple[str, ...] | None = None) -> Callable[[str], str]:
    """A function from a typed value to the code of (code, brand, legal name) entries, '' if none."""
    lines = lines or line_words([pt for _, _, pt in entries if pt])
    read = [(code, read_name(pt, lines)) for code, _, pt in entries if pt]
    read = [(c, n) for c, n in read if n]
    patterns: dict[str, set[str]] = defaultdict(set)
    for code, n in read:
        for words in (n.words, n.words[::-1]):
            for sep in (" ", ""):
                core = sep.join(words)
                patterns[core].add(code)
                for line in n.lob:
                    patterns[f"{core} {line}"].add(code)
    for code, brand, _ in entries:
        if brand:
            patterns[brand.upper()].add(code)
    mentions, index = Mentions(patterns), TokenIndex(read)
    name_of = dict(read)
    brands = {b.upper() for _, b, _ in entries if b}

    @lru_cache(maxsize=200_000)
    def match(value: str) -> str:
        text = " ".join(t if t.isalpha() or t.isdigit() else t.translate(MISREAD) for t in re.findall(r"[A-Z0-9]+", value.upper()))
        typed = read_name(value, lines)
        hits = mentions.find(text)
        codes = {c for a, b, keys in hits for c in keys}
        for a, b, keys in hits:
            if text[a:b] in brands and len(codes) == 1:
                return keys[0]
        if typed is None:
            return ""
        # a mention without its line of business holds only where the value names no other
        codes = {c for c in codes if c in name_of and lines_agree(typed, name_of[c])}
        if len(codes) == 1:
            return codes.pop()
        scored = index.closest(typed)
        best = {c for sim, c in scored if sim == max(scored)[0]}
        return best.pop() if len(best) == 1 else ""

    return match


_AS_LETTERS = str.maketrans("0158", "OISB")
_MISREAD_UNIT = str.maketrans("0158TLZ", "OISBIIS")


def unit_matcher(entries: list[tuple[str, str | None, str | None]]) -> Callable[[str], str]:
    """A function from a typed unit to the code of (code, names, English names) entries, '' if none."""
    patterns: dict[str, set[str]] = defaultdict(set)
    for code, *names in entries:
        words = [code, *(UNIT_ALIASES.get(code, "").split())]
        for n in names:
            words += [re.sub(r"\(.*?\)", "", x).strip() for x in (n or "").split(",")]
        for w in words:
            if w:
                patterns[w.upper()].add(code)
    mentions = Mentions(patterns)

    @lru_cache(maxsize=200_000)
    def match(value: str) -> str:
        text = value.upper().strip()
        whole = re.sub(r"[^A-Z0-9]", "", text)
        for w in (whole, whole.translate(_AS_LETTERS)):
            if w in patterns:
                return next(iter(patterns[w])) if len(patterns[w]) == 1 else ""
        bare = re.sub(r"(?:/|@|\bISI\b)\s*\d+\s*/?|(?<=[A-Z])\d{1,4}$", " ", text)  # a pack size behind the unit
        for t in (bare, " ".join(re.findall(r"[A-Z]+", bare))):
            keys = {k for *_, ks in mentions.find(t) for k in ks}
            if len(keys) == 1:
                return keys.pop()
        for w in (whole, re.sub(r"[^A-Z0-9]", "", bare)):
            if len(w) < 2 or w.isdigit():
                continue
            near = {
                k
                for p, ks in patterns.items()
                if w.translate(_MISREAD_UNIT) == p.translate(_MISREAD_UNIT) or (len(p) > 2 and swapped(w, p)) or (len(p) > 3 and len(w) != len(p) and edit(fold(w), fold(p), 1) < 2)
                for k in ks
            }
            if len(near) == 1:
                return near.pop()
        return ""

    return match


class Matcher:
    """A matcher that is built where it is used: the list travels, the automaton doesn't. kind: issuer or unit."""

    def __init__(self, kind: str, rows: list[tuple]) -> None:
        self.kind, self.rows, self.made = kind, rows, None

    def __call__(self, value: str) -> str:
        if self.made is None:
            self.made = (issuer_matcher if self.kind == "issuer" else unit_matcher)(self.rows)
        return self.made(value)

    def __getstate__(self) -> dict:
        return {"kind": self.kind, "rows": self.rows, "made": None}


def map_values(values: DataFrame, field: str, matcher: Matcher) -> DataFrame:
    """(field, raw_value, canonical_key) of each distinct non-blank value of the one column of ``values``."""
    col = values.columns[0]
    distinct = values.select(F.col(col).cast("string").alias("raw_value")).where(F.col("raw_value").rlike(r"\S")).distinct()
    # few bytes but much work a value: spread them, as they would be coalesced by size
    distinct = distinct.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"field": field, "raw_value": pdf["raw_value"], "canonical_key": [matcher(v) for v in pdf["raw_value"]]})

    return distinct.mapInPandas(run, "field string, raw_value string, canonical_key string")


def bounded_rows(df: DataFrame, most: int = MOST_ENTRIES) -> list[tuple]:
    """The rows of a list that is sent to all executors, after a check of its size."""
    rows = [tuple(r) for r in df.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"the canonical list has more than {most} rows; it is too large to be sent to every executor")
    return sorted(rows, key=lambda r: tuple(x is not None and str(x) or "" for x in r))
