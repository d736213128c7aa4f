"""Reading typed firm and person names: words, line of business, and what was left off.

Pure functions on strings, shared by the mapping to a canonical list and by the
linking of spellings. A name is read into two words that name the firm or
person and a line of business; legal forms, honorifics, branches, stores and
words of the printed form are left out.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from itertools import permutations

import numpy as np

# Words of names and forms.
LEGAL = frozenset("PT CV UD TOKO TK TBK PERSERO FIRMA FA PD".split())
HONORIFIC = frozenset("BPK BAPAK IBU BP BU HJ SDR SDRI TN TUAN NY NYONYA".split())
FORM_WORDS = frozenset(
    "APPROVED BY TOTAL COPY HALAMAN DARI BAGIAN PEMBELIAN TGL CETAK TANGGAL KOTA SUDAH KEPADA YTH SHIP TO FRANCO GUDANG ASLI NO TELP NPWP "
    "RANGKAP DELIVERY PURCHASE ORDER LIHAT LAMPIRAN ALAMAT BUYER VENDOR INVOICE PAGE".split()
)
BRANCH = re.compile(r"\(\s*TOKO\s*\d+\s*\)|,?\s*\bGUDANG\s+\d+|\bCAB(?:ANG)?\.?\s+\w+|-\s*DC\s+\w+|\bSTORE\s+\d+|\bRANGKAP\s+\d+|\bHALAMAN\s+\d+")
#: Digits that stand where a letter was misread.
MISREAD = str.maketrans("0145689", "OIASGBG")
#: Letters that misreading confuses, folded to one of them for comparison.
FOLD = str.maketrans("DFIQC", "OELOG")


def fold(word: str) -> str:
    return word.translate(FOLD)


@dataclass(frozen=True)
class Name:
    """words: one (glued) or two or more naming words; short: those that are cut or an initial.

    lob: lines of business that the text allows, empty if it names none; whole: the line is written out.
    """

    words: tuple[str, ...]
    short: tuple[bool, ...]
    lob: frozenset[str]
    whole: bool
    firm: bool

    @property
    def key(self) -> str:
        return " ".join(w + ("." if s else "") for w, s in zip(self.words, self.short)) + "|" + ",".join(sorted(self.lob)) + ("" if self.whole or not self.lob else "?") + ("" if self.firm else "|p")


def edit(a: str, b: str, most: int) -> int:
    """Edit distance, most + 1 if it is above most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0], low = row[0], i, i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
            if row[j] < low:
                low = row[j]
        if low > most:
            return most + 1
    return min(row[-1], most + 1)


def swapped(a: str, b: str) -> bool:
    """One pair of neighbours changed places."""
    if len(a) != len(b):
        return False
    d = [i for i in range(len(a)) if a[i] != b[i]]
    return len(d) == 2 and d[1] == d[0] + 1 and a[d[0]] == b[d[1]] and a[d[1]] == b[d[0]]


def _subsequence(short: str, full: str) -> bool:
    it = iter(full)
    return all(c in it for c in short)


@lru_cache(maxsize=100_000)
def lines_of(word: str, lines: tuple[str, ...]) -> tuple[frozenset[str], bool]:
    """The lines of business that a word may stand for, and whether it is written out."""
    if word in lines:
        return frozenset([word]), True
    f = fold(word)
    if len(word) >= 4:
        near = [(edit(f, fold(x), 2 if len(x) > 5 else 1), x) for x in lines if word[0] == x[0] or len(x) > 4]
        near = [(d if not swapped(word, x) else 1, x) for d, x in near if d <= (2 if len(x) > 5 else 1) or swapped(word, x)]
        if near:
            return frozenset([min(near)[1]]), True
    if len(word) <= 6:
        fits = [x for x in lines if x[0] == word[0] and _subsequence(word, x)]
        if len(word) > 1:
            start = [x for x in fits if x.startswith(word)]
            fits = start or fits
        return frozenset(fits), False
    return frozenset(), False


@lru_cache(maxsize=400_000)
def read_name(text: str, lines: tuple[str, ...]) -> Name | None:
    """The name in a typed value, or None if it holds none: no word of letters but legal forms and form words, one letter alone, or initials only."""
    s = unicodedata.normalize("NFKC", text).upper()
    s = BRANCH.sub(" ", s)
    s = re.sub(r"\b([PCU])\.?\s?([TVD])\b\.?", lambda m: f" {m[1]}{m[2]} " if m[1] + m[2] in ("PT", "CV", "UD") else m[0], s)
    reverse = bool(re.match(r"^\s*[A-Z]+\s*,\s*[A-Z]+\s*$", s))
    raw = re.findall(r"[A-Z0-9]+\.?", s)
    firm, words, dots = False, [], []
    for i, t in enumerate(raw):
        dot, t = t.endswith("."), t.rstrip(".")
        if t in LEGAL:
            firm = True
        elif t in HONORIFIC or t in FORM_WORDS or t.isdigit() or (t == "H" and i == 0 and len(raw) > 2):
            continue
        else:
            words.append(t.translate(MISREAD) if not t.isalpha() else t)
            dots.append(dot)
    if sum(map(len, words)) < 2:
        return None
    lob: frozenset[str] = frozenset()
    whole = False
    if len(words) >= 2:
        lob, whole = lines_of(words[-1], lines)
        # with two words the second is the line only if written out; then the first holds both names
        if lob and (len(words) >= 3 or (whole and (words[-1] in lines or len(words[0]) >= 7))):
            words, dots = words[:-1], dots[:-1]
            firm = True
        else:
            lob, whole = frozenset(), False
    if reverse and len(words) == 2:
        words, dots = words[::-1], dots[::-1]
    short = tuple(len(w) <= 3 and (len(w) == 1 or d or len(words) > 1) for w, d in zip(words, dots))
    if all(1 < len(w) <= 3 and not d for w, d in zip(words, dots)):
        short = (False,) * len(words)  # nothing was cut: such a name has short words only
    if all(short):
        return None
    return Name(tuple(words), short, lob, whole, firm)


def words_fit(a: str, b: str) -> int:
    """0 if equal but for letters that misreading confuses, 1 after one edit or swap of neighbours, else 2."""
    if a == b:
        return 0
    if swapped(a, b):
        return 1
    return edit(fold(a), fold(b), 1)


def _short_fits(short: str, full: str) -> int:
    """0 if a cut word begins the other, 1 if it is the other but for one edit, else 2."""
    if full.startswith(short) or fold(full).startswith(fold(short)):
        return 0
    return words_fit(short, full) if len(short) > 2 else 2


def _both_short(a: str, b: str) -> int:
    """0 if two cut words are equal, 1 if one begins the other, else 2."""
    return 0 if a == b else 1 if a.startswith(b) or b.startswith(a) else 2


def core_distance(a: Name, b: Name) -> int:
    """Edits between the naming words in the better of both orders, at most one a word; 3 if the names don't fit.

    A glued name is held against the joined words and may be one edit off.
    """
    if max(map(len, a.words + b.words)) < 4:
        # one edit makes another word of three letters
        p, q = tuple(map(fold, a.words)), tuple(map(fold, b.words))
        return 0 if p == q or p == q[::-1] else 3
    best = 3
    for x, xs in ((a.words, a.short), (a.words[::-1], a.short[::-1])):
        if len(x) == len(b.words) == 2:
            each = [
                _both_short(p, q) if ps and qs and min(len(p), len(q)) < 3 else _short_fits(p, q) if ps else _short_fits(q, p) if qs else words_fit(p, q)
                for p, ps, q, qs in zip(x, xs, b.words, b.short)
            ]
            if max(each) < 2:
                best = min(best, sum(each))
        elif len(x) != len(b.words) and not any(a.short) and not any(b.short):
            p, q = "".join(x), "".join(b.words)
            if words_fit(p, q) < 2:
                best = min(best, words_fit(p, q))
        elif len(x) == len(b.words) and words_fit("".join(x), "".join(b.words)) < 2:
            best = min(best, words_fit("".join(x), "".join(b.words)))
    return best


def token_similarity(a: str, a_short: bool, b: str, b_short: bool) -> float:
    """1 for words that are equal but for misread letters, or of which a cut one begins the other; 0.8 after one edit or swap; else 0."""
    d = _both_short(a, b) if a_short and b_short and min(len(a), len(b)) < 3 else _short_fits(a, b) if a_short else _short_fits(b, a) if b_short else words_fit(a, b)
    return (1.0, 0.8, 0.0)[d]


def token_set_similarity(a: Name, b: Name) -> float:
    """The words of two names as sets: the similarity of each word to its partner in the best assignment, over the larger set; 0 to 1.

    Blanks don't count: sets of different size, and sets that fit better so, are also held against each other as one glued
    word each, in every order of the shorter name's words, unless a word is cut. Names of words of up to three letters
    are as similar as equal words make them, as one edit makes another such word.
    """
    if max(map(len, a.words + b.words)) < 4:
        p, q = sorted(map(fold, a.words)), sorted(map(fold, b.words))
        return 1.0 if p == q else 0.0
    each = [[token_similarity(p, ps, q, qs) for q, qs in zip(b.words, b.short)] for p, ps in zip(a.words, a.short)]
    best = _assign(each) / max(len(a.words), len(b.words))
    if not any(a.short) and not any(b.short) and best < 1.0:
        joined = "".join(b.words)
        for order in permutations(a.words) if len(a.words) < 4 else (a.words, a.words[::-1]):
            best = max(best, (1.0, 0.9, 0.0)[words_fit("".join(order), joined)])
    return best


def _assign(each: list[list[float]]) -> float:
    """The best sum of an assignment of rows to columns, each used once; few words a name, so by trying."""
    if not each or not each[0]:
        return 0.0
    first, rest = each[0], each[1:]
    return max([_assign(rest)] + [v + _assign([[x for k, x in enumerate(r) if k != j] for r in rest]) for j, v in enumerate(first) if v])


def slips(word: str) -> set[str]:
    """The folded word, and it without each letter: two words within one edit or swap share one of these."""
    f = fold(word)
    return {f} | {f[:i] + f[i + 1 :] for i in range(len(f))}


def nickname(a: Name, b: Name) -> bool:
    """One of two person names lacks the first syllable of the other's first name."""
    if len(a.words) != 2 or len(b.words) != 2 or a.firm or b.firm:
        return False
    for x in (a.words, a.words[::-1]):
        for p, q, r, t in ((x[0], b.words[0], x[1], b.words[1]), (x[1], b.words[1], x[0], b.words[0])):
            if abs(len(p) - len(q)) == 2 and min(len(p), len(q)) > 3 and (p.endswith(q) or q.endswith(p)) and words_fit(r, t) < 2:
                return True
    return False


def lines_agree(a: Name, b: Name) -> bool:
    return not a.lob or not b.lob or bool(a.lob & b.lob)


def points(name: Name) -> list[tuple[str, str]]:
    """The points (block, word) of a name, letters that misreading confuses folded.

    Two points of one block are as far apart as their words by edit distance, of two blocks infinitely far: a metric. A
    written-out word stands in the block of the other word's initial, so a cut word or an initial has the same block as
    what it is cut from; and in that of its second letter, which is the initial of a typist who swapped or lost the first.
    A glued name and both joins of a written-out one stand in the blocks of their first two and their last two letters,
    one of which a single slip leaves as they are. Persons also stand where the other name lacks its first syllable.
    """
    w = [fold(x) for x in name.words]
    out = set()
    for i, x in enumerate(w):
        for j, y in enumerate(w):
            if i != j and not name.short[i]:
                out.add((y[0], x))
                if not name.short[j]:
                    out.add((y[1:2], x))
                    if not name.firm and len(y) > 5:
                        out.add((y[2], x))
    if not any(name.short):
        for x in ("".join(w), "".join(w[::-1])):
            out |= {("<" + x[:2], x), (">" + x[-2:], x)}
    return sorted(out)


# ---- vectors of pairs ---------------------------------------------------------------------------------------

#: Letters that one machine word of the bit-parallel distance holds; longer words are measured one by one.
MOST_BITS = 63


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of words as numbers 0..27 (0: none), at most ``MOST_BITS``, and the lengths of what is encoded."""
    n = np.array([min(len(w), MOST_BITS) for w in words], dtype=np.int64)
    out = np.zeros((len(words), int(n.max(initial=1))), dtype=np.int64)
    for i, w in enumerate(words):
        out[i, : n[i]] = [(ord(c) - 64) if "A" <= c <= "Z" else 27 for c in w[:MOST_BITS]]
    return out, n


def distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distances of all words of a from all of b. Signs that are no letter count as one sign in words of up to ``MOST_BITS``, as in the words themselves."""
    letters, n = encode([*a, *b])
    x, y = np.repeat(np.arange(len(a)), len(b)), len(a) + np.tile(np.arange(len(b)), len(a))
    d = edits(letters, n, x, y).reshape(len(a), len(b))
    wide_a, wide_b = [i for i, w in enumerate(a) if len(w) > MOST_BITS], [j for j, w in enumerate(b) if len(w) > MOST_BITS]
    for i in wide_a:
        d[i] = [edit(a[i], w, max(len(a[i]), len(w))) for w in b]
    for j in wide_b:
        d[:, j] = [edit(w, b[j], max(len(w), len(b[j]))) for w in a]
    return d


def edits(letters: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distances of the pairs (a[i], b[i]) of encoded words: bit-parallel, vectorised over pairs."""
    peq = np.zeros((len(n), 28), dtype=np.uint64)
    for j in range(letters.shape[1]):
        at = j < n
        peq[np.flatnonzero(at), letters[at, j]] |= np.uint64(1 << j)
    one = np.uint64(1)
    m = n[a]
    pv = np.full(len(a), np.uint64(2**64 - 1))
    mv = np.zeros(len(a), dtype=np.uint64)
    score = m.copy()
    top = (m - 1).astype(np.uint64)
    for j in range(letters.shape[1]):
        live = j < n[b]
        if not live.any():
            break
        eq = peq[a, letters[b, j]]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        score += np.where(live, ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64), 0)
        ph = (ph << one) | one
        mh = mh << one
        pv = np.where(live, mh | ~(xv | ph), pv)
        mv = np.where(live, ph & xv, mv)
    return np.where(m == 0, n[b], score)
