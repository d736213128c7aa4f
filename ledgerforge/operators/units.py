"""Quantities recorded in different units, brought to grams, millilitres or pieces (problem 3).

The gross amount of a line over its piece price and its quantity is the number
of pieces (of loose goods: kilograms or litres) that one unit of ``qty`` holds.
Its logarithm, over the history of one product, is a step function with noise:
an exact penalised changepoint search (optimal partitioning with PELT pruning,
squared error) finds the steps; a level that equals a known factor (piece, dozen,
inner pack, carton, hundredweight ...) names the unit of its segment, and the
change of unit is reversed. The price of a step comes from the history's own
noise, as the Bayesian information criterion has it: exact books keep every
change of unit, rounded or sloppy ones are read by the level of their segment, so
a line whose own ratio is off has the unit of the lines around it. Lines without
a price are read from the unit that their text names.

A history is read in order of id out of range-partitioned, sorted data, so a
product that holds a third of all rows is spread over many tasks. Inside a task
a history runs on over Arrow batches: the last two segments of a batch wait for
the next one, up to ``MOST_HELD`` rows. It is cut where one task ends.

Defined results: rows with null or non-positive qty, with no pack and no unit in
their text, or whose unit is neither named nor proved, yield no row; a null
product falls back to its name, then to one common history; repeated rows keep
their ids; an amount that is no whole number is rounded half up.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unit spellings, their base unit and factor; None: the pack decides.
MEASURES: dict[str, tuple[str, float]] = {
    "MG": ("g", 0.001), "G": ("g", 1), "GR": ("g", 1), "GRM": ("g", 1), "GRAM": ("g", 1), "GRAMS": ("g", 1),
    "ONS": ("g", 100), "ONZ": ("g", 100), "KG": ("g", 1000), "KGS": ("g", 1000), "KILO": ("g", 1000), "KILOGRAM": ("g", 1000), "K G": ("g", 1000),
    "KW": ("g", 100_000), "KWINTAL": ("g", 100_000), "KUINTAL": ("g", 100_000), "QUINTAL": ("g", 100_000), "TON": ("g", 1_000_000),
    "ML": ("ml", 1), "CC": ("ml", 1), "MILILITER": ("ml", 1), "CL": ("ml", 10), "DL": ("ml", 100),
    "L": ("ml", 1000), "LT": ("ml", 1000), "LTR": ("ml", 1000), "LITER": ("ml", 1000), "LITRE": ("ml", 1000), "LITTER": ("ml", 1000),
}
#: Rows of an unfinished history that wait for the next batch; a segment longer than that has a level that more rows hardly move.
MOST_HELD = 20_000
#: The least price of a step: of noise below a thousandth.
LEAST_PENALTY = 1e-6
PIECES = ("PCS", "PC", "BH", "BUAH", "BIJI", "BJ", "EA", "EACH", "PIECE", "PIECES")
FIXED_COUNTS = {"LSN": 12, "LUSIN": 12, "DOZEN": 12, "DOZ": 12, "DZ": 12, "GROS": 144, "GRS": 144, "GROSS": 144, "KODI": 20}
CARTONS = ("KRT", "KARTON", "CTN", "CARTON", "DUS", "DOS", "KTN", "CASE", "KAR", "CAR")
INNERS = ("BOX", "PAK", "PACK", "BKS", "BUNGKUS", "INNER", "KOTAK", "RCG", "RENCENG")
CONTAINERS = ("SAK", "ZAK", "SACK", "DRUM", "JRG", "JERIGEN", "JERIKEN", "JIRIGEN", "KALENG", "KLG", "TONG")


def _alt(words: object) -> str:
    return "|".join(sorted(words, key=len, reverse=True))


_MEASURE = _alt(MEASURES)
_COUNT = _alt([*PIECES, *FIXED_COUNTS, *CARTONS, *INNERS])
_NUM = r"(?<![\d.,])[13]/[248](?!\d)|\d+(?:[.,]\d+)?"
_CONTENT = re.compile(rf"(?P<n>{_NUM})\s*(?P<u>{_MEASURE})(?![A-Z])")
_CONTAINER = re.compile(rf"(?<![A-Z])(?:{_alt(CONTAINERS)})\s*@?\s*(?P<n>{_NUM})\s*(?P<u>{_MEASURE})(?![A-Z])")
_LOOSE = re.compile(rf"(?<![A-Z\d])(?P<u>{_MEASURE})(?![A-Z])")
_NAMED = (
    re.compile(rf"(?<![A-Z\d/])(?P<u>{_COUNT})\s*:"),
    re.compile(rf"(?<![A-Z])SAT\.?\s*(?P<u>{_COUNT})(?![A-Z])"),
    re.compile(rf"\(\s*(?P<u>{_COUNT})\s*\)"),
    re.compile(rf"\s/\s+(?P<u>{_COUNT})\s*$"),
)


def _number(text: str) -> float:
    if "/" in text:
        a, b = text.split("/")
        return int(a) / int(b)
    return float(text.replace(",", "."))


def unmisread(text: str) -> str:
    """Upper case, with letters read for digits put right where only a digit can stand."""
    s = re.sub(r"(?<![A-Za-z])[lI](?=[\dO]|[.,/]\d)|(?<=\d)[lI](?=[\dO]|\s*[xX*/])", "1", text)
    s = re.sub(rf"(?<![A-Za-z])[lI](?=\s*(?:[xX*]\s*\d|(?i:{_MEASURE}|BOX|PAK|PCS|CTN)(?![A-Za-z])))", "1", s)
    s = re.sub(r"(?<=[\dS]\s[xX*]\s)[lI](?![A-Za-z])|(?<=\d[xX*])[lI](?![A-Za-z])|(?<=@)[lI](?![A-Za-z])", "1", s)
    s = re.sub(r"(?<=\d)[Oo](?!NS|ns)|(?<![A-Za-z])O(?=[\d.,]\d)|(?<=\d[xX*])O(?=[\d.,])", "0", s)
    s = re.sub(r"(?<=\d)[Oo](?!NS|ns)", "0", s)
    return s.upper()


@lru_cache(maxsize=200_000)
def read_pack(text: str) -> tuple[str | None, float, int, int, str | None]:
    """(base unit, content of a piece, pieces in a carton, pieces in an inner pack, named unit) of a pack text.

    Named unit: ``#<factor>`` for a measure, of which base unit is given; else pcs, carton, inner or a fixed count.
    Zeros where the text doesn't say.
    """
    s = unmisread(text)
    if m := _CONTAINER.search(s):
        base, f = MEASURES[m["u"]]
        return base, 0.0, 0, 0, f"#{f * _number(m['n']):.12g}"
    named = None
    for pattern in _NAMED:
        if m := pattern.search(s):
            u = m["u"]
            named = "pcs" if u in PIECES else str(FIXED_COUNTS[u]) if u in FIXED_COUNTS else "carton" if u in CARTONS else "inner"
            s = s[: m.start()] + " " + s[m.end() :]
            break
    base, content = None, 0.0
    if m := _CONTENT.search(s):
        base, f = MEASURES[m["u"]]
        content = f * _number(m["n"])
        s = s[: m.start()] + " " + s[m.end() :]
    s = re.sub(r"(?<![\d.,/])0\d(?![\d.,/])", " ", s)  # colour numbers in names
    counts = [int(x) for x in re.findall(r"(?<![\d.,])\d{1,5}(?![\d.,]\d|\d)", s) if int(x)]
    pack = math.prod(counts) if counts else 0
    inner = counts[-1] if len(counts) > 1 else 0
    if not pack and not base and named is None and (m := _LOOSE.search(s)):
        base, f = MEASURES[m["u"]]
        return base, 0.0, 0, 0, f"#{f:.12g}"
    return base, content, pack, inner, named


def changepoints(y: np.ndarray, penalty: float) -> list[int]:
    """Ends of the segments of the exact optimum of squared error plus ``penalty`` a segment (PELT).

    A start that cannot beat the newest one is dropped, so a step function costs linear time.
    """
    n = len(y)
    s1 = [0.0, *np.cumsum(y)]
    s2 = [0.0, *np.cumsum(y * y)]
    best, last, starts = [-penalty] + [0.0] * n, [0] * (n + 1), [0]
    for t in range(1, n + 1):
        costs = [best[s] + s2[t] - s2[s] - (s1[t] - s1[s]) ** 2 / (t - s) for s in starts]
        k = min(range(len(costs)), key=costs.__getitem__)
        best[t], last[t] = costs[k] + penalty, starts[k]
        starts = [s for s, c in zip(starts, costs) if c < best[t] - 1e-12] + [t]
    ends, t = [], n
    while t:
        ends.append(t)
        t = last[t]
    return ends[::-1]


def _factor(level: float, known: tuple[float, ...], tolerance: float) -> float | None:
    fits = [f for f in known if f > 0 and abs(level - math.log(f)) <= tolerance]
    return min(fits, key=lambda f: abs(level - math.log(f))) if fits else None


def _penalty(y: np.ndarray, known: list[tuple[float, ...]]) -> float:
    """3 s^2 log n, s being the noise of a history: the median distance of its values from the nearest known factor, as a standard deviation."""
    off = [min(abs(v - math.log(f)) for f in fs if f > 0) for v, fs in zip(y, known)]
    near = [x for x in off if x < 0.35]  # farther away no factor is meant
    noise = 1.4826 * float(np.median(near)) if near else 0.0
    return max(LEAST_PENALTY, 3.0 * noise * noise * math.log(max(len(y), 2)))


def read_units(pdf: pd.DataFrame, tolerance: float, penalty: float | None = None, last: bool = True) -> tuple[pd.DataFrame, int]:
    """(id, base_unit, base_qty, unit_factor, proof of rows sorted by source and id, row from which the last history is unfinished).

    last: no more rows follow, so all are finished. penalty: the price of a step, of the history's noise if None.
    """
    packs = [read_pack(k) if k else (None, 0.0, 0, 0, None) for k in pdf["kemasan"].fillna("")]
    names = [read_pack(k) if k else (None, 0.0, 0, 0, None) for k in pdf["nama_produk"].fillna("")]
    given = [a if a[2] or a[1] else b for a, b in zip(packs, names)]
    known = [(1.0, 12.0, 144.0, 20.0, float(g[2]), float(g[3])) for g in given]
    with np.errstate(divide="ignore", invalid="ignore"):
        y = np.log((pdf["gross"] / (pdf["harga"] * pdf["qty"])).to_numpy(dtype=float))
    usable = np.isfinite(y)
    level = np.full(len(y), np.nan)
    source = pdf["source"].to_numpy()
    edges = np.flatnonzero(np.append(True, source[1:] != source[:-1])) if len(y) else np.array([], dtype=int)
    done = len(y)
    for a, b in zip(edges, [*edges[1:], len(y)]):
        at = a + np.flatnonzero(usable[a:b])
        ends = changepoints(y[at], penalty if penalty is not None else _penalty(y[at], [known[i] for i in at])) if len(at) else []
        start = 0
        for end in ends:
            level[at[start:end]] = y[at[start:end]].mean()
            start = end
        if b == len(y) and not last:
            done = max(int(at[ends[-3]]) if len(ends) > 2 else int(a), len(y) - MOST_HELD)
    out: list[tuple] = []
    for i in range(done):
        a, b, (base, content, pack, inner, _) = packs[i], names[i], given[i]
        named = a[4] or b[4]
        qty = float(pdf["qty"].iat[i])
        if named and named[0] == "#":
            loose = a if a[4] else b
            out.append((pdf["id"].iat[i], loose[0], qty * float(named[1:]), float(named[1:]), "named"))
            continue
        if not pack and not content and not named:
            continue
        factor = {"pcs": 1.0, "carton": float(pack), "inner": float(inner or pack)}.get(named or "", float(named) if named and named.isdigit() else 0.0)
        proof = "named" if factor else ""
        if not math.isnan(level[i]) and (proved := _factor(level[i], known[i], tolerance)):
            factor, proof = proved, "proved"
        if factor and (pack or content or proof == "named"):
            out.append((pdf["id"].iat[i], base if content else "pcs", qty * factor * (content or 1.0), factor, proof))
    made = pd.DataFrame(out, columns=["id", "base_unit", "base_qty", "unit_factor", "proof"])
    made["base_qty"] = np.floor(made["base_qty"].astype(float) + 0.5).astype("int64")
    return made, done


def delivered_amounts(
    lines: DataFrame,
    discounts: tuple[str, ...] = ("disc_1", "disc_2", "disc_3", "disc_4", "disc_5"),
    tolerance: float = 0.02,
) -> DataFrame:
    """Each line's amount in its base unit: id, base_unit, base_qty, unit_factor, proof (named or proved).

    tolerance: how near a segment's level must be to a known factor.
    """
    number = lambda c: F.col(c).cast("double")
    gross = number("jumlah") + sum((F.coalesce(number(c), F.lit(0.0)) for c in discounts), F.lit(0.0))
    src = lines.where("qty > 0 and id is not null").select(
        F.coalesce("kode_material", "nama_produk", F.lit("")).alias("source"), F.col("id").cast("bigint").alias("id"),
        "kemasan", "nama_produk", number("qty").alias("qty"), number("harga").alias("harga"), gross.alias("gross"),
    )
    ordered = src.repartitionByRange("source", "id").sortWithinPartitions("source", "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in batches:
            rows = (pdf if held is None else pd.concat([held, pdf])).reset_index(drop=True)
            made, done = read_units(rows, tolerance, last=False)
            held = rows.iloc[done:]
            yield made
        if held is not None:
            yield read_units(held.reset_index(drop=True), tolerance)[0]

    return ordered.mapInPandas(run, "id bigint, base_unit string, base_qty bigint, unit_factor double, proof string")
