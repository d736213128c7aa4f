"""Variant spellings of firms and persons, linked (problem 5).

Distinct names are read into naming words and a line of business, and every name
is given points in a metric space (``names.points``): a word that is written out,
in the block of the other word's initial, under edit distance. Names that belong
together have points within one edit of each other; the links between names are
found by metric-space partitioning alone: a point goes to the cell of its nearest
pivot, and by the triangle inequality also to every cell where a point within the
radius may be at home, that is whose pivot is at most 2 r farther than the nearest
and no farther than the cell reaches plus r. Inside each cell an exact radius join
runs as an equi-join on the cell. Pivots grow with the square root of the points
and stand far apart. Swapped neighbours, one slip to a typist but two edits to the
metric, come from an equi-join on the swaps.

Names with such points are verified word by word. Written-out names of one line
of business, and persons, form components; a name with a cut word or without its
line joins the one class that is nearest, none if two are.

Defined results: null, blank and nameless values are in no class; two names of
different lines of business are never in one class; copies of a value are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.graph import components
from ledgerforge.llm.names import Name, core_distance, distances, lines_agree, nickname, points, read_name
from ledgerforge.session import cut

#: All that the driver and each task ever hold of the points: so many pivots, out of so many points sampled by hash. They balance the cells and decide nothing else.
MOST_PIVOTS, MOST_SAMPLED = 4096, 16_384


def choose_pivots(sample: list[tuple[str, str]], n: int) -> dict[str, list[str]]:
    """About n pivots by block, as many as the block has of the sample: in each the point farthest from those chosen, over and over."""
    blocks: dict[str, list[str]] = {}
    for block, word in sample:
        blocks.setdefault(block, []).append(word)
    out: dict[str, list[str]] = {}
    for block, words in sorted(blocks.items()):
        words = sorted(set(words))
        most = min(len(words), max(1, round(n * len(words) / max(1, len(sample)))))
        chosen = [0]
        far = distances(words, [words[0]])[:, 0]
        while len(chosen) < most and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, distances(words, [words[chosen[-1]]])[:, 0])
        out[block] = [words[i] for i in chosen]
    return out


def place(pts: DataFrame, radius: int, pivots: int | None = None) -> DataFrame:
    """(block, cell, word, home, d): every distinct point (block, word) in its home cell, and its copies in the cells that may hold a point within ``radius``."""
    n = pivots or int(np.ceil(np.sqrt(pts.count())))
    rows = pts.select("block", "word").orderBy(F.xxhash64("block", "word"), "block", "word").limit(MOST_SAMPLED).collect()
    chosen = choose_pivots([(r[0], r[1]) for r in rows], min(n, MOST_PIVOTS))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, g in pdf.groupby("block"):
                near = chosen.get(block, [""])
                for k in range(0, len(g), 512):
                    own = g["word"].iloc[k : k + 512].tolist()
                    d = distances(own, near)
                    home = d.argmin(axis=1)
                    row, cell = np.nonzero(d <= d.min(axis=1)[:, None] + 2 * radius)
                    yield pd.DataFrame({"block": block, "cell": cell.astype("int32"), "word": [own[i] for i in row], "home": home[row] == cell, "d": d[row, cell].astype("int32")})

    placed = cut(pts.select("block", "word").mapInPandas(assign, "block string, cell int, word string, home boolean, d int"))
    # how far each cell reaches: one row a pivot
    reach = F.broadcast(placed.where("home").groupBy("block", "cell").agg(F.min("d").alias("near"), F.max("d").alias("far")))
    return placed.join(reach, ["block", "cell"]).where(F.col("home") | F.col("d").between(F.col("near") - radius, F.col("far") + radius)).select("block", "cell", "word", "home", "d")


def radius_pairs(pts: DataFrame, radius: int = 1, pivots: int | None = None) -> DataFrame:
    """(block, a, b) of all pairs of distinct points (block, word) of one block within edit distance ``radius``, a <= b: every point is within it of itself.

    Exact for every choice of pivots; they only balance the cells.
    """
    placed = place(pts, radius, pivots)
    x = placed.where("home").select("block", "cell", F.col("word").alias("a"), F.col("d").alias("da"))
    y = placed.select("block", "cell", F.col("word").alias("b"), F.col("d").alias("db"))
    near = x.join(y, ["block", "cell"]).where((F.abs(F.length("a") - F.length("b")) <= radius) & (F.abs(F.col("da") - F.col("db")) <= radius) & F.levenshtein("a", "b", radius).between(0, radius))
    return near.select("block", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def swap_pairs(pts: DataFrame) -> DataFrame:
    """(block, a, b) of all pairs of points of one block whose words differ by one swap of neighbouring letters, a < b."""
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("i")
    made = pts.where(F.length("word") > 1).select("block", "word", at).select("block", F.col("word").alias("a"), F.expr("concat(substring(word, 1, i - 1), substring(word, i + 1, 1), substring(word, i, 1), substring(word, i + 2))").alias("b")).where("a < b")
    return made.join(pts.select("block", F.col("word").alias("b")), ["block", "b"]).select("block", "a", "b").distinct()


_NAME = "key string, words array<string>, short array<boolean>, lob array<string>, whole boolean, firm boolean, points array<struct<block:string,word:string>>"


def read_names(values: DataFrame, lines: tuple[str, ...], brands: frozenset[str]) -> DataFrame:
    """The distinct values of the one column of ``values`` that hold a name, with what was read."""
    col = values.columns[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for v in pdf["value"]:
                n = read_name(v, lines)
                if n and not (not n.lob and brands.intersection(n.words)):
                    out.append((v, n.key, list(n.words), list(n.short), sorted(n.lob), n.whole, n.firm, [{"block": b, "word": w} for b, w in points(n)]))
            yield pd.DataFrame(out, columns=["value", "key", "words", "short", "lob", "whole", "firm", "points"])

    return values.select(F.col(col).alias("value")).where("value is not null").distinct().mapInPandas(run, f"value string, {_NAME}")


def _name(r: tuple) -> Name:
    return Name(tuple(r[0]), tuple(bool(x) for x in r[1]), frozenset(r[2]), bool(r[3]), bool(r[4]))


def link_names(names: DataFrame) -> DataFrame:
    """(key, class) of all names (one row a key, with the columns of ``read_names``): class is the least key of the class."""
    names = cut(names.select("key", "words", "short", "lob", "whole", "firm", "points").dropDuplicates(["key"]))
    own = names.select("key", F.explode("points").alias("p")).select("key", "p.block", "p.word")
    pts = cut(own.select("block", "word").distinct())
    links = radius_pairs(pts).unionByName(swap_pairs(pts)).distinct()
    at = lambda k, w: own.select(F.col("key").alias(k), "block", F.col("word").alias(w))
    pairs = links.join(at("x", "a"), ["block", "a"]).join(at("y", "b"), ["block", "b"]).where("x <> y").select("x", "y")
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    detail = F.struct("words", "short", "lob", "whole", "firm")
    both = pairs.join(names.select(F.col("key").alias("x"), detail.alias("p")), "x").join(names.select(F.col("key").alias("y"), detail.alias("q")), "y")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for x, y, p, q in zip(pdf["x"], pdf["y"], pdf["p"], pdf["q"]):
                a, b = _name(tuple(p[c] for c in ("words", "short", "lob", "whole", "firm"))), _name(tuple(q[c] for c in ("words", "short", "lob", "whole", "firm")))
                d = core_distance(a, b) if lines_agree(a, b) else 3
                if d < 3:
                    out.append((x, y, d))
                elif nickname(a, b):
                    out.append((x, y, 9))
            yield pd.DataFrame(out, columns=["x", "y", "d"])

    fits = cut(both.mapInPandas(verify, "x string, y string, d int"))
    around = fits.unionByName(fits.select(F.col("y").alias("x"), F.col("x").alias("y"), "d"))
    cut_short = F.exists("short", lambda s: s)
    kind = names.select("key", F.when(~cut_short & F.col("whole"), "firm").when(~cut_short & (F.size("lob") == 0) & ~F.col("firm"), "plain").otherwise("part").alias("kind"), F.array_join("lob", ",").alias("line"))
    # a bare name near a written-out firm is that firm's; the others are persons
    firm = kind.where("kind = 'firm'").select(F.col("key").alias("y"))
    bare = around.where("d < 3").join(firm, "y", "left_semi").select(F.col("x").alias("key")).distinct()
    kind = cut(kind.join(bare.withColumn("near", F.lit(True)), "key", "left").select("key", "line", F.when((F.col("kind") == "plain") & F.col("near"), "part").otherwise(F.col("kind")).alias("kind")))
    typed = around.join(kind.select(F.col("key").alias("x"), F.col("kind").alias("kx"), F.col("line").alias("lx")), "x").join(kind.select(F.col("key").alias("y"), F.col("kind").alias("ky"), F.col("line").alias("ly")), "y")
    solid = typed.where("d < 3 and kx = ky and kx <> 'part' and lx = ly and x < y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = components(solid)
    first = cut(kind.where("kind <> 'part'").join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("class"), F.col("root").isNull().alias("alone"), "kind"))
    # parts join the one class that is nearest; single persons that are a nickname of one other class join it
    to = first.select(F.col("key").alias("y"), "class")
    reach = typed.where("d < 3 and kx = 'part' and ky <> 'part'").join(to, "y").groupBy("x", "class").agg(F.min("d").alias("d"))
    nick = typed.where("d = 9 and kx = 'plain' and ky = 'plain'").join(first.where("alone").select(F.col("key").alias("x")), "x", "left_semi").join(to, "y").groupBy("x", "class").agg(F.min("d").alias("d"))
    reach = reach.unionByName(nick)
    nearest = reach.groupBy("x").agg(F.min("d").alias("d"))
    unique = reach.join(nearest, ["x", "d"]).groupBy("x").agg(F.min("class").alias("class"), F.count("*").alias("n")).where("n = 1").select(F.col("x").alias("a"), F.col("class").alias("b"))
    unique = cut(unique)
    # names that reach no class stand with those that they fit
    lost = kind.where("kind = 'part'").join(reach.select(F.col("x").alias("key")), "key", "left_anti").select("key")
    rest = typed.where("d < 3 and x < y").join(lost.select(F.col("key").alias("x")), "x", "left_semi").join(lost.select(F.col("key").alias("y")), "y", "left_semi").select(F.col("x").alias("a"), F.col("y").alias("b"))
    base = first.where("key <> class").select(F.col("key").alias("a"), F.col("class").alias("b"))
    final = components(base.unionByName(unique).unionByName(rest))
    return names.select("key").join(final.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("class"))


def spelling_classes(values: DataFrame, lines: tuple[str, ...], brands: frozenset[str]) -> DataFrame:
    """(value, class) of all distinct values that hold a name."""
    read = cut(read_names(values, lines, brands))
    return read.select("value", "key").join(link_names(read), "key").select("value", "class")


def spelling_pairs(classes: DataFrame) -> DataFrame:
    """(name_a, name_b) of all pairs of different spellings of one class, name_a < name_b by code point."""
    a = classes.select("class", F.col("value").alias("name_a"))
    b = classes.select("class", F.col("value").alias("name_b"))
    return a.join(b, "class").where("name_a < name_b").select("name_a", "name_b")
