"""Learning by evidence: what enough rows agree on is promoted, and applied to rows that need it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digits that misreading confuses, both ways.
CONFUSED = (("0", "8"), ("6", "8"), ("1", "4"), ("3", "9"), ("5", "6"))


def promote(df: DataFrame, by: list[str], label: str, least: int, share: float) -> DataFrame:
    """Groups whose most frequent label has at least ``least`` rows and ``share`` of the group: by, label, n, n_group.

    The least label wins ties. Evidence is recomputed from distinct rows, never added up over runs.
    """
    n = df.where(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count("*").alias("n"))
    g = n.groupBy(*by).agg(F.sum("n").alias("n_group"), F.max("n").alias("n"))
    top = n.join(g, [*by, "n"]).groupBy(*by, "n", "n_group").agg(F.min(label).alias(label))
    return top.where((F.col("n") >= least) & (F.col("n") >= F.col("n_group") * F.lit(share).cast("decimal(6,4)")))


def apply_learned(df: DataFrame, learned: DataFrame, by: list[str], label: str, status: str, open_status: str, done: str) -> DataFrame:
    """Rows with ``open_status`` whose label is the one learned for their group get the status ``done``."""
    k = learned.select(*by, F.col(label).alias("_learned"))
    return df.join(k, by, "left").withColumn(status, F.when((F.col(status) == open_status) & (F.col(label) == F.col("_learned")), done).otherwise(F.col(status))).drop("_learned")


def cooccurrence(left: DataFrame, right: DataFrame, on: str, a: str, b: str, least: int, share: float) -> DataFrame:
    """For each a the b that it occurs with most, if often enough: (a, b, n, n_group). One pair counts once an occurrence of ``on``."""
    pairs = left.select(on, a).dropDuplicates().join(right.select(on, b).dropDuplicates(), on)
    return promote(pairs, [a], b, least, share)


def digit_fixes(c: Column) -> Column:
    """All texts that differ from ``c`` by one confused digit, with none twice."""
    maps = {}
    for x, y in CONFUSED:
        maps.setdefault(x, []).append(y)
        maps.setdefault(y, []).append(x)
    swaps = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in sorted(maps) for y in maps[x]])
    at = F.sequence(F.lit(1), F.length(c))
    made = F.flatten(F.transform(at, lambda i: F.transform(F.filter(swaps, lambda s: s["x"] == F.substring(c, i, F.lit(1))), lambda s: F.concat(F.substring(c, F.lit(1), i - 1), s["y"], F.substring(c, i + 1, F.length(c))))))
    return F.when(F.length(c) > 0, F.array_distinct(made))


def quantity_meaning(pack: Column, carton: Column, pieces: Column, price: Column, amount: Column) -> Column:
    """Which reading of a quantity pair gives the amount within 1 %: carton-plus-pieces, cartons, first-number, unexplained; null if an operand is missing."""
    ok = lambda q: F.abs(q * price - amount) <= F.greatest(F.lit(3).cast("decimal(18,4)"), F.abs(amount) * F.lit("0.01").cast("decimal(6,4)"))
    known = carton.isNotNull() & price.isNotNull() & amount.isNotNull()
    return F.when(~known, None).when((pieces > 0) & ok(carton * pack + pieces), "carton-plus-pieces").when(ok(carton * pack), "cartons").when(ok(carton), "first-number").otherwise("unexplained")


def fixpoint(df: DataFrame, step: object, open_rows: Column, most: int | None = None) -> DataFrame:
    """``step`` applied until no open row is settled any more; each round is cut into the shared folder.

    most: rounds after which a state that still gains raises an error, instead of being returned unfinished; None for no bound.
    """
    from ledgerforge.session import cut, drop_cut

    state = cut(df)
    left, rounds = state.where(open_rows).count(), 0
    while left:
        if most is not None and rounds >= most:
            raise RuntimeError(f"no fixpoint after {most} rounds: {left} rows are open")
        new = cut(step(state))
        now = new.where(open_rows).count()
        drop_cut(state)
        state, rounds = new, rounds + 1
        if now >= left:
            break
        left = now
    return state
