"""Operators on ordered rows: as-of inheritance, filling, votes, ranges, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def asof_inherit(df: DataFrame, by: str, order: str, label: str, back: int, guard: str | None = None, out: str = "inherited") -> DataFrame:
    """``label``, or the one of the nearest earlier row of the group at most ``back`` before it in ``order``.

    The frame is a range, so gaps in ``order`` count. guard: a column that must be equal on both rows.
    ``order`` must be unique in the group.
    """
    w = W.partitionBy(by).orderBy(order).rangeBetween(-back, -1)
    src = F.struct(F.col(label).alias("v"), (F.col(guard) if guard else F.lit(0)).alias("g"))
    prior = F.last(F.when(F.col(label).isNotNull(), src), ignorenulls=True).over(w)
    d = df.withColumn("_prior", prior)
    ok = F.col("_prior.g") == F.col(guard) if guard else F.lit(True)
    return d.withColumn(out, F.coalesce(F.col(label), F.when(ok, F.col("_prior.v")))).drop("_prior")


def fill_forward(df: DataFrame, by: str, order: list[str], col: str, out: str) -> DataFrame:
    """The latest value so far; before the first one, the group's first."""
    w = W.partitionBy(by).orderBy(*order)
    return df.withColumn(out, F.coalesce(F.last(col, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.first(col, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))))


def majority(df: DataFrame, by: str, value: str, out: str = "winner") -> DataFrame:
    """The most frequent non-null value of each group, the least among equals: two partial aggregations, no group in one place."""
    n = df.where(F.col(value).isNotNull() & F.col(by).isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"))
    most = n.groupBy(by).agg(F.max("n").alias("n"), F.count("*").alias("n_values"))
    return n.join(most, [by, "n"]).groupBy(by).agg(F.min(value).alias(out), F.max("n").alias("n_votes"), F.max("n_values").alias("n_values"))


def vote_align(df: DataFrame, by: str, value: str) -> DataFrame:
    """``value`` replaced by the majority of its group where the group has several."""
    won = majority(df, by, value).where("n_values > 1").select(by, "winner")
    return df.join(won, by, "left").withColumn("aligned", F.coalesce("winner", value)).drop("winner")


def keep_first(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """The first row of each group by ``order``, which must be total; by max_by, not by a sort of the group."""
    cols = df.columns
    return df.groupBy(by).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r")).select("_r.*")


def label_ranges(df: DataFrame, doc: str, page: str, label: str) -> DataFrame:
    """(doc, label, start, end): a part starts at the first page of each new label and ends before the next part."""
    first = df.where(F.col(label).isNotNull()).groupBy(doc, label).agg(F.min(page).alias("start_page"))
    last = df.groupBy(doc).agg(F.max(page).alias("_last"))
    w = W.partitionBy(doc).orderBy("start_page", label)
    return first.join(last, doc).withColumn("end_page", F.coalesce(F.lead("start_page").over(w) - 1, F.col("_last"))).drop("_last")


def chunks(df: DataFrame, by: str, order: list[str], size: int, out: str = "chunk") -> DataFrame:
    """Rows of a group numbered in chunks of ``size`` from 0."""
    return df.withColumn(out, F.floor((F.row_number().over(W.partitionBy(by).orderBy(*order)) - 1) / size).cast("int"))
