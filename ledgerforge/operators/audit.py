"""Coverage, conflicts, fill rates, rollups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_rate(df: DataFrame, cols: list[str]) -> DataFrame:
    """(field, n_rows, n_filled) in one pass over the rows; blank text isn't filled."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))).alias(c) for c in cols])
    return counts.select("_n", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n_filled")) for c in cols])).alias("x")).select("x.field", F.col("_n").alias("n_rows"), "x.n_filled")


def key_conflict(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that hold more than one value. Distinct pairs are pre-aggregated, so a hot key is no set in one task."""
    pairs = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return pairs.groupBy(key).agg(F.count("*").alias("n_values"), F.sum("n").alias("n_rows"), F.min(value).alias("least"), F.max(value).alias("greatest")).where("n_values > 1")


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def filtered_counts(df: DataFrame, by: list[str], conditions: dict[str, Column]) -> DataFrame:
    """One count a condition, in one aggregation."""
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n_violations, n_rows); a rule that is null for a row isn't violated by it."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return counts.select("_n", F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_violations")) for n in rules])).alias("x")).select("x.rule", "x.n_violations", F.col("_n").alias("n_rows"))


def coverage(base: DataFrame, key: str, sides: dict[str, DataFrame]) -> DataFrame:
    """Each key of ``base`` with the number of its rows in every side: sides are aggregated before the join, so nothing fans out."""

    def add(df: DataFrame, side: tuple[str, DataFrame]) -> DataFrame:
        name, rows = side
        return df.join(rows.groupBy(key).agg(F.count("*").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))

    return reduce(add, sides.items(), base)


def json_counts(df: DataFrame, by: str, value: str, out: str = "summary") -> DataFrame:
    """A JSON object of counts by value, keys in order. The values of a group must be few."""
    n = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"))
    return n.groupBy(by).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(value).cast("string"), "n"))))).alias(out))


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col)).limit(n)


def hypotheses(df: DataFrame, fits: dict[str, Column]) -> DataFrame:
    """(hypothesis, n_fit, n_tested): null where an operand is missing and the row isn't tested."""
    counts = df.agg(*[F.count_if(c).alias(f"f_{n}") for n, c in fits.items()], *[F.count(c).alias(f"t_{n}") for n, c in fits.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("hypothesis"), F.col(f"f_{n}").alias("n_fit"), F.col(f"t_{n}").alias("n_tested")) for n in fits])).alias("x")).select("x.*")
