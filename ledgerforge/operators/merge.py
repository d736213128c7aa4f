"""Idempotent writes as plans: the state after an operation, from the old state and the new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows of the new rows' keys give way to the new rows."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def upsert_latest(old: DataFrame, new: DataFrame, key: str, version: list[str]) -> DataFrame:
    """One row a key: the one with the highest version, the new one among equals."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return both.groupBy(key).agg(F.max_by(F.struct(*old.columns), F.struct(*version, "_new")).alias("_r")).select("_r.*")


def upsert_preserve(old: DataFrame, new: DataFrame, key: str, preserve: list[str]) -> DataFrame:
    """New values win, but the old row's ``preserve`` columns are kept where it has them."""
    cols = [c for c in old.columns if c != key]
    o = old.select(key, F.lit(True).alias("_o"), *[F.col(c).alias(f"o_{c}") for c in cols])
    n = new.select(key, F.lit(True).alias("_n"), *[F.col(c).alias(f"n_{c}") for c in cols])

    def pick(c: str) -> Column:
        return F.coalesce(f"o_{c}", f"n_{c}") if c in preserve else F.when(F.col("_n"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))

    return o.join(n, key, "full").select(key, *[pick(c).alias(c) for c in cols])


def patch(old: DataFrame, changes: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Old rows with the non-null cells of ``changes``, which has one row a key."""
    c = changes.select(key, *[F.col(x).alias(f"_p_{x}") for x in cols])
    out = old.join(c, key, "left")
    for x in cols:
        out = out.withColumn(x, F.coalesce(f"_p_{x}", x)).drop(f"_p_{x}")
    return out


def enqueue(tasks: DataFrame, new: DataFrame, key: str, guess: str, status: str, open_states: tuple[str, ...] = ("pending", "failed", "claimed")) -> DataFrame:
    """New tasks are added; the guess of open ones is refreshed; finished ones stay as they are."""
    n = new.select(key, F.col(guess).alias("_g")).distinct()
    kept = tasks.join(n, key, "left").withColumn(guess, F.when(F.col(status).isin(*open_states), F.coalesce("_g", guess)).otherwise(F.col(guess))).drop("_g")
    added = new.join(tasks.select(key), key, "left_anti").dropDuplicates([key])
    return kept.unionByName(added.select(*tasks.columns))


def claim(tasks: DataFrame, wanted: DataFrame, key: str, status: str = "status", attempts: str = "attempts") -> DataFrame:
    """Wanted tasks that are pending, failed or in review become claimed, their attempts one more."""
    w = wanted.select(key).distinct().withColumn("_w", F.lit(True))
    t = tasks.join(w, key, "left").withColumn("_take", F.coalesce("_w", F.lit(False)) & F.col(status).isin("pending", "failed", "review"))
    return t.withColumn(status, F.when(F.col("_take"), "claimed").otherwise(F.col(status))).withColumn(attempts, F.col(attempts) + F.col("_take").cast("int")).drop("_w", "_take")


def merge_readings(native: DataFrame, other: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """Pages of two readings: the longer text wins, the native one among equals; pages of one side are kept."""
    a, b = native.select(*key, F.col(text).alias("_a")), other.select(*key, F.col(text).alias("_b"))
    n = lambda c: F.coalesce(F.length(c), F.lit(-1))
    return a.join(b, key, "full").select(*key, F.when(n("_b") > n("_a"), F.col("_b")).otherwise(F.col("_a")).alias(text), F.when(n("_b") > n("_a"), "other").otherwise("native").alias("reading"))


def multiset_diff(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose number differs: n_a and n_b. Nulls are equal to nulls."""
    one = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    return one.groupBy(*cols).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b")).where("n_a <> n_b")


def cell_diff(a: DataFrame, b: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """(key, field, value_a, value_b) of all cells that differ; a missing row differs in no cell but in the field ``row``."""
    x = a.select(key, F.lit("x").alias("_a"), *[F.col(c).cast("string").alias(f"a_{c}") for c in cols])
    y = b.select(key, F.lit("x").alias("_b"), *[F.col(c).cast("string").alias(f"b_{c}") for c in cols])
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    cells = F.array(F.struct(F.lit("row").alias("field"), F.col("_a").alias("value_a"), F.col("_b").alias("value_b"), F.lit(True).alias("keep")), *[F.struct(F.lit(c).alias("field"), F.col(f"a_{c}").alias("value_a"), F.col(f"b_{c}").alias("value_b"), both.alias("keep")) for c in cols])
    return x.join(y, key, "full").select(key, F.explode(cells).alias("c")).where("c.keep and not (c.value_a <=> c.value_b)").select(key, "c.field", "c.value_a", "c.value_b")
