"""Arithmetic checks: a row is proved, or says why it isn't. Values are never changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerforge.functions.money import near
from ledgerforge.functions.status import add_tag

#: The tax rates that a gross amount may hold, as printed, and their factors.
RATES = (("11", "11%", "1.11"), ("1.1", "1.1%", "1.011"))


def line_gate(df: DataFrame, qty: str, price: str, discount: str, total: str, share: float = 0.02, least: float = 0.0, out: str = "gate", rate: str | None = None) -> DataFrame:
    """qty x price - discount against total: OK, GROSS-11, GROSS-1.1, REVIEW-ARITH, or VERIFY if an operand is null.

    A null discount counts as none. rate: the column with the row's printed rate; only a total that holds the row's own
    rate is gross, without a known rate none is.
    """
    net = (F.col(qty) * F.col(price) - F.coalesce(F.col(discount), F.lit(0))).cast("decimal(28,4)")
    t = F.col(total)
    status = F.when(net.isNull() | t.isNull(), "VERIFY").when(near(net, t, least, share), "OK")
    for name, printed, f in RATES if rate else ():
        status = status.when((F.col(rate) == printed) & near((net * F.lit(f).cast("decimal(6,4)")).cast("decimal(28,4)"), t, least, share), f"GROSS-{name}")
    return df.withColumn(out, status.otherwise("REVIEW-ARITH"))


def first_error(df: DataFrame, rules: list[tuple[str, Column]], out: str = "error") -> DataFrame:
    """The name of the first rule that a row breaks; null if none. A rule that is null isn't broken."""
    c = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        c = F.when(F.coalesce(broken, F.lit(False)), name).otherwise(c)
    return df.withColumn(out, c)


def tax_fits(base: Column, tax: Column, least: float = 500.0, share: float = 0.01) -> Column:
    """Whether the tax is one of the rates of its base; null if one is missing."""
    return near((base * F.lit("0.11").cast("decimal(6,4)")).cast("decimal(28,4)"), tax, least, share) | near((base * F.lit("0.011").cast("decimal(6,4)")).cast("decimal(28,4)"), tax, least, share)


def tag_mismatch(df: DataFrame, status: str, fits: Column, tag: str) -> DataFrame:
    return df.withColumn(status, add_tag(F.col(status), tag, F.coalesce(~fits, F.lit(False))))


def sum_against(items: DataFrame, heads: DataFrame, key: str, amount: str, printed: str, least: float, share: float) -> DataFrame:
    """Each head with the sum and number of its items and PASS, REVIEW or NO_ITEMS."""
    sums = items.groupBy(key).agg(F.sum(amount).cast("decimal(28,4)").alias("items_total"), F.count(amount).alias("n_items"))
    h = heads.join(sums, key, "left").withColumn("n_items", F.coalesce("n_items", F.lit(0)))
    ok = near(F.col("items_total"), F.col(printed).cast("decimal(28,4)"), least, share)
    return h.withColumn("status", F.when(F.col("n_items") == 0, "NO_ITEMS").when(ok, "PASS").otherwise("REVIEW"))


def spread_footers(df: DataFrame, page: list[str], marker: Column, amount: str = "jumlah") -> DataFrame:
    """Page footers given to the items of their page; a footer without items stays, as the page's only row.

    base and tax fill nulls of the items; page_total is the printed total if base + tax proves it within 2 %,
    else base + tax, else the sum of the page's items.
    """
    spread = lambda c: F.max(F.when(marker, F.col(c))).over(W.partitionBy(*page))
    w = W.partitionBy(*page)
    own = df.withColumn("_marker", marker).withColumn("_n", F.count(F.when(~marker, F.lit(1))).over(w))
    own = own.withColumn("_base", spread("dasar_pengenaan_pajak")).withColumn("_tax", spread("ppn")).withColumn("_total", spread("total")).withColumn("_sum", F.sum(F.when(~marker, F.col(amount))).over(w))
    gross = F.col("_base") + F.col("_tax")
    printed = F.when((F.col("_total") >= F.col("_base")) & (F.abs(F.col("_total") - gross) <= F.col("_total") * F.lit("0.02").cast("decimal(4,2)")), F.col("_total"))
    out = own.withColumn("page_total", F.coalesce(printed, gross, F.col("_sum"), F.when(F.col("_marker"), F.col("_total"))).cast("decimal(18,2)"))
    out = out.withColumn("dasar_pengenaan_pajak", F.coalesce("dasar_pengenaan_pajak", "_base")).withColumn("ppn", F.coalesce("ppn", "_tax"))
    return out.where(~F.col("_marker") | (F.col("_n") == 0)).drop("_marker", "_n", "_base", "_tax", "_total", "_sum")
