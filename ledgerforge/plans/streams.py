"""Queries of the queue and of the whole pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.operators.lines import explode_pages, pages_or_text
from ledgerforge.plans import pipeline
from ledgerforge.plans.ordered import PAGES
from ledgerforge.plans.registry import Registry
from ledgerforge.session import table
from ledgerforge.streaming.delivery import delivery_batch

query = Registry()


@query("""WITH e AS (SELECT user_id AS task, event_type = 'error' AS f, event_type = 'purchase' AS d, epoch_us(ts) AS us, event_id AS ord FROM events),
w AS (SELECT task, min(CASE WHEN d THEN struct_pack(us := us, ord := ord) END) AS won FROM e GROUP BY 1),
r AS (SELECT e.task, us, row_number() OVER (PARTITION BY e.task ORDER BY us, ord) AS k FROM e JOIN w USING (task) WHERE f AND (won IS NULL OR us < won.us OR (us = won.us AND ord < won.ord))),
n AS (SELECT task, CAST(max(k) AS INTEGER) AS attempts, max(us) AS last FROM r WHERE k <= 3 GROUP BY 1),
t AS (SELECT w.task, coalesce(attempts, 0) AS attempts, last, won FROM w LEFT JOIN n USING (task)),
s AS (SELECT *, CASE WHEN attempts >= 3 THEN 'FAILED_PERMANENT' WHEN won IS NOT NULL THEN 'DELIVERED' WHEN attempts > 0 THEN 'RETRY_WAIT' ELSE 'QUEUED' END AS status FROM t)
SELECT task, status, attempts, CASE WHEN status = 'RETRY_WAIT' THEN last + CAST(5000000 * pow(2, attempts - 1) AS BIGINT) END AS next_attempt_us FROM s""")
def delivery_state(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return delivery_batch(e, "user_id", F.col("event_type") == "error", F.col("event_type") == "purchase", "ts", "event_id")


@query()
def map_documents(spark: SparkSession, d: str) -> DataFrame:
    """The proved rows of all documents, every tab, out of their pages."""
    rows = pipeline.map_pages(pages_or_text(table(spark, d, "documents")))
    return rows.select("doc_id", "page", "class", "line_no", "code", "name", "qty", "unit", "price", "total", "gate", "discount", "cartons", "pieces")


@query(rf"""WITH {PAGES}, c AS (SELECT doc_id, page, text, CASE WHEN regexp_matches(upper(text), '(?m)^\s*FAKTUR PENJUALAN') THEN 'FAKTUR_PENJUALAN' ELSE 'X' END AS class FROM pages)
SELECT class, count(*) AS n_pages, count_if(regexp_matches(text, '(?m)^(NO ITEM QTY|No Kode|Line SKU)')) AS n_tables FROM c GROUP BY class""")
def page_census(spark: SparkSession, d: str) -> DataFrame:
    p = explode_pages(table(spark, d, "documents"))
    c = F.when(F.upper("text").rlike(r"(?m)^\s*FAKTUR PENJUALAN"), "FAKTUR_PENJUALAN").otherwise("X")
    return p.groupBy(c.alias("class")).agg(F.count("*").alias("n_pages"), F.count_if(F.col("text").rlike(r"(?m)^(NO ITEM QTY|No Kode|Line SKU)")).alias("n_tables"))
