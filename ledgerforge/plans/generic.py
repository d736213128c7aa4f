"""Queries of the general problems: units and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.operators.shred import LONE_KEYS, shred_column, shred_json
from ledgerforge.operators.units import delivered_amounts
from ledgerforge.session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return delivered_amounts(table(spark, d, "faktur_penjualan")).select("id", "base_unit", "base_qty")


def p3_amounts(spark: SparkSession, d: str) -> DataFrame:
    """The same with the pieces (or base units) in one unit of qty and whether text or price says so."""
    return delivered_amounts(table(spark, d, "faktur_penjualan"))


def _objects(spark: SparkSession, d: str, values: bool) -> DataFrame:
    docs = shred_json(table(spark, d, "documents"), "doc_id", "standard_json", values=values, root=values)
    rows = shred_column(table(spark, d, "invoice_rows"), "id", "line_items", values=values)
    return docs.withColumn("table_name", F.lit("documents")).unionByName(rows.withColumn("table_name", F.lit("invoice_rows")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _objects(spark, d, False).select("table_name", "record_id", "path", "parent_path")


def p4_tables(spark: SparkSession, d: str) -> DataFrame:
    """The flat tables in one: each object with the table that it belongs to and its own fields; documents themselves have the table ''."""
    return _objects(spark, d, True).select("table_name", "table_path", "record_id", "path", "parent_path", F.to_json("fields").alias("fields"))


QUERIES = {"p3_found": p3_found, "p3_amounts": p3_amounts, "p4_found": p4_found, "p4_tables": p4_tables}

_LONE = "|".join(LONE_KEYS)
# A lone object under one of the keys stands in a path as ``key.`` where an element stands as ``key[0].``
_ELEMENT = rf"regexp_replace({{}}, '(^|\.)({_LONE})(\.|$)', '\1\2[0]\3', 'g')"
_PATH = _ELEMENT.format(_ELEMENT.format("substr(t.fullkey, 3)"))

SQL: dict[str, str] = {
    "p4_found": rf"""
WITH d AS (SELECT doc_id, CASE WHEN json_valid(standard_json) THEN CASE WHEN starts_with(standard_json, '"') THEN json_extract_string(standard_json, '$') ELSE standard_json END END AS b FROM documents),
ok AS (SELECT doc_id, b FROM d WHERE b IS NOT NULL AND json_valid(b)),
objects AS (SELECT 'documents' AS table_name, doc_id AS record_id, {_PATH} AS path FROM ok, json_tree(CAST(b AS JSON)) AS t WHERE t.type = 'OBJECT'
  UNION ALL SELECT 'invoice_rows', invoice_rows.id, substr(t.fullkey, 3) FROM invoice_rows, json_tree(to_json({{'line_items': line_items}})) AS t WHERE t.type = 'OBJECT')
SELECT table_name, record_id, path, regexp_extract(regexp_replace(path, '\[\d+\]$', ''), '^(.*\])', 1) AS parent_path FROM objects WHERE regexp_matches(path, '\]$')""",
}
