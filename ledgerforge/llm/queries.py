"""Queries of the training-data operators, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.llm import canonical, leaks, mixing, spellings, survivor, toxic
from ledgerforge.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every row of a group votes for itself as the best, and as the giver of the vendor code where it has one, by trust and age."""
    coded = F.when(survivor.vendor_code(F.col("vendor_code")).isNotNull(), F.col("id"))
    rows = survivor.line_groups(table(spark, d, "po_customer"), {"votes": survivor.reading_votes(), "coded": coded})
    won = survivor.survive(rows, "group_key", {"best": F.col("id"), "vendor_code": F.col("coded")}, weight=F.col("votes"), keep=("best", "vendor_code"), least=2)
    return won.select(F.col("first_id").alias("group_first_id"), "best_id", F.coalesce("vendor_code_id", F.lit(-1)).cast("bigint").alias("vendor_code_id"))


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The row built for each group: each field's value with most trust times recency."""
    fields = {
        "purchase_order_no": survivor.order_number(F.col("purchase_order_no")),
        "vendor_code": survivor.vendor_code(F.col("vendor_code")),
        "confidence": survivor.confidence_level(F.col("confidence")),
        "uon": F.nullif(F.upper(F.trim("uon")), F.lit("")),
        "unit_price": F.col("unit_price"),
        "total": F.col("total"),
    }
    carry = {"first": survivor.reading_order(), "trust": survivor.reading_trust(), "updated": F.col("updated_at"), **{f"f_{n}": c for n, c in fields.items()}}
    rows = survivor.grouped(table(spark, d, "po_customer"), carry)
    votes = survivor.decayed(F.col("trust"), F.col("updated"), F.col("_latest"))
    won = survivor.survive(rows, "group_key", {n: F.col(f"f_{n}") for n in fields}, weight=votes, precedence=F.col("first"))
    return won.select("group_key", *fields, *[f"{c}_id" for c in ("purchase_order_no", "vendor_code", "confidence")])


def _issuers(spark: SparkSession, d: str) -> list[tuple]:
    return canonical.bounded_rows(table(spark, d, "issuer_list").select("issuer_code", "brand", "pt"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    po = table(spark, d, "po_customer")
    units = canonical.bounded_rows(table(spark, d, "uon_list").select("uon_code", "uon_name", "uon_name_en"))
    issuers = _issuers(spark, d)
    return canonical.map_values(po.select("po_issuer"), "po_issuer", canonical.Matcher("issuer", issuers)).unionByName(canonical.map_values(po.select("uon"), "uon", canonical.Matcher("unit", units)))


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The report of values without entry, with the rows that hold them."""
    po = table(spark, d, "po_customer")
    counts = po.select(F.lit("po_issuer").alias("field"), F.col("po_issuer").alias("raw_value")).unionByName(po.select(F.lit("uon").alias("field"), F.col("uon").alias("raw_value"))).groupBy("field", "raw_value").agg(F.count("*").alias("n_rows"))
    return p2_found(spark, d).where("canonical_key = ''").join(counts, ["field", "raw_value"]).select("field", "raw_value", "n_rows")


def _spellings(spark: SparkSession, d: str) -> DataFrame:
    issuers = _issuers(spark, d)
    values = table(spark, d, "po_customer").select(F.col("po_issuer").alias("v")).union(table(spark, d, "faktur_pajak").select("nama_pembeli"))
    return spellings.spelling_classes(values, canonical.line_words([r[2] for r in issuers if r[2]]), frozenset(r[1].upper() for r in issuers if r[1]))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return spellings.spelling_pairs(_spellings(spark, d))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row a spelling with its class and the number of spellings it is linked to."""
    c = _spellings(spark, d)
    return c.join(c.groupBy("class").agg((F.count("*") - 1).alias("n_links")), "class").select(F.col("value").alias("spelling"), "class", "n_links")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    items = canonical.bounded_rows(table(spark, d, "eval_items").select("item_id", "text"), leaks.MOST_ITEMS)
    return leaks.find_leaks(table(spark, d, "documents"), items)


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items with the documents that carry them, by source."""
    found = p6_found(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return found.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.countDistinct("source").alias("n_sources"))


def _targets(spark: SparkSession, d: str) -> list[tuple]:
    return canonical.bounded_rows(table(spark, d, "mix_targets").select("source", "target_share", "max_repeats"), mixing.MOST_SOURCES)


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    sizes = mixing.sized(table(spark, d, "documents"))
    return mixing.draw(sizes, mixing.plan_mix(sizes, _targets(spark, d))[0])


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached by the whole, half and a tenth of the largest budget."""
    sizes, targets = mixing.sized(table(spark, d, "documents")), _targets(spark, d)
    return mixing.report(sizes, targets, mixing.plan_mix(sizes, targets, (0.1, 0.5, 1.0)))


#: The expectation below which a passage is significant: chance may give three of a hundred thousand ordinary texts.
SIGNIFICANT = 3e-5


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return toxic.score_documents(docs, *toxic.fit(docs, table(spark, d, "review_labels")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_scores(spark, d).where(F.col("expectation") <= SIGNIFICANT).select("doc_id")


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    bad = (F.col("expectation") <= SIGNIFICANT).cast("int")
    return p8_scores(spark, d).groupBy("source").agg(F.count("*").alias("n_documents"), F.sum(bad).alias("n_bad"), F.round(F.avg(bad), 6).alias("rate"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_survivors": p1_survivors,
    "p2_found": p2_found,
    "p2_unmatched": p2_unmatched,
    "p5_found": p5_found,
    "p5_classes": p5_classes,
    "p6_found": p6_found,
    "p6_report": p6_report,
    "p7_mix": p7_mix,
    "p7_report": p7_report,
    "p8_found": p8_found,
    "p8_scores": p8_scores,
    "p8_rates": p8_rates,
}

def _words_sql() -> str:
    s = "regexp_replace(upper(product_name), '[^A-Z0-9]+', ' ', 'g')"
    for digit, letter in (("4", "A"), ("0", "O"), ("1", "I"), ("5", "S"), ("8", "B"), ("6", "G")):
        s = rf"regexp_replace(regexp_replace({s}, '([A-Z]){digit}', '\1{letter}', 'g'), '{digit}([A-Z][A-Z])', '{letter}\1', 'g')"
    return rf"trim(regexp_replace({s}, '(\d )G$', '\1GR'))"


_RANK = "CASE lower(trim(confidence)) WHEN 'high' THEN 3 WHEN 'tinggi' THEN 3 WHEN 'medium' THEN 2 WHEN 'sedang' THEN 2 WHEN 'low' THEN 1 WHEN 'rendah' THEN 1 ELSE 0 END"
_NULLS = " + ".join(f"({c} IS NULL)::INT" for c in survivor.OWN)

SQL: dict[str, str] = {
    "p1_found": rf"""
WITH n AS (SELECT *, nullif(translate(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(trim(purchase_order_no)), '\.0$', ''), '^.*:', ''), '[^A-Z0-9]', '', 'g'), '^PO(.{{6}})', '\1'), 'OILSBZGQ', '01158269'), '') AS po,
  regexp_replace(regexp_replace(regexp_replace(upper(trim(vendor_code)), '^.*:', ''), '\.0$', ''), '\s', '', 'g') AS v, nullif(regexp_extract(folder, '/(\d{{6,}}) - ', 1), '') AS fc, {_words_sql()} AS words,
  CASE WHEN regexp_matches(trim(product_code), '^\d{{4,}}$') THEN trim(product_code) END AS code FROM po_customer),
b AS (SELECT *, CASE WHEN regexp_matches(v, '^\d+$') AND NOT regexp_matches(v, '^0+$') THEN v END AS vc, coalesce(document_id, '?' || coalesce(po, CAST(id AS VARCHAR))) AS doc FROM n),
d AS (SELECT doc, mode(po) AS major, mode(fc) AS folder_code, mode(vc) AS vendor FROM b GROUP BY doc),
o AS (SELECT b.*, coalesce(folder_code, vendor, '?') || '/' || coalesce(CASE WHEN regexp_matches(po, '^\w{{6,}}$') AND levenshtein(po, major) > 3 THEN po ELSE major END, '#' || doc) AS ord FROM b JOIN d USING (doc)),
nm AS (SELECT words, mode(code) AS named FROM o WHERE code IS NOT NULL GROUP BY words),
p AS (SELECT o.*, coalesce(code, named) AS product FROM o LEFT JOIN nm USING (words)),
near AS (SELECT x.ord, x.words, arg_min(y.product, levenshtein(x.words, y.words)) AS near FROM (SELECT DISTINCT ord, words FROM p WHERE product IS NULL) x JOIN (SELECT DISTINCT ord, words, product FROM p WHERE product IS NOT NULL) y
  ON x.ord = y.ord AND levenshtein(x.words, y.words) <= 3 GROUP BY 1, 2),
q AS (SELECT p.* EXCLUDE (product), coalesce(product, near, '~' || p.words, '') AS product FROM p LEFT JOIN near ON near.ord = p.ord AND near.words = p.words),
l AS (SELECT DISTINCT ord, product, qty, total, unit_price, discount FROM q WHERE qty IS NOT NULL),
s AS (SELECT e.id, l.qty, max(CASE WHEN round((e.total + coalesce(e.discount, 0))::DECIMAL(28,6) / nullif(e.unit_price, 0), 2) = l.qty THEN 8 ELSE 0 END + CASE WHEN e.total = l.total THEN 4 ELSE 0 END + CASE WHEN e.unit_price = l.unit_price THEN 1 ELSE 0 END
  + CASE WHEN e.discount = l.discount AND e.discount > 0 THEN 2 ELSE 0 END) AS sc FROM q e JOIN l ON e.qty IS NULL AND e.ord = l.ord AND e.product = l.product GROUP BY 1, 2),
f AS (SELECT id, arg_max(qty, struct_pack(sc := sc, qty := qty)) AS fq FROM s GROUP BY id HAVING count(*) = 1 OR max(sc) > 1),
g AS (SELECT q.*, ord || '|' || product || '|' || coalesce(CAST(coalesce(qty, fq) AS VARCHAR), '?' || coalesce(CAST(total AS VARCHAR), CAST(q.id AS VARCHAR))) AS grp FROM q LEFT JOIN f USING (id)),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY {_RANK} DESC, {_NULLS}, coalesce(updated_at, TIMESTAMP '0001-01-01') DESC, id) AS k, count(*) OVER (PARTITION BY grp) AS m FROM g)
SELECT min(id) AS group_first_id, max(CASE WHEN k = 1 THEN id END) AS best_id, CAST(coalesce(arg_min(CASE WHEN vc IS NOT NULL THEN id END, CASE WHEN vc IS NOT NULL THEN k END), -1) AS BIGINT) AS vendor_code_id FROM r WHERE m > 1 GROUP BY grp""",
}
