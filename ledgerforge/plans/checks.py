"""Arithmetic checks on the target tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import text
from ledgerforge.functions.money import near
from ledgerforge.operators import audit, gates
from ledgerforge.operators.lines import explode_pages
from ledgerforge.plans.registry import Registry
from ledgerforge.session import table

query = Registry()

#: The own firm, which is neither vendor nor issuer of an order: its name, and how it is told in any writing.
SELF, OWN = "PT MUTO KOSUME PANGAN TBK", "MUTO KOSUME"

_NET = "CAST(qty * unit_price - coalesce(discount, 0) AS DECIMAL(28,4))"


def _near(a: str, b: str, least: str, share: str) -> str:
    return f"abs({a} - {b}) <= greatest(CAST({least} AS DECIMAL(18,4)), abs({b}) * CAST({share} AS DECIMAL(6,4)))"


def _gate_sql(least: str, share: str) -> str:
    return f"""CASE WHEN {_NET} IS NULL OR total IS NULL THEN 'VERIFY' WHEN {_near(_NET, 'total', least, share)} THEN 'OK'
  WHEN ppn = '11%' AND {_near(f"CAST({_NET} * CAST(1.11 AS DECIMAL(6,4)) AS DECIMAL(28,4))", 'total', least, share)} THEN 'GROSS-11'
  WHEN ppn = '1.1%' AND {_near(f"CAST({_NET} * CAST(1.011 AS DECIMAL(6,4)) AS DECIMAL(28,4))", 'total', least, share)} THEN 'GROSS-1.1' ELSE 'REVIEW-ARITH' END"""


@query(f"SELECT id, {_gate_sql('0', '0.02')} AS gate FROM po_customer")
def po_gate(spark: SparkSession, d: str) -> DataFrame:
    return gates.line_gate(table(spark, d, "po_customer"), "qty", "unit_price", "discount", "total", rate="ppn").select("id", "gate")


@query(f"""SELECT CASE WHEN g IN ('OK', 'GROSS-11', 'GROSS-1.1') THEN 'MAPPED' ELSE 'REVIEW-ARITH' END AS status, g AS gate, count(*) AS n
FROM (SELECT {_gate_sql('1', '0.001')} AS g FROM po_customer) GROUP BY 1, 2""")
def po_audit(spark: SparkSession, d: str) -> DataFrame:
    g = gates.line_gate(table(spark, d, "po_customer"), "qty", "unit_price", "discount", "total", 0.001, 1.0, rate="ppn")
    return g.withColumn("status", F.when(F.col("gate").isin("OK", "GROSS-11", "GROSS-1.1"), "MAPPED").otherwise("REVIEW-ARITH")).groupBy("status", "gate").agg(F.count("*").alias("n"))


@query(f"""WITH g AS (SELECT id, mapping_status, CASE WHEN product_name IS NULL OR trim(product_name) = '' THEN 'NAME' WHEN upper(trim(vendor_code)) = '{SELF}' OR regexp_matches(upper(trim(po_issuer)), '{OWN}') THEN 'SELF'
  WHEN ppn IS NOT NULL AND ppn NOT IN ('', '11%', '1.1%') THEN 'RATE' WHEN {_gate_sql('1', '0.02')} = 'REVIEW-ARITH' THEN 'ARITH' END AS error FROM po_customer)
SELECT id, error, CASE WHEN error IS NOT NULL AND starts_with(coalesce(mapping_status, ''), 'MAPPED') THEN 'REVIEW-' || error || '|' || mapping_status ELSE mapping_status END AS status FROM g""")
def server_gate(spark: SparkSession, d: str) -> DataFrame:
    g = gates.line_gate(table(spark, d, "po_customer"), "qty", "unit_price", "discount", "total", 0.02, 1.0, rate="ppn")
    rules = [
        ("NAME", F.col("product_name").isNull() | (F.trim("product_name") == "")),
        ("SELF", F.coalesce(F.upper(F.trim("vendor_code")) == SELF, F.lit(False)) | F.upper(F.trim("po_issuer")).rlike(OWN)),
        ("RATE", F.col("ppn").isNotNull() & ~F.col("ppn").isin("", "11%", "1.1%")),
        ("ARITH", F.col("gate") == "REVIEW-ARITH"),
    ]
    e = gates.first_error(g, rules)
    demote = F.col("error").isNotNull() & F.coalesce(F.col("mapping_status"), F.lit("")).startswith("MAPPED")
    return e.select("id", "error", F.when(demote, F.concat(F.lit("REVIEW-"), "error", F.lit("|"), "mapping_status")).otherwise(F.col("mapping_status")).alias("status"))


def _tax_sql(base: str, tax: str) -> str:
    r = [_near(f"CAST({base} * CAST({x} AS DECIMAL(6,4)) AS DECIMAL(28,4))", tax, "500", "0.01") for x in ("0.11", "0.011")]
    return f"({r[0]} OR {r[1]})"


@query(f"""SELECT id, CASE WHEN {_tax_sql('dasar_pengenaan_pajak', 'ppn')} THEN 'yes' WHEN NOT {_tax_sql('dasar_pengenaan_pajak', 'ppn')} THEN 'no' END AS fits, CASE WHEN NOT coalesce({_tax_sql('dasar_pengenaan_pajak', 'ppn')}, true)
  AND NOT list_contains(string_split(coalesce(review_status, ''), '|'), 'PPN-DPP-MISMATCH') THEN concat_ws('|', nullif(review_status, ''), 'PPN-DPP-MISMATCH') ELSE review_status END AS review_status FROM faktur_pajak""")
def ppn_dpp(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "faktur_pajak").withColumn("fits", gates.tax_fits(F.col("dasar_pengenaan_pajak"), F.col("ppn")))
    return gates.tag_mismatch(t, "review_status", F.col("fits"), "PPN-DPP-MISMATCH").select("id", F.when(F.col("fits"), "yes").when(~F.col("fits"), "no").alias("fits"), "review_status")


_DISC = "(coalesce(disc_1, 0) + coalesce(disc_2, 0) + coalesce(disc_3, 0) + coalesce(disc_4, 0) + coalesce(disc_5, 0))"
_PACK = r"""WITH lead AS (SELECT *, regexp_extract(upper(trim(kemasan)), '^(\d+(?:\s*[X*]\s*\d+)*)(?:\s*[X*].*)?$', 1) AS lead FROM faktur_penjualan),
p AS (SELECT *, CASE WHEN len(list_filter(regexp_split_to_array(lead, '\s*[X*]\s*'), lambda x: regexp_matches(x, '^\d{1,6}$'))) > 0
  THEN CAST(list_product(list_transform(list_filter(regexp_split_to_array(lead, '\s*[X*]\s*'), lambda x: regexp_matches(x, '^\d{1,6}$')), lambda x: CAST(x AS BIGINT))) AS BIGINT) END AS pack FROM lead)"""


def _fp_sql(factor: str) -> str:
    return _near(f"CAST(CAST(harga AS DECIMAL(20,4)) * CAST(qty * {factor} AS DECIMAL(18,4)) - {_DISC} AS DECIMAL(28,4))", "jumlah", "1", "0.001")


def _discounts() -> object:
    return sum((F.coalesce(F.col(f"disc_{i}"), F.lit(0)) for i in range(1, 6)), F.lit(0))


def _fp_fit(factor: object) -> object:
    return near((F.col("harga") * (F.col("qty") * factor) - _discounts()).cast("decimal(28,4)"), F.col("jumlah"), 1.0, 0.001)


@query(f"""{_PACK}
SELECT id, CASE WHEN coalesce({_fp_sql('pack')}, false) OR coalesce({_fp_sql('1')}, false) OR coalesce({_fp_sql('12')}, false) THEN 'PASS' ELSE 'REVIEW-ARITH' END AS status FROM p
WHERE coalesce(mapping_status, '') <> 'FOOTER-ONLY'""")
def fp_audit(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "faktur_penjualan").where("coalesce(mapping_status, '') <> 'FOOTER-ONLY'").withColumn("pack", text.pack_size(F.col("kemasan")))
    ok = F.coalesce(_fp_fit(F.col("pack")), F.lit(False)) | F.coalesce(_fp_fit(F.lit(1)), F.lit(False)) | F.coalesce(_fp_fit(F.lit(12)), F.lit(False))
    return t.select("id", F.when(ok, "PASS").otherwise("REVIEW-ARITH").alias("status"))


@query(f"""{_PACK}
SELECT 'pieces' AS hypothesis, count_if({_fp_sql('1')}) AS n_fit, count({_fp_sql('1')}) AS n_tested FROM p UNION ALL
SELECT 'dozens', count_if({_fp_sql('12')}), count({_fp_sql('12')}) FROM p UNION ALL
SELECT 'packs', count_if({_fp_sql('pack')}), count({_fp_sql('pack')}) FROM p""")
def hypothesis_test(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "faktur_penjualan").withColumn("pack", text.pack_size(F.col("kemasan")))
    return audit.hypotheses(t, {"pieces": _fp_fit(F.lit(1)), "dozens": _fp_fit(F.lit(12)), "packs": _fp_fit(F.col("pack"))})


_ITEM_OK = _near("CAST(harga_satuan * qty - coalesce(potongan_harga, 0) AS DECIMAL(28,4))", "jumlah_harga", "0.01", "0.0005")


@query(f"""SELECT document_id, count(*) AS n_items, CAST(count_if(coalesce({_ITEM_OK}, false)) AS BIGINT) AS n_pass, CAST(sum(jumlah_harga) AS DECIMAL(26,2)) AS items_total, max(dasar_pengenaan_pajak) AS base,
  CASE WHEN count_if(coalesce({_ITEM_OK}, false)) < count(*) THEN 'MISMATCH' WHEN max(dasar_pengenaan_pajak) IS NULL THEN 'PASS'
    WHEN abs(sum(jumlah_harga) - max(dasar_pengenaan_pajak)) > greatest(CAST(1 AS DECIMAL(18,4)), max(dasar_pengenaan_pajak) * CAST(0.0002 AS DECIMAL(6,4))) THEN 'REVIEW-CROSS' ELSE 'PASS' END AS status
FROM faktur_pajak WHERE document_id IS NOT NULL GROUP BY document_id""")
def efaktur_check(spark: SparkSession, d: str) -> DataFrame:
    ok = F.coalesce(near((F.col("harga_satuan") * F.col("qty") - F.coalesce("potongan_harga", F.lit(0))).cast("decimal(28,4)"), F.col("jumlah_harga"), 0.01, 0.0005), F.lit(False))
    g = table(spark, d, "faktur_pajak").where("document_id is not null").groupBy("document_id").agg(F.count("*").alias("n_items"), F.count_if(ok).alias("n_pass"), F.sum("jumlah_harga").alias("items_total"), F.max("dasar_pengenaan_pajak").alias("base"))
    cross = F.abs(F.col("items_total") - F.col("base")) > F.greatest(F.lit(1).cast("decimal(18,4)"), F.col("base") * F.lit("0.0002").cast("decimal(6,4)"))
    return g.withColumn("status", F.when(F.col("n_pass") < F.col("n_items"), "MISMATCH").when(F.col("base").isNull(), "PASS").when(cross, "REVIEW-CROSS").otherwise("PASS"))


@query(f"""WITH l AS (SELECT l_orderkey, sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(20,6))) AS s, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(s AS DECIMAL(28,4)) AS items_total, coalesce(n, 0) AS n_items, CASE WHEN coalesce(n, 0) = 0 THEN 'NO_ITEMS'
  WHEN {_near("CAST(s AS DECIMAL(28,4))", "CAST(o_totalprice AS DECIMAL(28,4))", "5", "0.002")} THEN 'PASS' ELSE 'REVIEW' END AS status
FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def footer_proof(spark: SparkSession, d: str) -> DataFrame:
    amount = (F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)")) * (1 + F.col("l_tax").cast("decimal(4,2)"))).cast("decimal(20,6)")
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), amount.alias("amount"))
    return gates.sum_against(items, table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", "amount", "o_totalprice", 5.0, 0.002).select("o_orderkey", "items_total", "n_items", "status")


_FOOT = """WITH w AS (SELECT *, coalesce(mapping_status = 'FOOTER-ONLY', false) AS m, count(*) FILTER (WHERE NOT coalesce(mapping_status = 'FOOTER-ONLY', false)) OVER p AS n,
  max(CASE WHEN mapping_status = 'FOOTER-ONLY' THEN dasar_pengenaan_pajak END) OVER p AS b, max(CASE WHEN mapping_status = 'FOOTER-ONLY' THEN ppn END) OVER p AS t,
  max(CASE WHEN mapping_status = 'FOOTER-ONLY' THEN total END) OVER p AS tt, sum(jumlah) FILTER (WHERE NOT coalesce(mapping_status = 'FOOTER-ONLY', false)) OVER p AS s
  FROM faktur_penjualan WINDOW p AS (PARTITION BY document_id, source_page)),
r AS (SELECT id, m, n, coalesce(dasar_pengenaan_pajak, b) AS base, coalesce(ppn, t) AS tax,
  CAST(coalesce(CASE WHEN tt >= b AND abs(tt - (b + t)) <= tt * CAST(0.02 AS DECIMAL(4,2)) THEN tt END, b + t, s, CASE WHEN m THEN tt END) AS DECIMAL(18,2)) AS page_total FROM w)"""


def _footers(spark: SparkSession, d: str) -> DataFrame:
    return gates.spread_footers(table(spark, d, "faktur_penjualan").drop("page_total"), ["document_id", "source_page"], F.coalesce(F.col("mapping_status") == "FOOTER-ONLY", F.lit(False)))


@query(f"{_FOOT} SELECT id, base, tax, page_total FROM r WHERE NOT m OR n = 0")
def page_total(spark: SparkSession, d: str) -> DataFrame:
    return _footers(spark, d).select("id", F.col("dasar_pengenaan_pajak").alias("base"), F.col("ppn").alias("tax"), "page_total")


@query(f"{_FOOT} SELECT id, page_total FROM r WHERE m AND n = 0")
def footer_only(spark: SparkSession, d: str) -> DataFrame:
    return _footers(spark, d).where("mapping_status = 'FOOTER-ONLY'").select("id", "page_total")


@query("""SELECT document_id, source_page, CAST(sum(jumlah) AS DECIMAL(26,2)) AS page_sum, count(*) AS n FROM faktur_penjualan WHERE coalesce(mapping_status, '') <> 'FOOTER-ONLY' GROUP BY 1, 2""")
def page_sum(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "faktur_penjualan").where("coalesce(mapping_status, '') <> 'FOOTER-ONLY'").groupBy("document_id", "source_page").agg(F.sum("jumlah").alias("page_sum"), F.count("*").alias("n"))


@query(r"""WITH j AS (SELECT doc_id, CASE WHEN json_valid(standard_json) THEN CASE WHEN starts_with(standard_json, '"') THEN json_extract_string(standard_json, '$') ELSE standard_json END END AS b FROM documents),
p AS (SELECT doc_id, unnest(CAST(json_extract(b, '$.pages') AS JSON[])) AS p FROM j WHERE json_type(b, '$.pages') = 'ARRAY'),
a AS (SELECT doc_id, count(*) AS n, CAST(sum(length(trim(coalesce(json_extract_string(p, '$.text'), '')))) AS BIGINT) AS chars, count_if(length(trim(coalesce(json_extract_string(p, '$.text'), ''))) < 20) AS n_short FROM p GROUP BY 1)
SELECT doc_id, concat_ws(',', CASE WHEN n IS NULL THEN 'no pages' END, CASE WHEN chars < 20 THEN 'no text' END, CASE WHEN n > 1 AND n_short > 0 THEN 'short page' END) AS flags,
  CASE WHEN n IS NULL OR chars < 20 OR (n > 1 AND n_short > 0) THEN 'FLAGGED' ELSE 'VALIDATED' END AS status FROM documents LEFT JOIN a USING (doc_id)""")
def validate_doc(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "standard_json")
    size = F.length(F.trim("text"))
    a = explode_pages(docs).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(size).alias("chars"), F.count_if(size < 20).alias("n_short"))
    x = docs.select("doc_id").join(a, "doc_id", "left")
    none, empty, short = F.col("n").isNull(), F.coalesce(F.col("chars") < 20, F.lit(False)), F.coalesce((F.col("n") > 1) & (F.col("n_short") > 0), F.lit(False))
    flags = F.concat_ws(",", F.when(none, "no pages"), F.when(empty, "no text"), F.when(short, "short page"))
    return x.select("doc_id", flags.alias("flags"), F.when(none | empty | short, "FLAGGED").otherwise("VALIDATED").alias("status"))


@query("""WITH i AS (SELECT id, unnest(line_items) AS li FROM invoice_rows),
k AS (SELECT id, li.line_no AS line_no, li.item_code AS code, li.description AS name FROM i WHERE li IS NOT NULL),
c AS (SELECT id, code, name, count(*) AS n FROM k GROUP BY 1, 2, 3)
SELECT id, CAST(sum(n) AS BIGINT) AS n_items, CAST(sum(n - 1) AS BIGINT) AS n_repeated, CAST(count_if(name IS NULL OR trim(name) = '') AS BIGINT) AS n_nameless FROM c GROUP BY id""")
def item_validate(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "invoice_rows").select("id", F.explode("line_items").alias("li")).where("li is not null").groupBy("id", F.col("li.item_code").alias("code"), F.col("li.description").alias("name")).agg(F.count("*").alias("n"))
    return i.groupBy("id").agg(F.sum("n").alias("n_items"), F.sum(F.col("n") - 1).alias("n_repeated"), F.count_if(F.col("name").isNull() | (F.trim("name") == "")).alias("n_nameless"))


@query(f"""WITH g AS (SELECT *, {_gate_sql('1', '0.001')} AS gate FROM po_customer)
SELECT 'arithmetic' AS rule, count_if(gate = 'REVIEW-ARITH') AS n_violations, count(*) AS n_rows FROM g UNION ALL
SELECT 'self vendor', count_if(coalesce(upper(trim(vendor_code)) = '{SELF}', false)), count(*) FROM g UNION ALL
SELECT 'no name', count_if(product_name IS NULL OR trim(product_name) = ''), count(*) FROM g UNION ALL
SELECT 'negative', count_if(coalesce(qty < 0 OR total < 0, false)), count(*) FROM g""")
def violations(spark: SparkSession, d: str) -> DataFrame:
    g = gates.line_gate(table(spark, d, "po_customer"), "qty", "unit_price", "discount", "total", 0.001, 1.0, rate="ppn")
    return audit.violations(g, {
        "arithmetic": F.col("gate") == "REVIEW-ARITH", "self vendor": F.upper(F.trim("vendor_code")) == SELF,
        "no name": F.col("product_name").isNull() | (F.trim("product_name") == ""), "negative": (F.col("qty") < 0) | (F.col("total") < 0),
    })
