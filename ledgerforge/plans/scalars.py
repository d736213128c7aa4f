"""Scalar functions applied to the tables they are made for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import dates, money, status, text
from ledgerforge.operators import learn
from ledgerforge.plans.registry import Registry
from ledgerforge.session import table

query = Registry()

_MONEY = r"""CASE
  WHEN regexp_matches(s, '^-?\d{1,3}(\.\d{3})+(,\d+)?$') THEN replace(replace(s, '.', ''), ',', '.')
  WHEN regexp_matches(s, '^-?\d{1,3}(,\d{3})+(\.\d+)?$') THEN replace(s, ',', '')
  WHEN regexp_matches(s, '^-?\d+,\d+$') THEN replace(s, ',', '.')
  WHEN regexp_matches(s, '^-?\d+(\.\d+)?$') THEN s END"""


@query(rf"""
WITH raw AS (SELECT doc_id, regexp_extract(text, '((?:Rp|IDR) ?\d[\d.,]*\d)', 1) AS typed FROM documents),
t AS (SELECT doc_id, typed, regexp_replace(upper(typed), '\s|%|IDR|RP\.?', '', 'g') AS s FROM raw WHERE typed <> ''),
v AS (SELECT doc_id, typed, try_cast({_MONEY} AS DECIMAL(30,4)) AS v FROM t)
SELECT doc_id, typed, CAST(CASE WHEN abs(v) < 1000000000000 THEN v END AS DECIMAL(18,4)) AS amount FROM v""")
def money_parse(spark: SparkSession, d: str) -> DataFrame:
    typed = F.regexp_extract("text", r"((?:Rp|IDR) ?\d[\d.,]*\d)", 1)
    return table(spark, d, "documents").select("doc_id", typed.alias("typed")).where("typed <> ''").withColumn("amount", money.parse_money(F.col("typed")))


@query(r"""
WITH t AS (SELECT doc_id, regexp_extract(text, '(\d{1,4}[./-]\d{1,2}[./-]\d{2,4})', 1) AS typed FROM documents),
p AS (SELECT doc_id, typed,
  CASE WHEN regexp_matches(typed, '^\d{1,2}[./-]\d{1,2}[./-](\d{4}|\d{2})$') THEN regexp_extract(typed, '^(\d{1,2})[./-](\d{1,2})[./-](\d{4}|\d{2})$', 3)
       WHEN regexp_matches(typed, '^\d{4}-\d{1,2}-\d{1,2}$') THEN regexp_extract(typed, '^(\d{4})', 1) END AS y,
  CASE WHEN regexp_matches(typed, '^\d{1,2}[./-]\d{1,2}[./-](\d{4}|\d{2})$') THEN regexp_extract(typed, '^(\d{1,2})[./-](\d{1,2})', 2)
       WHEN regexp_matches(typed, '^\d{4}-\d{1,2}-\d{1,2}$') THEN regexp_extract(typed, '^\d{4}-(\d{1,2})', 1) END AS m,
  CASE WHEN regexp_matches(typed, '^\d{1,2}[./-]\d{1,2}[./-](\d{4}|\d{2})$') THEN regexp_extract(typed, '^(\d{1,2})', 1)
       WHEN regexp_matches(typed, '^\d{4}-\d{1,2}-\d{1,2}$') THEN regexp_extract(typed, '-(\d{1,2})$', 1) END AS dd
  FROM t WHERE typed <> '')
SELECT doc_id, typed, strftime(try_cast((CASE WHEN length(y) = 2 THEN '20' || y ELSE y END) || '-' || lpad(m, 2, '0') || '-' || lpad(dd, 2, '0') AS DATE), '%Y-%m-%d') AS parsed FROM p""")
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    typed = F.regexp_extract("text", r"(\d{1,4}[./-]\d{1,2}[./-]\d{2,4})", 1)
    return table(spark, d, "documents").select("doc_id", typed.alias("typed")).where("typed <> ''").select("doc_id", "typed", F.date_format(dates.parse_date(F.col("typed")), "yyyy-MM-dd").alias("parsed"))


@query(r"""
WITH t AS (SELECT id, strftime(posting_date, '%d/%m/%y') || ' 08:15:00' AS typed FROM tanda_terima WHERE posting_date IS NOT NULL)
SELECT id, typed, substr(typed, 1, 6) || '20' || substr(typed, 7, 2) AS normal FROM t""")
def date_normalize(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tanda_terima").where("posting_date is not null").select("id", F.concat(F.date_format("posting_date", "dd/MM/yy"), F.lit(" 08:15:00")).alias("typed"))
    return t.withColumn("normal", dates.normal_date(F.col("typed")))


@query(r"""
WITH t AS (SELECT id, trim(regexp_replace(coalesce(product_code || '  ', '') || product_name, '\s+', ' ', 'g')) AS s FROM po_customer)
SELECT id, CASE WHEN regexp_matches(s, '^\d{6,14}\s+.+$') THEN regexp_extract(s, '^(\d{6,14})\s+(.+)$', 1) WHEN regexp_matches(s, '^\d+$') THEN s ELSE '' END AS code,
  CASE WHEN regexp_matches(s, '^\d{6,14}\s+.+$') THEN regexp_extract(s, '^(\d{6,14})\s+(.+)$', 2) WHEN regexp_matches(s, '^\d+$') THEN '' ELSE s END AS name FROM t""")
def split_product(spark: SparkSession, d: str) -> DataFrame:
    typed = F.concat(F.coalesce(F.concat("product_code", F.lit("  ")), F.lit("")), F.col("product_name"))
    code, name = text.split_product(typed)
    return table(spark, d, "po_customer").select("id", code.alias("code"), name.alias("name"))


@query(r"""
WITH t AS (SELECT id, upper(trim(CAST(CAST(qty AS DECIMAL(16,2)) AS VARCHAR) || CASE WHEN id % 2 = 0 THEN '/' ELSE ' ' END || uon)) AS s FROM po_customer WHERE qty IS NOT NULL AND uon IS NOT NULL)
SELECT id, try_cast(nullif(regexp_extract(s, '^(\d+(?:\.\d+)?)\s*/?\s*([A-Z][A-Z ]*)$', 1), '') AS DECIMAL(16,4)) AS qty,
  nullif(trim(regexp_extract(s, '^(\d+(?:\.\d+)?)\s*/?\s*([A-Z][A-Z ]*)$', 2)), '') AS unit FROM t""")
def qty_uon_split(spark: SparkSession, d: str) -> DataFrame:
    typed = F.concat(F.col("qty").cast("decimal(16,2)").cast("string"), F.when(F.col("id") % 2 == 0, "/").otherwise(" "), F.col("uon"))
    q, u = text.split_qty(typed)
    return table(spark, d, "po_customer").where("qty is not null and uon is not null").select("id", q.alias("qty"), u.alias("unit"))


@query(r"""
WITH t AS (SELECT id, kemasan, regexp_extract(upper(trim(kemasan)), '^(\d+(?:\s*[X*]\s*\d+)*)(?:\s*[X*].*)?$', 1) AS lead FROM faktur_penjualan),
p AS (SELECT id, kemasan, list_filter(regexp_split_to_array(lead, '\s*[X*]\s*'), lambda x: regexp_matches(x, '^\d{1,6}$')) AS parts FROM t)
SELECT id, kemasan, CASE WHEN len(parts) > 0 THEN CAST(list_product(list_transform(parts, lambda x: CAST(x AS BIGINT))) AS BIGINT) END AS pieces FROM p""")
def pack_size(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "faktur_penjualan").select("id", "kemasan", text.pack_size(F.col("kemasan")).alias("pieces"))


@query(r"""
SELECT id, npwp_pembeli, nullif(right(regexp_replace(regexp_replace(npwp_pembeli, '\D', '', 'g'), '^0+', ''), 15), '') AS tax_id FROM faktur_pajak""")
def id_canon(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "faktur_pajak").select("id", "npwp_pembeli", text.id_canon(F.col("npwp_pembeli")).alias("tax_id"))


@query(r"""
WITH t AS (SELECT upper(trim(purchase_order_no)) AS s FROM po_customer WHERE purchase_order_no IS NOT NULL)
SELECT CASE WHEN regexp_matches(s, '^\d+(\.\d+)+$') THEN 'dotted' WHEN regexp_matches(s, '^[A-Z]{2,5}-\d+$') THEN 'dash-code' WHEN regexp_matches(s, '^\d{10}$') THEN 'bare-10'
  WHEN regexp_matches(s, '^(\d{13}|\d{15})$') THEN 'bare-13/15' WHEN regexp_matches(s, '^\d{6,12}$') THEN 'bare-6/12'
  WHEN regexp_matches(s, '[A-Z]') AND regexp_matches(s, '\d') THEN 'alpha-mix' ELSE 'other' END AS shape, count(*) AS n, min(s) AS example FROM t GROUP BY 1""")
def po_shape(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "po_customer").where("purchase_order_no is not null").select(text.code_shape(F.col("purchase_order_no")).alias("shape"), F.upper(F.trim("purchase_order_no")).alias("s"))
    return t.groupBy("shape").agg(F.count("*").alias("n"), F.min("s").alias("example"))


@query(r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(upper(string_split(text, chr(10))[1]), '\d', '#', 'g'), '[^A-Z#]+', ' ', 'g')) AS line FROM documents""")
def norm_line(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.norm_line(F.split("text", "\n")[0]).alias("line"))


@query(r"""
WITH t AS (SELECT doc_id, lower(rel_path) AS s FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(s, 'faktur pajak|e-faktur') THEN 'faktur_pajak' WHEN regexp_matches(s, 'faktur penjualan|sales invoice') THEN 'faktur_penjualan'
  WHEN regexp_matches(s, 'tanda terima|receiv') THEN 'tanda_terima' WHEN regexp_matches(s, '(^|/)po |purchase order') THEN 'po_customer' ELSE 'other' END AS tab FROM t""")
def tab_guess(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.tab_guess(F.col("rel_path")).alias("tab"))


@query(r"""
WITH t AS (SELECT doc_id, trim(regexp_extract(upper(folder), '(PT [A-Z][A-Z .]*)(?: - |/|$)', 1)) AS name FROM documents)
SELECT doc_id, CASE WHEN name <> '' THEN 'PT' || list_aggregate(list_transform(string_split(substr(name, 3), ' '), lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), 'string_agg', ' ') END AS issuer FROM t""")
def issuer_from_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.issuer_from_path(F.col("folder")).alias("issuer"))


@query(r"""
WITH t AS (SELECT doc_id, mime, lower(regexp_extract(filename, '\.([A-Za-z0-9]+)$', 1)) AS ext FROM documents)
SELECT doc_id, coalesce(CASE WHEN mime IN ('application/pdf', 'text/plain', 'image/jpeg', 'image/png') THEN mime END,
  CASE ext WHEN 'pdf' THEN 'application/pdf' WHEN 'txt' THEN 'text/plain' WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg' WHEN 'png' THEN 'image/png'
    WHEN 'xlsx' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' END, 'application/octet-stream') AS mime FROM t""")
def mime_sniff(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.mime_of(F.col("mime"), F.col("filename")).alias("mime"))


@query(r"""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN '  ' ELSE text END AS s FROM documents)
SELECT doc_id, CAST(length(CASE WHEN trim(s) = '' THEN '[BLANK_PAGE]' ELSE s END) AS INTEGER) AS n_chars, trim(s) = '' AS blank FROM t""")
def blank_page(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 50 == 0, "  ").otherwise(F.col("text")).alias("s"))
    return t.select("doc_id", F.length(text.page_text(F.col("s"))).alias("n_chars"), (text.page_text(F.col("s")) == text.BLANK).alias("blank"))


@query(r"""SELECT doc_id, substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 400) AS excerpt FROM documents""")
def review_excerpt(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


@query(r"""
WITH t AS (SELECT doc_id, CASE WHEN json_valid(standard_json) THEN standard_json END AS j FROM documents)
SELECT doc_id, coalesce(nullif(json_extract_string(j, '$.doc_type'), ''), nullif(json_extract_string(j, '$.classified.class'), ''), nullif(json_extract_string(j, '$.kind'), '')) AS kind FROM t""")
def json_coalesce(spark: SparkSession, d: str) -> DataFrame:
    j = F.when(F.try_parse_json("standard_json").isNotNull(), F.col("standard_json"))
    return table(spark, d, "documents").select("doc_id", F.coalesce(*[F.nullif(F.get_json_object(j, p), F.lit("")) for p in ("$.doc_type", "$.classified.class", "$.kind")]).alias("kind"))


@query(r"""
WITH t AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt FROM events WHERE event_type = 'error')
SELECT event_id, CAST(attempt AS INTEGER) AS attempt, CAST(5 * pow(2, least(attempt, 10) - 1) AS BIGINT) AS wait_s FROM t""")
def retry_backoff(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    t = table(spark, d, "events").where("event_type = 'error'").select("event_id", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).alias("attempt"))
    return t.withColumn("wait_s", status.backoff_seconds(F.least("attempt", F.lit(10))))


@query(r"""
WITH pairs(x, y) AS (VALUES ('0','8'),('8','0'),('6','8'),('8','6'),('1','4'),('4','1'),('3','9'),('9','3'),('5','6'),('6','5')),
t AS (SELECT id, vendor_code AS s FROM po_customer WHERE regexp_matches(vendor_code, '^\d{9}$')),
pos AS (SELECT id, s, unnest(range(1, length(s) + 1)) AS i FROM t)
SELECT DISTINCT id, substr(s, 1, CAST(i AS INTEGER) - 1) || y || substr(s, CAST(i AS INTEGER) + 1) AS candidate FROM pos JOIN pairs ON substr(s, CAST(i AS INTEGER), 1) = x""")
def digit_fix(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "po_customer").where(F.col("vendor_code").rlike(r"^\d{9}$"))
    return t.select("id", F.explode(learn.digit_fixes(F.col("vendor_code"))).alias("candidate"))


_HEAD_SQL = " || ".join(f"CASE WHEN regexp_matches(s, '{p}') THEN '{k}#' ELSE '' END" for k, p in sorted(text.HEADINGS.items()))


@query(rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
k AS (SELECT doc_id, n, {_HEAD_SQL} AS sig FROM (SELECT doc_id, n, upper(line) AS s FROM l)),
f AS (SELECT doc_id, min_by(rtrim(sig, '#'), n) AS signature FROM k WHERE length(sig) - length(replace(sig, '#', '')) >= 3 GROUP BY doc_id)
SELECT signature, count(*) AS n_documents, substr(sha1(signature || '|' || 'SELF'), 1, 12) AS variant FROM f GROUP BY signature""")
def layout_signature(spark: SparkSession, d: str) -> DataFrame:
    from ledgerforge.operators.lines import explode_lines

    lines = explode_lines(table(spark, d, "documents"), ["doc_id"]).select("doc_id", "line_no", text.layout_signature(F.col("line")).alias("s"))
    first = lines.where("s is not null").groupBy("doc_id").agg(F.min_by("s", "line_no").alias("signature"))
    return first.groupBy("signature").agg(F.count("*").alias("n_documents")).withColumn("variant", text.variant_key(F.col("signature"), F.lit("SELF")))


_CLASS_SQL = " ".join("WHEN " + " AND ".join([*(f"regexp_matches(s, '{p}')" for p in held), *(f"NOT regexp_matches(s, '{p}')" for p in barred)]) + f" THEN '{n}'" for n, held, barred in text.PAGE_CLASSES)


@query(f"SELECT doc_id, CASE {_CLASS_SQL} ELSE 'OTHER' END AS class FROM (SELECT doc_id, upper(coalesce(text, '')) AS s FROM documents)")
def page_classify(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.page_class(F.col("text")).alias("class"))


_LABEL_SQL = ", ".join(f"CASE WHEN strpos(s, '{w}') > 0 THEN {{'at': strpos(s, '{w}'), 'label': '{n}'}} END" for n, w in text.LABELS)


@query(rf"""
WITH t AS (SELECT doc_id, lower(text) AS s FROM documents)
SELECT doc_id, (list_min(list_filter([{_LABEL_SQL}], lambda x: x IS NOT NULL))).label AS label FROM t""")
def page_label(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.page_label(F.col("text")).alias("label"))


@query(r"""
WITH t AS (SELECT id, regexp_replace(upper(trim(regexp_replace(nama_pt, '\s+', ' ', 'g'))), '[.,\s]+$', '') AS s FROM faktur_penjualan)
SELECT id, nullif(CASE WHEN regexp_matches(s, 'MUTO KOSUME') THEN 'SELF' ELSE substr(s, 1, 60) END, '') AS company FROM t""")
def canon_company(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "faktur_penjualan").select("id", text.canon_company(F.col("nama_pt"), "MUTO KOSUME").alias("company"))


@query(r"""
WITH t AS (SELECT id, CASE WHEN id % 3 = 0 THEN 'p' || source_page || ' ' || source_file WHEN id % 3 = 1 THEN CAST(source_page AS VARCHAR) ELSE source_file END AS s FROM po_customer)
SELECT id, try_cast(nullif(regexp_extract(trim(s), '^p?(\d{1,6})', 1), '') AS INTEGER) AS page FROM t""")
def source_page(spark: SparkSession, d: str) -> DataFrame:
    s = F.when(F.col("id") % 3 == 0, F.concat(F.lit("p"), F.col("source_page").cast("string"), F.lit(" "), "source_file")).when(F.col("id") % 3 == 1, F.col("source_page").cast("string")).otherwise(F.col("source_file"))
    return table(spark, d, "po_customer").select("id", text.source_page(s).alias("page"))


@query(r"""
WITH t AS (SELECT id, kode_seri, regexp_replace(kode_seri, '\D', '', 'g') AS s FROM faktur_pajak)
SELECT id, CASE WHEN length(s) = 16 THEN substr(s, 1, 3) || '.' || substr(s, 4, 3) || '-' || substr(s, 7, 2) || '.' || substr(s, 9, 8) END AS serial FROM t""")
def serial_number(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "faktur_pajak").select("id", text.serial_number(F.col("kode_seri")).alias("serial"))


@query(r"""
WITH t AS (SELECT id, CASE WHEN id % 2 = 0 THEN CASE WHEN id % 4 = 0 THEN '11,0 %' ELSE '1.1%' END END AS printed, CAST(ppn AS DOUBLE) / nullif(CAST(dasar_pengenaan_pajak AS DOUBLE), 0) AS q FROM faktur_pajak),
r AS (SELECT id, q, try_cast(nullif(regexp_extract(replace(printed, ',', '.'), '(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) AS r FROM t)
SELECT id, CASE WHEN r IS NOT NULL THEN CASE WHEN r < 4 THEN '1.1%' ELSE '11%' END WHEN q BETWEEN 0.08 AND 0.14 THEN '11%' WHEN q BETWEEN 0.005 AND 0.02 THEN '1.1%' END AS rate FROM r""")
def tax_rate(spark: SparkSession, d: str) -> DataFrame:
    printed = F.when(F.col("id") % 2 == 0, F.when(F.col("id") % 4 == 0, "11,0 %").otherwise("1.1%"))
    return table(spark, d, "faktur_pajak").select("id", text.tax_rate(printed, F.col("dasar_pengenaan_pajak"), F.col("ppn")).alias("rate"))


@query(r"""
WITH t AS (SELECT doc_id, regexp_replace(regexp_extract('Answer: ```json ' || CASE WHEN doc_id % 2 = 0 THEN regexp_replace(standard_json, '\}$', ',}') ELSE standard_json END || ' ```', '(?s)(\{.*\})', 1), ',\s*([}\]])', '\1', 'g') AS s FROM documents WHERE standard_json IS NOT NULL)
SELECT doc_id, json_extract_string(CASE WHEN json_valid(s) THEN s END, '$.kind') AS kind FROM t""")
def loose_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON inside fenced answers, half of them with a comma too many."""
    body = F.when(F.col("doc_id") % 2 == 0, F.regexp_replace("standard_json", r"\}$", ",}")).otherwise(F.col("standard_json"))
    t = table(spark, d, "documents").where("standard_json is not null").select("doc_id", text.loose_json(F.concat(F.lit("Answer: ```json "), body, F.lit(" ```"))).alias("s"))
    return t.select("doc_id", F.get_json_object("s", "$.kind").alias("kind"))


@query(r"""SELECT id, nullif(substr(regexp_replace(po_issuer, '^\s+|\s+$', '', 'g'), 1, 280), '') AS issuer FROM po_customer""")
def text_cell(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "po_customer").select("id", text.cell(F.col("po_issuer")).alias("issuer"))
