"""Joins, rollups, paging, writes and learning, applied."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import text
from ledgerforge.functions.dates import parse_date
from ledgerforge.operators import audit, gates, learn, merge
from ledgerforge.operators.lines import explode_lines, explode_pages
from ledgerforge.plans.ordered import PAGES
from ledgerforge.plans.registry import Registry
from ledgerforge.session import table

query = Registry()

# ---- joins --------------------------------------------------------------------------------------------------


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    """A work queue over the documents: the guess by path, a status by status of the document."""
    s = F.col("status")
    st = F.when(s == "VALIDATED", "pending").when(s == "FLAGGED", "review").when(s == "DELIVERED", "mapped").otherwise("failed")
    return table(spark, d, "documents").select(F.col("id").alias("document_id"), text.tab_guess(F.col("rel_path")).alias("tab"), st.alias("status"), F.lit(0).alias("attempts"))


TASKS = """tasks AS (SELECT id AS document_id, CASE WHEN regexp_matches(lower(rel_path), 'faktur pajak|e-faktur') THEN 'faktur_pajak' WHEN regexp_matches(lower(rel_path), 'faktur penjualan|sales invoice') THEN 'faktur_penjualan'
  WHEN regexp_matches(lower(rel_path), 'tanda terima|receiv') THEN 'tanda_terima' WHEN regexp_matches(lower(rel_path), '(^|/)po |purchase order') THEN 'po_customer' ELSE 'other' END AS tab,
  CASE WHEN status = 'VALIDATED' THEN 'pending' WHEN status = 'FLAGGED' THEN 'review' WHEN status = 'DELIVERED' THEN 'mapped' ELSE 'failed' END AS status, 0 AS attempts FROM documents)"""


@query(f"""WITH {TASKS} SELECT t.document_id, t.tab, d.created FROM tasks t JOIN documents d ON d.id = t.document_id WHERE t.status IN ('pending', 'failed') AND d.status IN ('VALIDATED', 'DELIVERED') AND d.folder LIKE '%PT%'""")
def queue_pending(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("status").isin("VALIDATED", "DELIVERED") & F.col("folder").like("%PT%")).select(F.col("id").alias("document_id"), "created")
    return _tasks(spark, d).where(F.col("status").isin("pending", "failed")).join(docs, "document_id").select("document_id", "tab", "created")


_SIDES = ("po_customer", "faktur_penjualan", "faktur_pajak", "tanda_terima")


@query("WITH f AS (SELECT folder, count(*) AS documents FROM documents WHERE folder IS NOT NULL GROUP BY folder)" + "".join(f", {s} AS (SELECT folder, count(*) AS n FROM {s} GROUP BY folder)" for s in _SIDES)
       + " SELECT f.folder, f.documents" + "".join(f", coalesce({s}.n, 0) AS {s}" for s in _SIDES) + " FROM f" + "".join(f" LEFT JOIN {s} ON {s}.folder = f.folder" for s in _SIDES))
def folder_coverage(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "documents").where("folder is not null").groupBy("folder").agg(F.count("*").alias("documents"))
    return audit.coverage(base, "folder", {s: table(spark, d, s).select("folder") for s in _SIDES})


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def coverage_anti(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("SELECT d.doc_id, i.issuer_code FROM documents d JOIN issuer_list i ON contains(upper(d.text), upper(i.pt))")
def theta_contains(spark: SparkSession, d: str) -> DataFrame:
    """Legal names of a fixed list found in texts: the list is small and checked, every text is read once against all of it."""
    names = table(spark, d, "issuer_list").select("issuer_code", F.upper("pt").alias("name")).limit(2001).collect()
    if len(names) > 2000:
        raise ValueError("the list of names is too long for one expression a row; join by word instead")
    all_names = F.array(*[F.struct(F.lit(r[0]).alias("issuer_code"), F.lit(r[1]).alias("name")) for r in names])
    return table(spark, d, "documents").select("doc_id", F.upper("text").alias("t")).select("doc_id", F.explode(F.filter(all_names, lambda x: F.col("t").contains(x["name"]))).alias("x")).select("doc_id", "x.issuer_code")


@query("""WITH o AS (SELECT product_code, max(unit_price) AS price FROM po_customer WHERE confidence = 'high' AND unit_price IS NOT NULL AND product_code IS NOT NULL GROUP BY 1)
SELECT id, coalesce(unit_price, o.price) AS unit_price, CASE WHEN unit_price IS NULL AND o.price IS NOT NULL THEN 'PASS-DEEP' ELSE mapping_status END AS status FROM po_customer LEFT JOIN o USING (product_code)""")
def override_apply(spark: SparkSession, d: str) -> DataFrame:
    po = table(spark, d, "po_customer")
    o = po.where("confidence = 'high' and unit_price is not null and product_code is not null").groupBy("product_code").agg(F.max("unit_price").alias("p"))
    return po.join(o, "product_code", "left").select("id", F.coalesce("unit_price", "p").alias("unit_price"), F.when(F.col("unit_price").isNull() & F.col("p").isNotNull(), "PASS-DEEP").otherwise(F.col("mapping_status")).alias("status"))


@query("""SELECT i.id, i.invoice_number, u.li.line_no AS line_no, u.li.amount AS amount, CASE WHEN u.id IS NULL THEN '[NO ITEMS]' ELSE u.li.description END AS description
FROM invoice_rows i LEFT JOIN (SELECT id, li FROM (SELECT id, unnest(line_items) AS li FROM invoice_rows) WHERE li IS NOT NULL) u ON u.id = i.id""")
def header_item_denorm(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "invoice_rows").select("id", "invoice_number", F.explode_outer(F.filter("line_items", lambda x: x.isNotNull())).alias("li"))
    return t.select("id", "invoice_number", "li.line_no", "li.amount", F.when(F.col("li").isNull(), "[NO ITEMS]").otherwise(F.col("li.description")).alias("description"))


@query(rf"""WITH {PAGES}, a AS (SELECT doc_id, 1 AS page, text FROM documents)
SELECT coalesce(a.doc_id, p.doc_id) AS doc_id, coalesce(a.page, p.page) AS page, length(CASE WHEN coalesce(length(p.text), -1) > coalesce(length(a.text), -1) THEN p.text ELSE a.text END) AS n_chars,
  CASE WHEN coalesce(length(p.text), -1) > coalesce(length(a.text), -1) THEN 'other' ELSE 'native' END AS reading FROM a FULL JOIN pages p ON p.doc_id = a.doc_id AND p.page = a.page""")
def ocr_merge(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    native = docs.select("doc_id", F.lit(1).alias("page"), "text")
    m = merge.merge_readings(native, explode_pages(docs), ["doc_id", "page"])
    return m.select("doc_id", "page", F.length("text").cast("bigint").alias("n_chars"), "reading")


_CELLS = ("qty", "uon", "total")


@query("""WITH a AS (SELECT id, CAST(qty AS VARCHAR) AS qty, uon, CAST(total AS VARCHAR) AS total FROM po_customer),
b AS (SELECT id, CAST(CASE WHEN review_status = 'REVIEW' THEN qty + 1 ELSE qty END AS VARCHAR) AS qty, upper(uon) AS uon, CAST(total AS VARCHAR) AS total FROM po_customer WHERE exported_at IS NOT NULL),
j AS (SELECT coalesce(a.id, b.id) AS id, a.id AS ai, b.id AS bi, a.qty AS aq, b.qty AS bq, a.uon AS au, b.uon AS bu, a.total AS atot, b.total AS btot FROM a FULL JOIN b ON a.id = b.id)
SELECT id, 'row' AS field, CASE WHEN ai IS NOT NULL THEN 'x' END AS value_a, CASE WHEN bi IS NOT NULL THEN 'x' END AS value_b FROM j WHERE ai IS NULL OR bi IS NULL
UNION ALL SELECT id, 'qty', aq, bq FROM j WHERE ai IS NOT NULL AND bi IS NOT NULL AND aq IS DISTINCT FROM bq
UNION ALL SELECT id, 'uon', au, bu FROM j WHERE ai IS NOT NULL AND bi IS NOT NULL AND au IS DISTINCT FROM bu
UNION ALL SELECT id, 'total', atot, btot FROM j WHERE ai IS NOT NULL AND bi IS NOT NULL AND atot IS DISTINCT FROM btot""")
def cell_diff(spark: SparkSession, d: str) -> DataFrame:
    """The table against what was exported of it, where reviewers changed quantities and units were tidied."""
    po = table(spark, d, "po_customer")
    edited = po.where("exported_at is not null").withColumn("qty", F.when(F.col("review_status") == "REVIEW", (F.col("qty") + 1).cast("decimal(16,4)")).otherwise(F.col("qty"))).withColumn("uon", F.upper("uon"))
    return merge.cell_diff(po.select("id", *_CELLS), edited.select("id", *_CELLS), "id", list(_CELLS))


@query("""WITH a AS (SELECT product_code, count(*) AS n FROM po_customer GROUP BY 1), b AS (SELECT kode_material AS product_code, count(*) AS n FROM faktur_penjualan GROUP BY 1)
SELECT coalesce(a.product_code, b.product_code) AS product_code, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b FROM a FULL JOIN b ON a.product_code IS NOT DISTINCT FROM b.product_code WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def multiset_diff(spark: SparkSession, d: str) -> DataFrame:
    return merge.multiset_diff(table(spark, d, "po_customer").select("product_code"), table(spark, d, "faktur_penjualan").select(F.col("kode_material").alias("product_code")), ["product_code"])


@query("""SELECT DISTINCT id FROM documents WHERE (created >= TIMESTAMP '2025-02-01' AND created < TIMESTAMP '2025-08-01') OR (created >= TIMESTAMP '2025-06-01' AND created < TIMESTAMP '2026-01-01')""")
def window_select(spark: SparkSession, d: str) -> DataFrame:
    """Documents of several time windows, each once."""
    docs = table(spark, d, "documents")
    c = F.col("created").cast("timestamp_ntz")
    w = [(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz")) for a, b in (("2025-02-01", "2025-08-01"), ("2025-06-01", "2026-01-01"))]
    one = docs.where((c >= w[0][0]) & (c < w[0][1])).select("id")
    return one.unionByName(docs.where((c >= w[1][0]) & (c < w[1][1])).select("id")).dropDuplicates(["id"])


@query("""WITH m AS (SELECT purchase_order_no, min(po_issuer) AS issuer FROM po_customer WHERE trim(coalesce(po_issuer, '')) <> '' AND purchase_order_no IS NOT NULL GROUP BY 1),
f AS (SELECT document_id, min(po_issuer) AS issuer FROM po_customer WHERE trim(coalesce(po_issuer, '')) <> '' AND document_id IS NOT NULL GROUP BY 1)
SELECT p.id, coalesce(nullif(trim(p.po_issuer), ''), m.issuer, f.issuer, '') AS issuer, CASE WHEN trim(coalesce(p.po_issuer, '')) <> '' THEN p.mapping_status
  WHEN coalesce(m.issuer, f.issuer) IS NULL THEN concat_ws('|', p.mapping_status, 'ISSUER-UNRESOLVED') ELSE concat_ws('|', p.mapping_status, 'ISSUER-FIXED') END AS status
FROM po_customer p LEFT JOIN m USING (purchase_order_no) LEFT JOIN f ON f.document_id = p.document_id""")
def issuer_repair(spark: SparkSession, d: str) -> DataFrame:
    """A blank issuer from the order's memory, else from the document, else reported as unresolved."""
    po = table(spark, d, "po_customer")
    named = po.where("trim(coalesce(po_issuer, '')) <> ''")
    m = named.where("purchase_order_no is not null").groupBy("purchase_order_no").agg(F.min("po_issuer").alias("m"))
    f = named.where("document_id is not null").groupBy("document_id").agg(F.min("po_issuer").alias("f"))
    t = po.join(m, "purchase_order_no", "left").join(f, "document_id", "left")
    blank = F.trim(F.coalesce("po_issuer", F.lit(""))) == ""
    tag = F.when(F.coalesce("m", "f").isNull(), "ISSUER-UNRESOLVED").otherwise("ISSUER-FIXED")
    return t.select("id", F.coalesce(F.nullif(F.trim("po_issuer"), F.lit("")), "m", "f", F.lit("")).alias("issuer"), F.when(~blank, F.col("mapping_status")).otherwise(F.concat_ws("|", "mapping_status", tag)).alias("status"))


@query(r"""WITH l AS (SELECT id AS document_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
dl AS (SELECT document_id, regexp_extract(line, '(\d{2})[./-](\d{2})[./-](20\d{2})', 0) AS s, n FROM l WHERE regexp_matches(line, '\d{2}[./-]\d{2}[./-]20\d{2}')),
f AS (SELECT document_id, min_by(s, n) AS s FROM dl GROUP BY 1)
SELECT t.id, strftime(coalesce(t.posting_date, try_cast(substr(s, 7, 4) || '-' || substr(s, 4, 2) || '-' || substr(s, 1, 2) AS DATE)), '%Y-%m-%d') AS posting_date FROM tanda_terima t LEFT JOIN f USING (document_id)""")
def date_repair(spark: SparkSession, d: str) -> DataFrame:
    """A missing posting date from the first line of the document that holds one."""
    found = F.regexp_extract("line", r"(\d{2})[./-](\d{2})[./-](20\d{2})", 0)
    dl = explode_lines(table(spark, d, "documents").select(F.col("id").alias("document_id"), "text"), ["document_id"]).withColumn("s", found).where("s <> ''")
    f = dl.groupBy("document_id").agg(F.min_by("s", "line_no").alias("s"))
    return table(spark, d, "tanda_terima").join(f, "document_id", "left").select("id", F.date_format(F.coalesce("posting_date", parse_date(F.col("s"))), "yyyy-MM-dd").alias("posting_date"))


@query("""SELECT t.id, p.n_ordered, t.qty AS received FROM tanda_terima t JOIN (SELECT purchase_order_no, product_code, count(*) AS n_ordered FROM po_customer WHERE purchase_order_no IS NOT NULL AND product_code IS NOT NULL GROUP BY 1, 2) p
ON p.purchase_order_no = t.purchase_order_no AND p.product_code = t.item_code""")
def receipt_match(spark: SparkSession, d: str) -> DataFrame:
    """Receipts with the order lines that they are of; orders are aggregated first, so nothing fans out."""
    p = table(spark, d, "po_customer").where("purchase_order_no is not null and product_code is not null").groupBy("purchase_order_no", "product_code").agg(F.count("*").alias("n_ordered"))
    t = table(spark, d, "tanda_terima").select("id", "purchase_order_no", F.col("item_code").alias("product_code"), F.col("qty").alias("received"))
    return t.join(p, ["purchase_order_no", "product_code"]).select("id", "n_ordered", "received")


# ---- rollups ------------------------------------------------------------------------------------------------


@query("SELECT status, count(*) AS n FROM documents GROUP BY status")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("status").agg(F.count("*").alias("n"))


@query("""SELECT folder, count(*) AS n_rows, count_if(review_status = 'OK') AS n_ok, count_if(review_status = 'REVIEW') AS n_review, count_if(review_status IS NULL) AS n_open
FROM po_customer WHERE folder IS NOT NULL GROUP BY folder ORDER BY n_rows DESC, folder LIMIT 30""")
def folder_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "po_customer").where("folder is not null")
    return audit.filtered_counts(t, ["folder"], {"n_ok": F.col("review_status") == "OK", "n_review": F.col("review_status") == "REVIEW", "n_open": F.col("review_status").isNull()}).orderBy(F.desc("n_rows"), "folder").limit(30)


@query(" UNION ALL ".join(f"SELECT '{s}' AS tab, count(*) AS n_rows, count_if(starts_with(mapping_status, 'MAPPED')) AS n_mapped, count_if(contains(mapping_status, 'REVIEW')) AS n_review, count_if(exported_at IS NOT NULL) AS n_exported FROM {s}" for s in _SIDES))
def tab_rollup(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, s).select(F.lit(s).alias("tab"), "mapping_status", "exported_at") for s in _SIDES]
    t = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return audit.filtered_counts(t, ["tab"], {"n_mapped": F.col("mapping_status").startswith("MAPPED"), "n_review": F.col("mapping_status").contains("REVIEW"), "n_exported": F.col("exported_at").isNotNull()})


@query("""WITH t AS (""" + " UNION ALL ".join(f"SELECT document_id, '{s}' AS tab FROM {s}" for s in _SIDES) + """), n AS (SELECT document_id, tab, count(*) AS n FROM t WHERE document_id IS NOT NULL GROUP BY 1, 2)
SELECT document_id, '{' || string_agg('"' || tab || '":' || n, ',' ORDER BY tab) || '}' AS summary FROM n GROUP BY 1""")
def rows_summary(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, s).where("document_id is not null").select("document_id", F.lit(s).alias("tab")) for s in _SIDES]
    return audit.json_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), "document_id", "tab")


@query("SELECT natural_key, count(*) AS n FROM po_customer GROUP BY natural_key HAVING count(*) > 1")
def dup_check(spark: SparkSession, d: str) -> DataFrame:
    return audit.duplicates(table(spark, d, "po_customer"), ["natural_key"])


@query("""WITH p AS (SELECT purchase_order_no, po_issuer, count(*) AS n FROM po_customer WHERE purchase_order_no IS NOT NULL AND po_issuer IS NOT NULL GROUP BY 1, 2)
SELECT purchase_order_no, count(*) AS n_values, CAST(sum(n) AS BIGINT) AS n_rows, min(po_issuer) AS least, max(po_issuer) AS greatest FROM p GROUP BY 1 HAVING count(*) > 1""")
def key_conflict(spark: SparkSession, d: str) -> DataFrame:
    return audit.key_conflict(table(spark, d, "po_customer"), "purchase_order_no", "po_issuer")


_FILL = ("purchase_order_no", "vendor_code", "po_issuer", "ppn", "product_code", "product_name", "qty", "uon", "unit_price", "discount", "total")


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS n_rows, count(nullif(trim(CAST({c} AS VARCHAR)), '')) AS n_filled FROM po_customer" for c in _FILL))
def fill_rate(spark: SparkSession, d: str) -> DataFrame:
    return audit.fill_rate(table(spark, d, "po_customer"), list(_FILL))


@query("SELECT length(purchase_order_no) AS len, count(*) AS n FROM po_customer WHERE purchase_order_no IS NOT NULL GROUP BY 1")
def len_hist(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "po_customer").where("purchase_order_no is not null").groupBy(F.length("purchase_order_no").cast("bigint").alias("len")).agg(F.count("*").alias("n"))


@query("SELECT uon, count(*) AS n FROM po_customer GROUP BY uon ORDER BY n DESC, uon NULLS LAST LIMIT 20")
def topn(spark: SparkSession, d: str) -> DataFrame:
    return audit.top_values(table(spark, d, "po_customer"), "uon", 20)


@query("""SELECT l_orderkey, l_partkey, count_if(l_discount = 0) AS n_zero, count_if(l_discount > 0) AS n_real FROM lineitem GROUP BY 1, 2 HAVING count_if(l_discount = 0) > 0 AND count_if(l_discount > 0) > 0""")
def zero_dup(spark: SparkSession, d: str) -> DataFrame:
    """Lines without an amount that have a real sibling of the same order and part."""
    g = table(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count_if(F.col("l_discount") == 0).alias("n_zero"), F.count_if(F.col("l_discount") > 0).alias("n_real"))
    return g.where("n_zero > 0 and n_real > 0")


@query(rf"""WITH {PAGES}, a AS (SELECT doc_id, count(*) AS total_pages, count_if(length(trim(text)) >= 20) AS completed_pages, CAST(sum(length(text)) AS BIGINT) AS completed_chars FROM pages GROUP BY 1)
SELECT folder, CAST(sum(total_pages) AS BIGINT) AS total_pages, CAST(sum(completed_pages) AS BIGINT) AS completed_pages, CAST(sum(completed_chars) AS BIGINT) AS completed_chars FROM a JOIN documents USING (doc_id) GROUP BY folder""")
def ocr_progress(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    p = explode_pages(docs).groupBy("doc_id").agg(F.count("*").alias("t"), F.count_if(F.length(F.trim("text")) >= 20).alias("c"), F.sum(F.length("text")).alias("n"))
    return p.join(docs.select("doc_id", "folder"), "doc_id").groupBy("folder").agg(F.sum("t").alias("total_pages"), F.sum("c").alias("completed_pages"), F.sum("n").alias("completed_chars"))


@query(r"""WITH t AS (SELECT source, CASE WHEN regexp_matches(text, '(?m)^NO ITEM QTY') THEN 'no-item' WHEN regexp_matches(text, '(?m)^No Kode') THEN 'no-kode' WHEN regexp_matches(text, '(?m)^Line SKU') THEN 'line-sku' ELSE 'none' END AS family FROM documents)
SELECT source, family, count(*) AS n FROM t GROUP BY 1, 2""")
def family_census(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    fam = F.when(t.rlike(r"(?m)^NO ITEM QTY"), "no-item").when(t.rlike(r"(?m)^No Kode"), "no-kode").when(t.rlike(r"(?m)^Line SKU"), "line-sku").otherwise("none")
    return table(spark, d, "documents").select("source", fam.alias("family")).groupBy("source", "family").agg(F.count("*").alias("n"))


@query(r"""WITH t AS (SELECT vendor_code AS company, purchase_order_no AS no, id, upper(trim(purchase_order_no)) AS s FROM po_customer WHERE purchase_order_no IS NOT NULL AND regexp_matches(vendor_code, '^\d{9}$') AND starts_with(mapping_status, 'MAPPED')),
c AS (SELECT *, CASE WHEN regexp_matches(s, '^\d+(\.\d+)+$') THEN 'dotted' WHEN regexp_matches(s, '^[A-Z]{2,5}-\d+$') THEN 'dash-code' WHEN regexp_matches(s, '^\d{10}$') THEN 'bare-10'
  WHEN regexp_matches(s, '^(\d{13}|\d{15})$') THEN 'bare-13/15' WHEN regexp_matches(s, '^\d{6,12}$') THEN 'bare-6/12' WHEN regexp_matches(s, '[A-Z]') AND regexp_matches(s, '\d') THEN 'alpha-mix' ELSE 'other' END AS shape FROM t)
SELECT company, shape, count(*) AS n, min_by(no, id) AS example FROM c GROUP BY 1, 2""")
def format_registry(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "po_customer").where(F.col("purchase_order_no").isNotNull() & F.col("vendor_code").rlike(r"^\d{9}$") & F.col("mapping_status").startswith("MAPPED"))
    return t.groupBy(F.col("vendor_code").alias("company"), text.code_shape(F.col("purchase_order_no")).alias("shape")).agg(F.count("*").alias("n"), F.min_by("purchase_order_no", "id").alias("example"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def status_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


# ---- paging, export, filters --------------------------------------------------------------------------------


@query("SELECT id, purchase_order_no, total, (SELECT count(*) FROM po_customer) AS n_all FROM po_customer ORDER BY total DESC NULLS LAST, id LIMIT 50 OFFSET 100")
def page_rows(spark: SparkSession, d: str) -> DataFrame:
    """One page of the rows by total, with the number of all rows."""
    po = table(spark, d, "po_customer").select("id", "purchase_order_no", "total")
    page = po.orderBy(F.desc_nulls_last("total"), "id").offset(100).limit(50)
    return page.withColumn("n_all", po.agg(F.count("*")).scalar())


@query(f"""WITH {TASKS} SELECT t.document_id, t.status, d.created FROM tasks t JOIN documents d ON d.id = t.document_id WHERE t.status IN ('review', 'failed') ORDER BY d.created DESC NULLS LAST, t.document_id LIMIT 100""")
def attention(spark: SparkSession, d: str) -> DataFrame:
    t = _tasks(spark, d).where(F.col("status").isin("review", "failed"))
    return t.join(table(spark, d, "documents").select(F.col("id").alias("document_id"), "created"), "document_id").select("document_id", "status", "created").orderBy(F.desc_nulls_last("created"), "document_id").limit(100)


_EXPORT = {"PO NUMBER": "purchase_order_no", "VENDOR": "vendor_code", "ITEM": "product_name", "QTY": "qty", "TOTAL": "total"}


@query("SELECT natural_key, " + ", ".join(f"""coalesce(CAST({c} AS VARCHAR), '') AS "{h}\"""" for h, c in _EXPORT.items()) + " FROM po_customer WHERE folder LIKE '/data/inbox/%'")
def export_view(spark: SparkSession, d: str) -> DataFrame:
    """Rows as exported: the sheet's headings, blanks for nulls."""
    return table(spark, d, "po_customer").where(F.col("folder").like("/data/inbox/%")).select("natural_key", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(h) for h, c in _EXPORT.items()])


@query("SELECT id FROM po_customer WHERE concat_ws('', purchase_order_no, vendor_code, po_issuer, product_code, CAST(qty AS VARCHAR), CAST(total AS VARCHAR)) <> '' AND NOT contains(coalesce(mapping_status, ''), 'OCR_PAGE_REVIEW')")
def tidy_filter(spark: SparkSession, d: str) -> DataFrame:
    cells = [F.col(c).cast("string") for c in ("purchase_order_no", "vendor_code", "po_issuer", "product_code", "qty", "total")]
    return table(spark, d, "po_customer").where((F.concat_ws("", *cells) != "") & ~F.coalesce("mapping_status", F.lit("")).contains("OCR_PAGE_REVIEW")).select("id")


_JUNK = r"(?i)^[-–—]?\s*(Jumlah|Kekurangan|Selisih|Sisa|Printed|Halaman|Total\b|Sub\s*Total|Grand)"


@query(rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS n_kept FROM l WHERE trim(line) <> '' AND NOT regexp_matches(line, '{_JUNK}') GROUP BY 1""")
def junk_name_filter(spark: SparkSession, d: str) -> DataFrame:
    ls = explode_lines(table(spark, d, "documents"), ["doc_id"])
    return ls.where((F.trim("line") != "") & ~F.col("line").rlike(_JUNK)).groupBy("doc_id").agg(F.count("*").alias("n_kept"))


# ---- writes -------------------------------------------------------------------------------------------------

_OLD = "old AS (SELECT id, document_id, natural_key, CAST(total AS DECIMAL(18,2)) AS total, updated_at, review_status FROM po_customer)"
_NEW = "new AS (SELECT id, document_id, natural_key, CAST(total + 1 AS DECIMAL(18,2)) AS total, updated_at, CAST(NULL AS VARCHAR) AS review_status FROM po_customer WHERE exported_at IS NULL OR updated_at > exported_at)"


def _old(spark: SparkSession, d: str) -> DataFrame:
    """The state of the whole table."""
    return table(spark, d, "po_customer").select("id", "document_id", "natural_key", F.col("total").cast("decimal(18,2)").alias("total"), "updated_at", "review_status")


def _new(spark: SparkSession, d: str) -> DataFrame:
    """What changed since it was exported, read again."""
    return table(spark, d, "po_customer").where("exported_at is null or updated_at > exported_at").select("id", "document_id", "natural_key", (F.col("total") + 1).cast("decimal(18,2)").alias("total"), "updated_at", F.lit(None).cast("string").alias("review_status"))


@query(f"WITH {_OLD}, {_NEW} SELECT id, total FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.document_id = old.document_id) UNION ALL SELECT id, total FROM new")
def replace_rows(spark: SparkSession, d: str) -> DataFrame:
    return merge.replace_rows(_old(spark, d), _new(spark, d), "document_id").select("id", "total")


@query(f"""WITH {_OLD}, {_NEW}, b AS (SELECT *, 0 AS n FROM old UNION ALL SELECT *, 1 FROM new), r AS (SELECT *, row_number() OVER (PARTITION BY natural_key ORDER BY updated_at DESC, id DESC, n DESC) AS k FROM b)
SELECT natural_key, id, total FROM r WHERE k = 1""")
def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    return merge.upsert_latest(_old(spark, d), _new(spark, d), "natural_key", ["updated_at", "id"]).select("natural_key", "id", "total")


@query(f"""WITH {_OLD}, {_NEW} SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.total ELSE o.total END AS total, coalesce(o.review_status, n.review_status) AS review_status FROM old o FULL JOIN new n ON o.id = n.id""")
def upsert_preserve(spark: SparkSession, d: str) -> DataFrame:
    return merge.upsert_preserve(_old(spark, d), _new(spark, d), "id", ["review_status"]).select("id", "total", "review_status")


@query(f"""WITH {_OLD}, {_NEW} SELECT o.id, coalesce(n.total, o.total) AS total FROM old o LEFT JOIN new n ON n.id = o.id""")
def patch_rows(spark: SparkSession, d: str) -> DataFrame:
    return merge.patch(_old(spark, d), _new(spark, d), "id", ["total"]).select("id", "total")


@query(f"""WITH {_OLD} SELECT id FROM old WHERE document_id NOT IN (SELECT id FROM documents WHERE status = 'FLAGGED')""")
def unmap(spark: SparkSession, d: str) -> DataFrame:
    flagged = table(spark, d, "documents").where("status = 'FLAGGED'").select(F.col("id").alias("document_id"))
    return _old(spark, d).join(flagged, "document_id", "left_anti").select("id")


@query(f"""WITH {TASKS}, t AS (SELECT document_id, CASE WHEN status IN ('pending', 'failed', 'claimed') THEN 'checked' ELSE tab END AS tab, status FROM tasks)
SELECT document_id, tab, status FROM t UNION ALL SELECT 'new-' || CAST(doc_id AS VARCHAR), 'checked', 'pending' FROM documents""")
def queue_enqueue(spark: SparkSession, d: str) -> DataFrame:
    t = _tasks(spark, d)
    again = t.select("document_id", F.lit("checked").alias("tab"), F.lit("pending").alias("status"), F.lit(0).alias("attempts"))
    more = table(spark, d, "documents").select(F.concat(F.lit("new-"), F.col("doc_id").cast("string")).alias("document_id"), F.lit("checked").alias("tab"), F.lit("pending").alias("status"), F.lit(0).alias("attempts"))
    return merge.enqueue(t, again.unionByName(more), "document_id", "tab", "status").select("document_id", "tab", "status")


@query(f"""WITH {TASKS}, w AS (SELECT document_id FROM po_customer UNION SELECT document_id FROM faktur_pajak)
SELECT t.document_id, CASE WHEN w.document_id IS NOT NULL AND status IN ('pending', 'failed', 'review') THEN 'claimed' ELSE status END AS status,
  CASE WHEN w.document_id IS NOT NULL AND status IN ('pending', 'failed', 'review') THEN 1 ELSE 0 END AS attempts FROM tasks t LEFT JOIN w ON w.document_id = t.document_id""")
def queue_claim(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "po_customer").select("document_id").unionByName(table(spark, d, "faktur_pajak").select("document_id"))
    return merge.claim(_tasks(spark, d), wanted, "document_id").select("document_id", "status", "attempts")


# ---- learning -----------------------------------------------------------------------------------------------


def _meaning(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "faktur_penjualan").where("coalesce(mapping_status, '') <> 'FOOTER-ONLY'")
    gross = F.col("jumlah") + sum((F.coalesce(F.col(f"disc_{i}"), F.lit(0)) for i in range(1, 6)), F.lit(0))
    pack = F.coalesce(text.pack_size(F.col("kemasan")), F.lit(1))
    m = learn.quantity_meaning(pack, F.col("qty"), F.lit(0), F.col("harga"), gross)
    return t.select("id", F.coalesce("kode_material", F.lit("")).alias("product"), m.alias("meaning"))


_MEANING = r"""lead AS (SELECT *, regexp_extract(upper(trim(kemasan)), '^(\d+(?:\s*[X*]\s*\d+)*)(?:\s*[X*].*)?$', 1) AS lead FROM faktur_penjualan WHERE coalesce(mapping_status, '') <> 'FOOTER-ONLY'),
pk AS (SELECT *, list_filter(regexp_split_to_array(lead, '\s*[X*]\s*'), lambda x: regexp_matches(x, '^\d{1,6}$')) AS parts, jumlah + coalesce(disc_1, 0) + coalesce(disc_2, 0) + coalesce(disc_3, 0) + coalesce(disc_4, 0) + coalesce(disc_5, 0) AS gross FROM lead),
ps AS (SELECT *, CASE WHEN len(parts) > 0 THEN CAST(list_product(list_transform(parts, lambda x: CAST(x AS BIGINT))) AS BIGINT) ELSE 1 END AS pack FROM pk),
m AS (SELECT id, coalesce(kode_material, '') AS product, CASE WHEN qty IS NULL OR harga IS NULL OR gross IS NULL THEN NULL
  WHEN abs(CAST(qty * pack AS DECIMAL(18,4)) * CAST(harga AS DECIMAL(20,4)) - gross) <= greatest(CAST(3 AS DECIMAL(18,4)), abs(gross) * CAST(0.01 AS DECIMAL(6,4))) THEN 'cartons'
  WHEN abs(CAST(qty AS DECIMAL(18,4)) * CAST(harga AS DECIMAL(20,4)) - gross) <= greatest(CAST(3 AS DECIMAL(18,4)), abs(gross) * CAST(0.01 AS DECIMAL(6,4))) THEN 'first-number' ELSE 'unexplained' END AS meaning FROM ps)"""


@query(f"WITH {_MEANING} SELECT id, meaning FROM m")
def qty_semantics(spark: SparkSession, d: str) -> DataFrame:
    return _meaning(spark, d).select("id", "meaning")


_PROMOTED = """n AS (SELECT product, meaning, count(*) AS n FROM m WHERE meaning IS NOT NULL GROUP BY 1, 2), g AS (SELECT *, sum(n) OVER (PARTITION BY product) AS n_group, row_number() OVER (PARTITION BY product ORDER BY n DESC, meaning) AS k FROM n),
p AS (SELECT product, meaning, n, CAST(n_group AS BIGINT) AS n_group FROM g WHERE k = 1 AND n >= 3 AND n >= n_group * CAST(0.6 AS DECIMAL(6,4)))"""


@query(f"WITH {_MEANING}, {_PROMOTED} SELECT product, meaning, n, n_group FROM p")
def kb_learn(spark: SparkSession, d: str) -> DataFrame:
    return learn.promote(_meaning(spark, d), ["product"], "meaning", 3, 0.6).select("product", "meaning", "n", "n_group")


@query(f"""WITH {_MEANING}, {_PROMOTED}, o AS (SELECT id, contains(coalesce(mapping_status, ''), 'REVIEW') OR coalesce(review_status, 'REVIEW') = 'REVIEW' AS open FROM faktur_penjualan)
SELECT m.id, CASE WHEN open AND m.meaning = p.meaning THEN 'PASS-LEARNED' WHEN open THEN 'REVIEW' ELSE 'PASS' END AS status FROM m JOIN o USING (id) LEFT JOIN p USING (product)""")
def kb_apply(spark: SparkSession, d: str) -> DataFrame:
    """Rows that are open for review and read as their product mostly is pass as learned."""
    m = _meaning(spark, d)
    open_ = F.coalesce(F.col("mapping_status"), F.lit("")).contains("REVIEW") | (F.coalesce("review_status", F.lit("REVIEW")) == "REVIEW")
    rows = m.join(table(spark, d, "faktur_penjualan").select("id", open_.alias("open")), "id").withColumn("status", F.when(F.col("open"), "REVIEW").otherwise("PASS"))
    return learn.apply_learned(rows, learn.promote(m, ["product"], "meaning", 3, 0.6), ["product"], "meaning", "status", "REVIEW", "PASS-LEARNED").select("id", "status")


@query(f"""WITH {_MEANING}, n AS (SELECT product, meaning, count(*) AS n FROM m WHERE meaning IS NOT NULL GROUP BY 1, 2)
SELECT product, '{{' || string_agg('"' || meaning || '":' || n, ',' ORDER BY meaning) || '}}' AS evidence FROM n GROUP BY 1""")
def kb_summary(spark: SparkSession, d: str) -> DataFrame:
    return audit.json_counts(_meaning(spark, d), "product", "meaning", "evidence")


@query("""WITH x AS (SELECT DISTINCT document_id, vendor_code FROM po_customer WHERE regexp_matches(vendor_code, '^\\d{9}$')), y AS (SELECT DISTINCT document_id, po_issuer FROM po_customer WHERE po_issuer IS NOT NULL),
n AS (SELECT vendor_code, po_issuer, count(*) AS n FROM x JOIN y USING (document_id) GROUP BY 1, 2), g AS (SELECT *, sum(n) OVER (PARTITION BY vendor_code) AS n_group, row_number() OVER (PARTITION BY vendor_code ORDER BY n DESC, po_issuer) AS k FROM n)
SELECT vendor_code, po_issuer, n, CAST(n_group AS BIGINT) AS n_group FROM g WHERE k = 1 AND n >= 2 AND n >= n_group * CAST(0.2 AS DECIMAL(6,4))""")
def cooccur_alias(spark: SparkSession, d: str) -> DataFrame:
    po = table(spark, d, "po_customer")
    return learn.cooccurrence(po.where(F.col("vendor_code").rlike(r"^\d{9}$")), po.where("po_issuer is not null"), "document_id", "vendor_code", "po_issuer", 2, 0.2).select("vendor_code", "po_issuer", "n", "n_group")


@query(f"""WITH RECURSIVE t AS (SELECT l_orderkey, l_linenumber, max(CASE WHEN l_quantity > 40 THEN l_suppkey END) AS label FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, last_value(label IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label FROM
(SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS l_linenumber, label FROM t)""")
def fixpoint(spark: SparkSession, d: str) -> DataFrame:
    """Labels handed on until nothing changes, over twice as many lines each round: the loop's end state equals one fill."""
    from pyspark.sql import Window as W

    reach = (2**k for k in count())
    t = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.when(F.col("l_quantity") > 40, F.col("l_suppkey"))).alias("label"))
    t = t.select("l_orderkey", F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber")).cast("bigint").alias("l_linenumber"), "label")

    def step(s: DataFrame) -> DataFrame:
        return s.withColumn("label", F.coalesce("label", F.lag("label", next(reach)).over(W.partitionBy("l_orderkey").orderBy("l_linenumber"))))

    return learn.fixpoint(t, step, F.col("label").isNull())


@query("""WITH t AS (SELECT id, mapping_status, abs(coalesce(dasar_pengenaan_pajak, 0)) AS b FROM faktur_pajak) SELECT mapping_status, count(*) AS n, sum(b) AS base FROM t GROUP BY 1""")
def tax_status(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "faktur_pajak").withColumn("b", F.abs(F.coalesce("dasar_pengenaan_pajak", F.lit(0))))
    return t.groupBy("mapping_status").agg(F.count("*").alias("n"), F.sum("b").alias("base"))


def gated(spark: SparkSession, d: str) -> DataFrame:
    return gates.line_gate(table(spark, d, "po_customer"), "qty", "unit_price", "discount", "total", rate="ppn")
