"""Operators on ordered rows, applied."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions import text
from ledgerforge.operators import layouts, lines, windows
from ledgerforge.operators.lines import explode_pages
from ledgerforge.plans.registry import Registry
from ledgerforge.session import table

query = Registry()

# Pages of a document's JSON, in SQL: decoded once more if it was encoded twice.
PAGES = r"""j AS (SELECT doc_id, CASE WHEN json_valid(standard_json) THEN CASE WHEN starts_with(standard_json, '"') THEN json_extract_string(standard_json, '$') ELSE standard_json END END AS b FROM documents),
q AS (SELECT doc_id, unnest(CAST(json_extract(b, '$.pages') AS JSON[])) AS p, generate_subscripts(CAST(json_extract(b, '$.pages') AS JSON[]), 1) AS n FROM j WHERE json_type(b, '$.pages') = 'ARRAY'),
pages AS (SELECT doc_id, coalesce(CAST(json_extract(p, '$.page') AS INTEGER), CAST(n AS INTEGER)) AS page, coalesce(json_extract_string(p, '$.text'), '') AS text FROM q)"""


@query("""WITH f AS (SELECT sha256(text) AS sha, min(struct_pack(created := created, doc_id := doc_id)) AS f, count(*) AS n FROM documents GROUP BY 1)
SELECT f.doc_id AS doc_id, sha, n AS n_copies FROM f""")
def dedupe_sha256(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", "created", F.sha2("text", 256).alias("sha"))
    first = windows.keep_first(t, "sha", ["created", "doc_id"])
    return first.select("doc_id", "sha").join(t.groupBy("sha").agg(F.count("*").alias("n_copies")), "sha").select("doc_id", "sha", "n_copies")


_BY_LINE = """l AS (SELECT l_orderkey, l_linenumber, max(CASE WHEN l_quantity > 40 THEN l_suppkey END) AS label, min(l_returnflag) AS guard FROM lineitem GROUP BY 1, 2)"""


def _order_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.when(F.col("l_quantity") > 40, F.col("l_suppkey"))).alias("label"), F.min("l_returnflag").alias("guard"))


@query(f"""WITH {_BY_LINE}, w AS (SELECT *, last_value(CASE WHEN label IS NOT NULL THEN struct_pack(v := label, g := guard) END IGNORE NULLS)
  OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING) AS p FROM l)
SELECT l_orderkey, l_linenumber, coalesce(label, CASE WHEN p.g = guard THEN p.v END) AS inherited FROM w""")
def asof_inherit(spark: SparkSession, d: str) -> DataFrame:
    return windows.asof_inherit(_order_lines(spark, d), "l_orderkey", "l_linenumber", "label", 3, "guard").select("l_orderkey", "l_linenumber", "inherited")


@query(f"""WITH {_BY_LINE} SELECT l_orderkey, l_linenumber,
  coalesce(last_value(label IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(label IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM l""")
def sig_fill(spark: SparkSession, d: str) -> DataFrame:
    return windows.fill_forward(_order_lines(spark, d), "l_orderkey", ["l_linenumber"], "label", "filled").select("l_orderkey", "l_linenumber", "filled")


@query("""WITH n AS (SELECT purchase_order_no, vendor_code, count(*) AS n FROM po_customer WHERE vendor_code IS NOT NULL AND purchase_order_no IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY purchase_order_no ORDER BY n DESC, vendor_code) AS k, count(*) OVER (PARTITION BY purchase_order_no) AS m FROM n)
SELECT id, coalesce(r.vendor_code, p.vendor_code) AS aligned FROM po_customer p LEFT JOIN (SELECT * FROM r WHERE k = 1 AND m > 1) r USING (purchase_order_no)""")
def vote_align(spark: SparkSession, d: str) -> DataFrame:
    return windows.vote_align(table(spark, d, "po_customer"), "purchase_order_no", "vendor_code").select("id", "aligned")


@query(rf"""WITH {PAGES}, c AS (SELECT doc_id, page, CASE WHEN strpos(lower(text), 'faktur') > 0 THEN 'FAKTUR' WHEN strpos(lower(text), 'order') > 0 THEN 'ORDER' ELSE 'TEXT' END AS label FROM pages),
f AS (SELECT doc_id, label, min(page) AS start_page FROM c GROUP BY 1, 2), m AS (SELECT doc_id, max(page) AS last FROM c GROUP BY 1)
SELECT doc_id, label, start_page, coalesce(lead(start_page) OVER (PARTITION BY doc_id ORDER BY start_page, label) - 1, last) AS end_page FROM f JOIN m USING (doc_id)""")
def split_ranges(spark: SparkSession, d: str) -> DataFrame:
    s = F.lower("text")
    pages = explode_pages(table(spark, d, "documents")).select("doc_id", "page", F.when(F.locate("faktur", s) > 0, "FAKTUR").when(F.locate("order", s) > 0, "ORDER").otherwise("TEXT").alias("label"))
    return windows.label_ranges(pages, "doc_id", "page", "label").select("doc_id", "label", "start_page", "end_page")


@query("""SELECT id, CAST(floor((row_number() OVER (PARTITION BY document_id ORDER BY source_page, row_no, id) - 1) / 3) AS INTEGER) AS chunk FROM po_customer""")
def page_chunks(spark: SparkSession, d: str) -> DataFrame:
    return windows.chunks(table(spark, d, "po_customer"), "document_id", ["source_page", "row_no", "id"], 3).select("id", "chunk")


@query(rf"""WITH {PAGES}, w AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page) AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM pages),
s AS (SELECT doc_id, page, CASE WHEN n <= 3 OR i <= 2 OR i = n THEN text ELSE substr(text, 1, 300) END AS text FROM w)
SELECT doc_id, md5(substr(string_agg(text, chr(10) ORDER BY page, text), 1, 10000)) AS digest FROM s GROUP BY doc_id""")
def page_digest(spark: SparkSession, d: str) -> DataFrame:
    return lines.digest(explode_pages(table(spark, d, "documents")), "doc_id").select("doc_id", F.md5("text").alias("digest"))


@query(rf"""WITH {PAGES} SELECT doc_id, length(string_agg(text, chr(10) ORDER BY page, text)) AS n_chars, count(*) AS n_pages FROM pages GROUP BY doc_id""")
def page_concat(spark: SparkSession, d: str) -> DataFrame:
    p = explode_pages(table(spark, d, "documents"))
    return lines.concat_pages(p, "doc_id").select("doc_id", F.length("text").cast("bigint").alias("n_chars")).join(p.groupBy("doc_id").agg(F.count("*").alias("n_pages")), "doc_id")


_LINE = r"^(\d+) (\d{6,14}) (.+) ([\d.,]+) ([A-Z]{2,5}) ([\d.,]+) ([\d.,]+)$"


def _money_sql(c: str) -> str:
    return rf"""try_cast(CASE WHEN regexp_matches({c}, '^-?\d{{1,3}}(\.\d{{3}})+(,\d+)?$') THEN replace(replace({c}, '.', ''), ',', '.')
  WHEN regexp_matches({c}, '^-?\d{{1,3}}(,\d{{3}})+(\.\d+)?$') THEN replace({c}, ',', '') WHEN regexp_matches({c}, '^-?\d+,\d+$') THEN replace({c}, ',', '.')
  WHEN regexp_matches({c}, '^-?\d+(\.\d+)?$') THEN {c} END AS DECIMAL(18,4))"""


@query(rf"""WITH g AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '(?m)^(NO ITEM QTY|No Kode|Line SKU)')),
l AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM g),
m AS (SELECT doc_id, line_no, regexp_extract(line, '{_LINE}', 2) AS code, regexp_extract(line, '{_LINE}', 3) AS name, regexp_extract(line, '{_LINE}', 4) AS q, regexp_extract(line, '{_LINE}', 5) AS unit,
  regexp_extract(line, '{_LINE}', 6) AS p, regexp_extract(line, '{_LINE}', 7) AS t FROM l WHERE regexp_matches(line, '{_LINE}'))
SELECT doc_id, line_no, code, name, unit, CASE WHEN regexp_matches(q, '^\d+\.\d+$') THEN try_cast(q AS DECIMAL(18,4)) ELSE {_money_sql('q')} END AS qty, {_money_sql('p')} AS price, {_money_sql('t')} AS total FROM m""")
def layout_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = layouts.parse_layouts(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"], layouts.LAYOUTS[:1])
    return rows.select("doc_id", "line_no", "code", "name", "unit", "qty", "price", "total")


@query()
def layout_chain(spark: SparkSession, d: str) -> DataFrame:
    """All layouts, the first one with rows winning each page."""
    return layouts.parse_layouts(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"]).select("doc_id", "line_no", "layout", "code", "name", "qty", "unit", "price", "discount", "total")


@query(rf"""WITH l AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS line_no, regexp_extract_all(unnest(string_split(text, chr(10))), '(\d[\d.,]*\d|\d)', 1) AS n FROM documents)
SELECT doc_id, line_no, {_money_sql('n[-3]')} AS a, {_money_sql('n[-2]')} AS b, {_money_sql('n[-1]')} AS c FROM l WHERE len(n) >= 3""")
def tail_numbers(spark: SparkSession, d: str) -> DataFrame:
    ls = lines.explode_lines(table(spark, d, "documents"), ["doc_id"]).withColumn("t", lines.tail_numbers(F.col("line"), 3)).where("t is not null")
    return ls.select("doc_id", "line_no", F.col("t")[0].alias("a"), F.col("t")[1].alias("b"), F.col("t")[2].alias("c"))


@query()
def tokenize_items(spark: SparkSession, d: str) -> DataFrame:
    return lines.tokenize_items(lines.explode_lines(table(spark, d, "documents"), ["doc_id"]).select("doc_id", "line"), ["doc_id"])


@query()
def glued_split(spark: SparkSession, d: str) -> DataFrame:
    """Rows of po_customer glued into one text are split again: a round trip over real rows."""
    po = table(spark, d, "po_customer").where("qty is not null and unit_price is not null and total is not null")
    glued = F.concat_ws(" ", "product_name", F.col("qty").cast("int").cast("string"), F.lit("CTN"), F.col("unit_price").cast("decimal(16,2)").cast("string"), F.col("total").cast("string"))
    return lines.glued_rows(po.select("id", glued.alias("t")), "id", "t")


@query("""SELECT id, count(*) OVER w AS seen_before FROM documents WHERE created IS NOT NULL WINDOW w AS (PARTITION BY sha256 ORDER BY created, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def seen_before(spark: SparkSession, d: str) -> DataFrame:
    """How often a file's content had arrived before."""
    from pyspark.sql import Window as W

    w = W.partitionBy("sha256").orderBy("created", "id").rowsBetween(W.unboundedPreceding, -1)
    return table(spark, d, "documents").where("created is not null").select("id", F.count("*").over(w).alias("seen_before"))


@query(r"""WITH t AS (SELECT document_id, vendor_name, row_number() OVER (PARTITION BY vendor_name ORDER BY invoice_date DESC NULLS LAST, id) AS k, total FROM invoice_rows WHERE vendor_name IS NOT NULL)
SELECT document_id, vendor_name, CAST(k AS INTEGER) AS k, total FROM t WHERE k <= 3""")
def latest_per_vendor(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    k = F.row_number().over(W.partitionBy("vendor_name").orderBy(F.desc_nulls_last("invoice_date"), "id"))
    return table(spark, d, "invoice_rows").where("vendor_name is not null").select("document_id", "vendor_name", k.alias("k"), "total").where("k <= 3")


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Pages with the label whose word stands first."""
    return explode_pages(table(spark, d, "documents")).select("doc_id", "page", text.page_label(F.col("text")).alias("label"))
