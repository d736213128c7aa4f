"""From documents to proved rows in one plan: pages, classes, rows, checks, tabs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerforge.functions.text import CERTAIN_CLASSES, page_class
from ledgerforge.operators.blocks import invoice_lines, tax_invoice_items
from ledgerforge.operators.gates import line_gate
from ledgerforge.operators.layouts import LAYOUTS, Layout, parse_layouts, unread_lines
from ledgerforge.operators.lines import pages_or_text, tokenize_items

RECEIPTS = ("REC_NOTE", "RECEIPT", "SLIP_MARIMARI", "GRN_DFI", "RJ_TIPTOP", "RJ_BUDI", "BPB", "RJ_MEMO", "GR_SLIP", "GR_BOOTS")
#: Which classes' rows go to which tab.
TABS = {"po_customer": ("PURCHASE_ORDER",), "faktur_penjualan": ("FAKTUR_PENJUALAN",), "faktur_pajak": ("FAKTUR_PAJAK",), "tanda_terima": RECEIPTS}

#: What every parser's rows are brought to.
_ROW = {"line_no": "int", "layout": "string", "code": "string", "name": "string", "qty": "decimal(18,4)", "unit": "string", "price": "decimal(18,4)", "discount": "decimal(18,4)", "total": "decimal(18,4)", "cartons": "int", "pieces": "int"}


def classed_pages(pages: DataFrame) -> DataFrame:
    """doc_id, page, text, class: a page continues the class of the page before it if it shows none.

    Pages of one document travel together, with their texts only where they are parsed.
    """
    own = F.nullif(page_class(F.col("text")), F.lit("OTHER"))
    w = W.partitionBy("doc_id").orderBy("page").rowsBetween(W.unboundedPreceding, 0)
    return pages.withColumn("class", F.coalesce(F.last(own, ignorenulls=True).over(w), F.lit("OTHER")))


def map_pages(pages: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Rows of all pages with their class and check.

    The first parser with rows keeps a page: layouts, the parser of its class (sales and tax invoices), and for pages with a
    class the free tokenizer. ``discount`` is the amount read, 0 without one; a sales-invoice line that counts cartons has
    no ``qty``, as its pack is not on the page.
    """
    keys = ["doc_id", "page", "class"]
    classed = classed_pages(pages)
    sales = invoice_lines(classed.where("class = 'FAKTUR_PENJUALAN'"), keys)
    cuts = sum((F.coalesce(F.col(f"disc_{i}"), F.lit(0)) for i in range(2, 6)), F.coalesce(F.col("disc_1"), F.lit(0)))
    # the free tokenizer is Python: it gets the lines that nothing else reads
    rest = unread_lines(classed.where("class <> 'OTHER'"), keys, layouts, kind="class")
    free = tokenize_items(rest, [*keys, "line_no"], once=False)
    parsed = (
        (None, parse_layouts(classed, keys, layouts, kind="class")),
        ("sales-invoice", sales.withColumn("qty", F.when(F.col("cartons") == 0, F.col("pieces"))).withColumn("discount", cuts).withColumnRenamed("amount", "total")),
        ("tax-invoice", tax_invoice_items(classed.where("class = 'FAKTUR_PAJAK'"), keys).withColumnRenamed("amount", "total")),
        ("free", free),
    )
    rows = None
    for order, (layout, p) in enumerate(parsed):
        p = p if layout is None else p.withColumn("layout", F.lit(layout))
        p = p.select(*keys, F.lit(order).alias("_order"), *[(F.col(c) if c in p.columns else F.lit(None)).cast(t).alias(c) for c, t in _ROW.items()])
        rows = p if rows is None else rows.unionByName(p)
    rows = rows.withColumn("_least", F.min("_order").over(W.partitionBy(*keys))).where("_order = _least").drop("_order", "_least")
    return line_gate(rows.withColumn("discount", F.coalesce("discount", F.lit(0).cast("decimal(18,4)"))), "qty", "price", "discount", "total")


def page_review(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """doc_id, page, class, n_rows, confidence, n_chars, excerpt of every page: HIGH where the class is certain by its words or the page gave rows."""
    n = rows.groupBy("doc_id", "page").agg(F.count("*").alias("n_rows"))
    p = classed_pages(pages).join(n, ["doc_id", "page"], "left")
    high = F.col("class").isin(*CERTAIN_CLASSES) | ((F.col("class") != "OTHER") & F.col("n_rows").isNotNull())
    short = F.substring(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")), 1, 400)
    return p.select("doc_id", "page", "class", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.when(high, "HIGH").otherwise("LOW").alias("confidence"), F.length("text").alias("n_chars"), short.alias("excerpt"))


def map_documents(docs: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, DataFrame]:
    """One DataFrame a tab, with named columns, and ``review``: pages that gave no row, documents without any page or text among them.

    All pages are parsed once: the rows are written to the shared folder and the tabs read from there.
    """
    from ledgerforge.session import cut

    pages = pages_or_text(docs)
    rows = cut(map_pages(pages, layouts))
    cols = ("doc_id", "page", "line_no", "layout", "code", "name", "qty", "unit", "price", "total", "gate", "discount", "cartons", "pieces")
    out = {tab: rows.where(F.col("class").isin(*classes)).select(*cols) for tab, classes in TABS.items()}
    out["review"] = page_review(pages, rows).where("n_rows = 0").select("doc_id", "page", "n_chars", "class", "confidence")
    return out
