import datetime as dt
import json
import zipfile

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from ledgerforge.functions.dates import parse_date
from ledgerforge.functions.money import format_id, parse_money
from ledgerforge.functions.status import add_tag
from ledgerforge.functions.text import page_text, sniff_content
from ledgerforge.operators import audit, blocks, external, gates, learn, lines, merge, windows, layouts
from ledgerforge.plans import catalogue, generic, printed
from ledgerforge.plans.pipeline import map_documents
from ledgerforge.sources import files
from ledgerforge.sources.store import Store, dump_json, export_csv
from ledgerforge.streaming import watch
from ledgerforge.streaming.delivery import Delivery, delivery_batch, delivery_stream

PRINTED = {f"layout_{n.replace('-', '_')}": n for n in printed.PRINTS}
CORE = sorted(set(catalogue.QUERIES) - set(PRINTED))


@pytest.fixture(scope="module")
def con(sf):
    import glob
    import os

    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return c


def table(df: pd.DataFrame) -> list:
    def one(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return None
        try:
            return round(float(v), 6)
        except (TypeError, ValueError):
            return str(v)

    return sorted((tuple(one(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", CORE)
def test_query_against_sql(spark, sf, con, name):
    got = catalogue.QUERIES[name](spark, sf).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in catalogue.SQL:
        want = con.sql(catalogue.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert table(got) == table(want)


def test_printed_layouts_against_sql(spark, sf, con):
    """Every layout in one run: the pages of all prints, read once."""
    pages = None
    for name, layout in PRINTED.items():
        p = printed.printed(spark, sf, printed.PRINTS[layout]).withColumn("q", F.lit(name))
        pages = p if pages is None else pages.unionByName(p)
    got = layouts.parse_layouts(pages, ["q", "doc"]).select("q", "doc", "layout", "code", "name", "qty", "unit", "price", "discount", "total").toPandas()
    for name in PRINTED:
        assert table(got[got.q == name].drop(columns="q")) == table(con.sql(catalogue.SQL[name]).df()), name


def test_objects_against_sql(spark, sf, con):
    got = generic.QUERIES["p4_found"](spark, sf).toPandas()
    assert table(got) == table(con.sql(generic.SQL["p4_found"]).df()) and len(got) > 100


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize(
    ("typed", "want"),
    [("1.234,56", 1234.56), ("1,234.56", 1234.56), ("1.234", 1234), ("1,234", 1234), ("12,5", 12.5), ("12.5", 12.5), ("Rp 5.000", 5000), ("11%", 11), ("2 / 0", None), ("-", None), ("", None), (None, None), ("999999999999999", None), ("1.234.567", 1234567)],
)
def test_money(spark, typed, want):
    got = spark.createDataFrame([(typed,)], "s string").select(parse_money(F.col("s"))).first()[0]
    assert (got if got is None else float(got)) == want


def test_money_round_trip(spark):
    df = spark.range(1, 2000).select((F.col("id") * 7919 % 100000007 / 100).cast("decimal(18,2)").alias("v"))
    assert df.where(parse_money(format_id(F.col("v"))) != F.col("v")).count() == 0


@pytest.mark.parametrize(("typed", "want"), [("3.4.25", "2025-04-03"), ("31/12/2024", "2024-12-31"), ("2024-02-30", None), ("7 Agustus 2025", "2025-08-07"), ("1-mei-25", "2025-05-01"), ("x", None), (None, None)])
def test_dates(spark, typed, want):
    got = spark.createDataFrame([(typed,)], "s string").select(parse_date(F.col("s"))).first()[0]
    assert (None if got is None else got.isoformat()) == want


def test_tags_and_blank_pages(spark):
    df = spark.createDataFrame([(None,), ("A",), ("A|T",)], "s string")
    assert [r[0] for r in df.select(add_tag(F.col("s"), "T", F.lit(True))).collect()] == ["T", "A|T", "A|T"]
    t = spark.createDataFrame([(None,), (" ",), ("\n".join(["unclear"] * 5),), ("text",)], "s string")
    assert [r[0] for r in t.select(page_text(F.col("s"))).collect()] == ["[BLANK_PAGE]", "[BLANK_PAGE]", "[BLANK_OR_UNREADABLE_PAGE]", "text"]


def test_gate_mutation(spark):
    """A true line passes, the same line with one digit changed doesn't, a missing operand says so."""
    from decimal import Decimal as D

    rows = [(D(3), D(1000), D(0), D(3000), None), (D(3), D(1000), None, D(3330), "11%"), (D(3), D(1000), None, D(3330), "1.1%"), (D(3), D(1000), None, D(3033), "1.1%"), (D(3), D(1000), None, D(3330), None), (D(3), D(1000), D(0), D(8000), "11%"), (None, D(1), D(0), D(1), None)]
    df = spark.createDataFrame(rows, "q decimal(16,4), p decimal(16,4), d decimal(16,2), t decimal(16,2), r string")
    assert [x.gate for x in gates.line_gate(df, "q", "p", "d", "t", rate="r").collect()] == ["OK", "GROSS-11", "REVIEW-ARITH", "OK", "REVIEW-ARITH", "REVIEW-ARITH", "VERIFY"]  # 1.1 % lies within the tolerance


def test_asof_uses_range_not_rows(spark):
    df = spark.createDataFrame([(1, 1, "a", "g"), (1, 3, None, "g"), (1, 5, None, "g"), (1, 6, None, "h"), (2, 1, None, "g")], "k int, page int, v string, g string")
    got = {(r.k, r.page): r.inherited for r in windows.asof_inherit(df, "k", "page", "v", 3, "g").collect()}
    assert got == {(1, 1): "a", (1, 3): "a", (1, 5): None, (1, 6): None, (2, 1): None}


def test_votes_ties_and_nulls(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None), (None, "z"), ("m", "x")], "k string, v string")
    got = sorted((str(r.k), str(r.v), str(r.aligned)) for r in windows.vote_align(df, "k", "v").collect())
    assert got == [("None", "z", "z"), ("k", "None", "a"), ("k", "a", "a"), ("k", "b", "a"), ("m", "x", "x")]


def test_tax_file_names(spark):
    from ledgerforge.functions.text import tax_file_parts

    df = spark.createDataFrame([("012345678901234-0100022512345678-0987654321098765-20250807101112.pdf",), ("x.pdf",), (None,)], "s string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in tax_file_parts(F.col("s")).items()]).collect()]
    assert got == [("012345678901234", "0100022512345678", "0987654321098765"), (None, None, None), (None, None, None)]


def test_merge_is_idempotent(spark):
    s = "k string, v int, n int"
    old, new = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], s), spark.createDataFrame([("b", 2, 2), ("c", 2, 2)], s)
    once = merge.upsert_latest(old, new, "k", ["n"])
    twice = merge.upsert_latest(once, new, "k", ["n"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [("a", 1, 1), ("b", 2, 2), ("c", 2, 2)]
    r = merge.replace_rows(old, new, "k")
    assert sorted(merge.replace_rows(r, new, "k").collect()) == sorted(r.collect())
    empty = spark.createDataFrame([], s)
    assert merge.upsert_latest(empty, empty, "k", ["n"]).count() == 0


def test_cell_diff_nulls(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "p", "y")], "k int, v string, w string")
    b = spark.createDataFrame([(1, "q", "x"), (3, "p", "y")], "k int, v string, w string")
    got = sorted((r.k, r.field, r.value_a, r.value_b) for r in merge.cell_diff(a, b, "k", ["v", "w"]).collect())
    assert got == [(1, "v", None, "q"), (2, "row", "x", None), (3, "row", None, "x")]


def test_learning(spark):
    df = spark.createDataFrame([("p", "a")] * 3 + [("p", "b")] + [("q", "a"), ("q", "b")] + [("r", None)], "k string, l string")
    assert [tuple(r) for r in learn.promote(df, ["k"], "l", 3, 0.6).select("k", "l", "n", "n_group").collect()] == [("p", "a", 3, 4)]
    fixes = spark.createDataFrame([("10",), ("",), (None,)], "s string").select(learn.digit_fixes(F.col("s"))).collect()
    assert [r[0] and sorted(r[0]) for r in fixes] == [["18", "40"], None, None]


def render(rows, style):
    """A page of a printed table out of rows, in one of the number styles."""
    n = (lambda x: f"{x:,.2f}") if style == "en" else (lambda x: f"{x:,.0f}".replace(",", "."))
    head = "NO ITEM QTY HARGA TOTAL" if style == "en" else "No Kode Nama Barang Qty Sat Harga Jumlah"
    return "\n".join(["PURCHASE ORDER", head, *(f"{i} {c} {name} {q} CTN {n(p)} {n(q * p)}" for i, (c, name, q, p) in enumerate(rows, 1)), "Grand Total 1"])


def test_render_and_parse(spark):
    """Rows printed in each style and parsed back are the rows."""
    rows = [(f"10{i:05d}", f"ITEM {i} KIKIR", i + 1, 1000 + 37 * i) for i in range(60)]
    pages = spark.createDataFrame([(1, render(rows, "en")), (2, render(rows, "id")), (3, "nothing"), (4, None)], "doc_id int, text string")
    got = layouts.parse_layouts(pages, ["doc_id"]).toPandas()
    assert len(got) == 120
    for d in (1, 2):
        g = got[got.doc_id == d].sort_values("line_no")
        assert [(c, n, int(q), int(p)) for c, n, q, p in zip(g.code, g.name, g.qty, g.price)] == rows
        assert (g.total.astype(float) == g.qty.astype(float) * g.price.astype(float)).all()


STYLES = {
    "piped": lambda r: "\n".join(["NO | KODE | NAMA", *(f"| {i} | {c} | {n} | {q} | CTN | {p:,.2f} | {q * p:,.2f} |" for i, (c, n, q, p) in enumerate(r, 1))]),
    "barcode": lambda r: "\n".join(["BARCODE NAMA QTY", *(f"899{c:0>10} {n} {q} CTN {p:,.2f} 0.00 {q * p:,.2f}" for c, n, q, p in r)]),
    "unit-slash": lambda r: "\n".join(["SKU NAMA QTY", *(f"{c} {n} {q}/CTN {p:,.2f} {q * p:,.2f}" for c, n, q, p in r)]),
    "code-name-qty": lambda r: "\n".join(["NO ITEM QTY HARGA TOTAL", *(f"{i} {c} {n} {q} {p:,.2f} {q * p:,.2f}" for i, (c, n, q, p) in enumerate(r, 1))]),
    "received": lambda r: "\n".join(["RECEIVING NOTE", *(f"{i} {c} {n} {q} CTN" for i, (c, n, q, p) in enumerate(r, 1))]),
}
BLOCK_STYLES = {
    "number-code-name": lambda r: "\n".join(["ITEM LIST", *(f"{i}\n{c}\n{n}\n{q} CTN\n{p:,.2f}\n{q * p:,.2f}" for i, (c, n, q, p) in enumerate(r, 1)), "Total 1"]),
    "position-name": lambda r: "\n".join(["POS ITEM", *(f"00{i}0 {c}\n{n}\n{q} CTN {p:,.2f} {q * p:,.2f}" for i, (c, n, q, p) in enumerate(r, 1)), "Grand Total 1"]),
}


def test_every_layout_round_trip(spark):
    rows = [(f"10{i:05d}", f"ITEM {'ABCDEFGH'[i]} KIKIR", i + 1, 1000 + 37 * i) for i in range(8)]
    pages = spark.createDataFrame([(k, f(rows)) for k, f in STYLES.items()], "doc_id string, text string")
    got = layouts.parse_layouts(pages, ["doc_id"]).toPandas()
    for k in STYLES:
        g = got[got.doc_id == k].sort_values("line_no")
        assert set(g.layout) == {k} and [(n, int(q)) for n, q in zip(g.name, g.qty)] == [(n, q) for _, n, q, _ in rows]
        if k != "received":
            assert (g.total.astype(float) == [q * p for *_, q, p in rows]).all()
    pages = spark.createDataFrame([(k, f(rows)) for k, f in BLOCK_STYLES.items()] + [("none", "x"), ("null", None)], "doc_id string, text string")
    got = layouts.parse_layouts(pages, ["doc_id"]).toPandas()
    for k in BLOCK_STYLES:
        g = got[got.doc_id == k].sort_values("line_no")
        assert [(c, n, int(q), int(p)) for c, n, q, p in zip(g.code, g.name, g.qty, g.price)] == rows
    assert set(got.doc_id) == set(BLOCK_STYLES)
    broken = BLOCK_STYLES["position-name"](rows).replace("1,000.00 1,000.00", "1,000.00 9,000.00")
    assert layouts.parse_layouts(spark.createDataFrame([("b", broken)], "doc_id string, text string"), ["doc_id"]).count() == 7


def test_tax_invoice(spark):
    text = "Kode dan Nomor Seri Faktur Pajak: 010.002-25.12345678\nNPWP : 09.876\nNPWP : 01.234.567.8-901.000\n1\n300.000,00\nSISIR BLACK\nRp 100.000,00 x 3,00\nPotongan Harga = Rp 5.000,00\n2\n50.000,00 KIKIR\nRp 25.000,00 x 2,00\n3\n9,00\nSALAH\nRp 1,00 x 2,00\nDasar Pengenaan Pajak 345.000,00\nTotal PPN 37.950,00\nKOTA, 7 Agustus 2025\n(Referensi: SOR2500001)"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    got = [(r.name, float(r.price), float(r.qty), float(r.discount), float(r.amount), r.status) for r in blocks.tax_invoice_items(docs, ["doc_id"]).orderBy("line_no").collect()]
    assert got == [("SISIR BLACK", 100000, 3, 5000, 300000, "PASS"), ("KIKIR", 25000, 2, 0, 50000, "PASS"), ("SALAH", 1, 2, 0, 9, "MISMATCH")]
    h = blocks.tax_header(docs, ["doc_id"]).orderBy("doc_id").collect()
    assert (h[0].serial, float(h[0].base), float(h[0].tax), h[0].date, h[0].seller_id) == ("010.002-25.12345678", 345000, 37950, "7 Agustus 2025", "12345678901000") and h[0].buyer_id == "9876"
    assert h[1].serial is None and h[2].base is None


def test_invoice_lines(spark):
    text = "FAKTUR PENJUALAN\n1000229 TIQURO SPONS 14/6 20.050 48.120 0 0 0 0 232.580\nLEMBUT BESAR\n1000230 SISIR 2/0 1.000 0 0 0 0 0 2.000\nTOTAL 234.580"
    got = blocks.invoice_lines(spark.createDataFrame([(1, text)], "doc_id int, text string"), ["doc_id"]).orderBy("code").collect()
    assert [(r.code, r.name, r.cartons, r.pieces, float(r.price), float(r.disc_1), float(r.amount)) for r in got] == [("1000229", "TIQURO SPONS LEMBUT BESAR", 14, 6, 20050, 48120, 232580), ("1000230", "SISIR", 2, 0, 1000, 0, 2000)]


def test_layout_edges(spark):
    """Positions from 0100 on, long orders, a proof that fails, nulls and blanks; price and discount that changed places."""
    rows = [(f"A{i:0>11}", "SISIR BESAR", i + 1, 1500 + i) for i in range(120)]
    vertical = "\n".join(["PURCHASE ORDER", *(f"{(i + 1) * 10:0>5}\n{c}\n{n}\n{q}\nEA\n0\n{p:,.2f}\n{q * p:,.2f}" for i, (c, n, q, p) in enumerate(rows)), "Total :"])
    swap = "PURCHASE ORDER\n10 30335668 HL 2,00 KAR/12/ 0 451.892 903.784\n(8990000000001)\nKIKIR\n20 30335669 HL 1,00 EA 500 100 450"
    wrong = "PURCHASE ORDER\nPOS ITEM\n0010 12345678\nGULA\n3 PCS 1.000 9.000"
    pages = spark.createDataFrame([(1, vertical), (2, swap), (3, wrong), (4, None), (5, ""), (6, " \n ")], "doc_id int, text string")
    got = layouts.parse_layouts(pages, ["doc_id"]).toPandas()
    g = got[got.doc_id == 1].sort_values("line_no")
    assert [(c, n, int(q), int(p)) for c, n, q, p in zip(g.code, g.name, g.qty, g.price)] == rows
    g = got[got.doc_id == 2].sort_values("line_no")
    assert [(n, float(p), float(d)) for n, p, d in zip(g.name, g.price, g.discount)][0] == ("KIKIR", 451892, 0)
    assert set(got.doc_id) == {1, 2}


def test_facts_of_a_page(spark):
    pages = spark.createDataFrame([(1, "x\nPT OWN FIRM TBK\nCV MAJU JAYA SENTOSA\nSurat"), (2, None), (3, "halo")], "doc_id int, text string")
    got = {r.doc_id: r.company for r in layouts.first_company(pages, ["doc_id"], "OWN FIRM").collect()}
    assert got == {1: "CV MAJU JAYA SENTOSA", 2: None, 3: None}


def test_children_and_envelope(spark, sf):
    r = spark.createDataFrame([("a", "X", 1, 2), ("a", "Y", 3, 3)], "doc string, label string, start_page int, end_page int")
    p = spark.createDataFrame([("a", i) for i in (1, 2, 3)] + [("b", 1)], "doc string, page int")
    assert sorted((x.label, x.page) for x in blocks.children(r, p, "doc").collect()) == [("X", 1), ("X", 2), ("Y", 3)]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(5)
    sent = [json.loads(x[0]) for x in docs.select(blocks.envelope(docs)).collect()]
    assert all(s["schema_version"] == "1" and len(s["task_id"]) == 32 for s in sent) and len({s["task_id"] for s in sent}) == 5


def test_declared_types_come_first(spark):
    from ledgerforge.functions.text import mime_of

    df = spark.createDataFrame([("application/pdf", "a.txt", b"\x89PNG\r\n\x1a\n0000"), (None, "a.txt", b"\x89PNG\r\n\x1a\n0000"), ("x/y", "a.txt", b"hi"), (None, "a.xlsx", b"PK\x03\x04"), (None, None, None)], "d string, n string, c binary")
    assert [r[0] for r in df.select(mime_of(F.col("d"), F.col("n"), F.col("c"))).collect()] == ["application/pdf", "image/png", "text/plain", files.XLSX, "application/octet-stream"]


def test_uploads(spark):
    import base64

    rows = [("a.txt", base64.b64encode(b"halo").decode()), ("b.png", base64.b64encode(b"\x89PNG\r\n\x1a\n0000").decode()), ("c.txt", "%%%")]
    got = {r.filename: (r.mime, r.size) for r in files.from_base64(spark.createDataFrame(rows, "name string, data_b64 string")).collect()}
    assert got == {"a.txt": ("text/plain", 4), "b.png": ("image/png", 12), "c.txt": ("text/plain", None)}


def test_tokenizer_and_glued():
    assert lines.read_item("1 1000385 VEVULO SISIR BLACK 3 CTN 939,600.00 2,818,800.00") == ("1000385", "VEVULO SISIR BLACK", 3, 939600.0, 2818800.0)
    assert lines.read_item("Grand Total 2,818,800.00") is None
    assert lines.read_item("SISIR 3 100 999") is None
    assert lines.read_item(None) is None and lines.read_item("") is None
    assert lines.split_glued("SISIR BLACK 3 CTN 1000 3000") == ("SISIR BLACK", 3, 1000, 3000)
    assert lines.split_glued("SISIR BLACK") is None and lines.split_glued(None) is None


def test_glued_rows(spark):
    rows = [(1, "1001234 SISIR BLACK 3 CTN 1000 3000", None), (2, "SISIR 3 CTN 1000 3000", " "), (3, "SISIR 3 CTN 1000 3000", "7"), (4, "SISIR", None), (5, None, None)]
    got = lines.glued_rows(spark.createDataFrame(rows, "id int, name string, total string"), "id", "name", ["total"]).orderBy("id").collect()
    assert [(r.id, r.code, r.name, r.qty, r.price, r.total, r.tag) for r in got] == [(1, "1001234", "SISIR BLACK", 3, 1000, 3000, "SPLIT-GLUED"), (2, None, "SISIR", 3, 1000, 3000, "SPLIT-GLUED")]


def test_pipeline_tabs(spark, sf):
    tabs = map_documents(spark.read.parquet(f"{sf}/documents.parquet"))
    assert set(tabs) == {"po_customer", "faktur_penjualan", "faktur_pajak", "tanda_terima", "review"}
    po = tabs["po_customer"]
    # printed totals are net of discounts that the page doesn't show, so only the undiscounted lines prove themselves
    assert po.where("gate in ('OK', 'GROSS-11', 'GROSS-1.1')").count() > 0.4 * po.count() > 0


def test_every_page_class_gives_rows(spark):
    page = lambda *ls: "\n".join(ls)
    tax = page("FAKTUR PAJAK", "1.200,00", "MINYAK GORENG", "Rp 100,00 x 12,00")
    texts = [
        (1, page("FAKTUR PENJUALAN", "1234567 SABUN CAIR 0/3 5.000 100 0 0 0 0 14.900", "1234568 SIKAT 2/0 5.000 0 0 0 0 0 10.000")),
        (2, tax), (3, page("PURCHASE ORDER", "POS ITEM", "0010 12345678", "GULA PASIR", "3 PCS 1.000 3.000")),
        (4, page("PURCHASE ORDER", "BARCODE NAME", "1234567890123 KOPI 3 PCS 1.000 300 2.700")),
        (5, page("PURCHASE ORDER", "Kecap Manis 4 2.500 10.000")), (6, "halo"), (7, None),
    ]
    js = {2: "{broken", 3: '{"pages": {"text": "PURCHASE ORDER\\nPOS ITEM\\n0010 12345678\\nGULA PASIR\\n3 PCS 1.000 3.000"}}', 4: '{"pages": [null]}', 5: '{"other": 1}'}
    docs = spark.createDataFrame([(i, t, js.get(i)) for i, t in texts], "doc_id bigint, text string, standard_json string")
    tabs = map_documents(docs)
    got = {n: sorted((r.doc_id, r.name, None if r.qty is None else float(r.qty), float(r.discount), float(r.total), r.gate) for r in t.collect()) for n, t in tabs.items() if n != "review"}
    assert got["faktur_penjualan"] == [(1, "SABUN CAIR", 3.0, 100.0, 14900.0, "OK"), (1, "SIKAT", None, 0.0, 10000.0, "VERIFY")]
    assert got["faktur_pajak"] == [(2, "MINYAK GORENG", 12.0, 0.0, 1200.0, "OK")]
    assert got["po_customer"] == [(3, "GULA PASIR", 3.0, 0.0, 3000.0, "OK"), (4, "KOPI", 3.0, 300.0, 2700.0, "OK"), (5, "Kecap Manis", 4.0, 0.0, 10000.0, "OK")]
    assert sorted(tuple(r) for r in tabs["review"].collect()) == [(6, 1, 4, "OTHER", "LOW"), (7, 1, 0, "OTHER", "LOW")]


def test_fixpoint_of_a_hot_order(spark, tmp_path):
    rows = [(1, n, 99 if n == 3 else 7, "50" if n in (3, 70) else "1") for n in range(1, 91)] + [(2, 1, 5, "1")]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber bigint, l_suppkey bigint, q string").selectExpr("l_orderkey", "l_linenumber", "l_suppkey", "cast(q as decimal(12,2)) AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {(r[0], r[1]): r[2] for r in catalogue.QUERIES["fixpoint"](spark, str(tmp_path)).collect()}
    assert got == {(1, n): None if n < 3 else 99 if n < 70 else 7 for n in range(1, 91)} | {(2, 1): None}


def test_audit_shapes(spark):
    df = spark.createDataFrame([("a", " ", 1), ("a", None, 2), ("b", "x", 2)], "k string, v string, n int")
    assert {(r.field, r.n_filled) for r in audit.fill_rate(df, ["k", "v"]).collect()} == {("k", 3), ("v", 1)}
    assert [tuple(r)[:2] for r in audit.key_conflict(df.withColumn("v", F.col("n").cast("string")), "k", "v").collect()] == [("a", 2)]
    assert audit.fill_rate(df.where("false"), ["k"]).first().n_filled == 0


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "t.txt").write_text("satu\ndua")
    (tmp_path / "copy.txt").write_text("satu\ndua")
    pdf = b"%PDF-1.4\n1 0 obj << /Type /Page /Contents 2 0 R >> endobj\n2 0 obj << /Length 40 >> stream\nBT (Faktur \\(1\\)) Tj T* (baris) Tj ET\nendstream endobj\n"
    (tmp_path / "x.bin").write_bytes(pdf)
    (tmp_path / "bad.xlsx").write_bytes(b"PK\x03\x04 broken")
    (tmp_path / ".hidden").write_text("no")
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Assets"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Tag</t></si><si><t>Name</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>5</v></c></row></sheetData></worksheet>')
    found = files.scan_folder(spark, str(tmp_path))
    mimes = {r.filename: r.mime for r in found.collect()}
    assert mimes == {"t.txt": "text/plain", "copy.txt": "text/plain", "x.bin": "application/pdf", "b.xlsx": files.XLSX, "bad.xlsx": files.XLSX}
    assert files.first_copies(found).count() == 4
    out = {r.path.split("/")[-1]: r for r in files.extract(found).collect()}
    assert [p.text for p in out["x.bin"].pages] == ["Faktur (1)\nbaris"]
    assert out["b.xlsx"].sheets[0].columns == ["Tag", "", "Name"] and out["b.xlsx"].sheets[0].row_count == 2
    assert out["bad.xlsx"].error and out["bad.xlsx"].sheets is None
    assert out["t.txt"].pages[0].text == "satu\ndua"
    assert spark.range(1).select(sniff_content(F.lit(b"\x89PNG\r\n\x1a\n...."))).first()[0] == "image/png"


def test_store_versions(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
    s = Store(spark, str(tmp_path / "s"), schema)
    assert s.read().count() == 0
    new = spark.createDataFrame([("a", 1)], schema)
    s.commit(lambda old: merge.replace_rows(old, new, "k"), "b0")
    s.commit(lambda old: merge.replace_rows(old, new, "k"), "b1")
    assert s.commit(lambda old: old.unionByName(new), "b1") == 2  # run again: nothing changes
    s.commit(lambda old: old.unionByName(spark.createDataFrame([("c", 3)], schema)))
    assert sorted(map(tuple, s.read().collect())) == [("a", 1), ("c", 3)]
    export_csv(s.read().unionByName(spark.createDataFrame([("d", None)], schema)), str(tmp_path / "csv"), {"KEY": "k", "VALUE": "v"}, ["k"])
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).fillna("").collect()) == [("a", "1"), ("c", "3"), ("d", "")]
    dump_json({"t": s.read()}, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json" / "t")).count() == 2


def test_a_store_survives_a_crash_and_another_stream(spark, tmp_path, monkeypatch):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
    s = Store(spark, str(tmp_path / "s"), schema)
    row = lambda k: spark.createDataFrame([(k, 1)], schema)
    for i in range(5):
        s.commit(lambda old: old.unionByName(row(f"k{i}")), stream="one", batch=i)
    assert len(s.versions()) == Store.KEPT
    # it stops after the data is written, before the pointer stands: readers see the version before, the next commit follows it
    with monkeypatch.context() as m:
        m.setattr(s, "_point", lambda to: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            s.commit(lambda old: old.unionByName(row("lost")), stream="one", batch=5)
    assert s.read().count() == 5
    assert s.commit(lambda old: old.unionByName(row("k5")), stream="one", batch=5) == 6 and s.read().count() == 6
    s.commit(lambda old: old.unionByName(row("again")), stream="one", batch=2)  # long in
    s.commit(lambda old: old.unionByName(row("other")), stream="two", batch=0)  # another stream begins at 0
    assert sorted(r.k for r in s.read().collect()) == [*(f"k{i}" for i in range(6)), "other"]
    # two writers of one version: the second raises
    with pytest.raises(RuntimeError, match="another writer"):
        s._point({"version": 7, "tags": [], "streams": {}})


def test_cuts_are_read_back_and_deleted(spark):
    import glob

    from ledgerforge.session import cut, drop_cut

    df = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    c = cut(df)
    assert sorted(c.collect()) == sorted(df.collect()) and c.schema == df.schema and glob.glob(f"{c._cut_path}/*.parquet")
    drop_cut(c)
    assert not glob.glob(f"{c._cut_path}*")


def test_a_task_in_flight():
    d = Delivery()
    d.see(False, False, 5, sent=True)
    assert (d.status, d.next_us) == ("IN_FLIGHT", None)
    d.see(True, False, 7)
    assert (d.status, d.attempts, d.next_us) == ("RETRY_WAIT", 1, 7 + 5_000_000)
    d.see(False, False, 9, sent=True)
    d.see(False, True, 11)
    d.see(False, False, 12, sent=True)
    assert (d.status, d.attempts) == ("DELIVERED", 1)


def test_delivery_rules():
    d = Delivery()
    d.see(True, False, 0)
    assert d.status == "RETRY_WAIT" and d.next_us == 5_000_000
    d.see(True, False, 10)
    assert d.next_us == 10 + 10_000_000
    d.see(True, False, 20)
    assert d.status == "FAILED_PERMANENT" and d.next_us is None
    d.see(False, True, 30)
    assert d.status == "FAILED_PERMANENT"


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    # batches in order of time, as they would arrive
    for i, (a, b) in enumerate([(0, 300), (300, 700), (700, 10**9)]):
        events.orderBy("ts", "event_id").withColumn("i", F.monotonically_increasing_id()).where(f"event_id >= {a} and event_id < {b}").drop("i").coalesce(1).write.parquet(str(tmp_path / "in" / f"p={i}"))
    args = ("user_id", F.col("event_type") == "error", F.col("event_type") == "purchase", "ts", "event_id")
    want = {r.task: (r.status, r.attempts, r.next_attempt_us) for r in delivery_batch(events, *args).collect()}
    ordered = events.agg(F.max(F.expr("0"))).first() is not None
    assert ordered
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in" / "p=*"))
    q = delivery_stream(stream, *args).writeStream.outputMode("update").format("memory").queryName("delivered").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.task: (r.status, r.attempts, r.next_attempt_us) for r in spark.sql("select * from delivered").collect()}
    assert got == want


def test_watch_merges_once(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("id", "sha256", "created")
    docs.coalesce(1).write.parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "store"), docs.select("id", "sha256").schema)
    step = lambda old, new: merge.replace_rows(old, new.select("id", "sha256"), "id")
    for _ in range(2):  # the second start finds nothing new
        watch.merge_into(watch.watch(spark, str(tmp_path / "in"), docs.schema), store, step, str(tmp_path / "cp")).awaitTermination(120)
    assert store.read().count() == docs.count()
    stream = watch.watch(spark, str(tmp_path / "in"), docs.schema).withColumn("created", F.col("created").cast("timestamp"))
    q = watch.once_by_content(stream, "sha256", "created", "3000 days").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select * from once").count() == docs.select("sha256").distinct().count()


def test_external_client(spark):
    df = spark.createDataFrame([(1, "a"), (2, "boom"), (3, None)], "k bigint, t string")

    def client():
        def ask(t):
            if t == "boom":
                raise ValueError("no")
            return json.dumps({"t": t})

        return ask

    got = {r.k: (r.answer, bool(r.error)) for r in external.call(df, "k", "t", client, tries=2).collect()}
    assert got == {1: ('{"t": "a"}', False), 2: (None, True), 3: ('{"t": null}', False)}
    assert external.undone(df, df.where("k = 1"), ["k"]).count() == 2
    assert external.agree(df, df.where("k <> 2"), "k", ["t"]).count() == 2


def test_spread_footers(spark):
    from decimal import Decimal as D

    s = "doc string, page int, m string, jumlah decimal(16,2), dasar_pengenaan_pajak decimal(16,2), ppn decimal(16,2), total decimal(16,2)"
    rows = [("a", 1, None, D(60), None, None, None), ("a", 1, None, D(40), None, None, None), ("a", 1, "F", None, D(100), D(11), D(111)), ("b", 1, "F", None, None, None, D(5)), ("c", 1, None, D(7), None, None, None)]
    got = gates.spread_footers(spark.createDataFrame(rows, s), ["doc", "page"], F.coalesce(F.col("m") == "F", F.lit(False)))
    assert sorted((r.doc, str(r.m), float(r.page_total)) for r in got.collect()) == [("a", "None", 111.0), ("a", "None", 111.0), ("b", "F", 5.0), ("c", "None", 7.0)]


def test_dates_of_windows(spark):
    assert dt.date(2025, 1, 1) < dt.date(2025, 2, 1)
