"""Round trips of the printed layouts: every row of po_customer is printed in a layout, page by document, and read back.

All layouts are tried on every page, so a page also shows that no other rule takes it. The SQL gives what was printed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.operators import blocks, layouts
from ledgerforge.plans.registry import Registry
from ledgerforge.session import table

query = Registry()

# What is printed of a row, in words that Spark and DuckDB share: a name of letters, whole numbers, an amount that they prove.
_SEEN = """SELECT id, coalesce(document_id, 'none') AS doc, trim({name}) AS name, CAST(floor(least(greatest(abs(coalesce(qty, 1)), 1), 990)) AS BIGINT) AS q,
  CAST(floor(least(greatest(abs(coalesce(unit_price, 0)), 1001), 9000000)) AS BIGINT) AS p, CAST(floor(least(abs(coalesce(discount, 0)), 500)) AS BIGINT) AS d FROM {po} WHERE length(trim({name})) >= 8"""
_SPARK = _SEEN.format(name="regexp_replace(upper(product_name), '[^A-Z]+', ' ')", po="{po}")
_DUCK = _SEEN.format(name="regexp_replace(upper(product_name), '[^A-Z]+', ' ', 'g')", po="po_customer")


@dataclass(frozen=True)
class Print:
    """head: the lines before the rows; row: one row's text, in Spark SQL over id, name, q, p, d, no and the printed forms below.

    The rest is what must be read, in SQL for both; None: null.
    """

    head: str
    row: str
    code: str = "lpad(CAST(id AS VARCHAR), 8, '1')"
    name: str = "name"
    qty: str = "q"
    unit: str | None = None
    price: str | None = "p"
    discount: str | None = None
    total: str | None = "q * p"


def _w(*parts: str) -> str:
    return f"concat_ws(' ', {', '.join(parts)})"


def _l(*parts: str) -> str:
    return f"concat_ws(chr(10), {', '.join(parts)})"


# Printed forms: numbers in the two styles, codes of several widths (digits of the id behind ones).
ID = lambda x: f"translate(format_number({x}, 0), ',', '.')"
EN = lambda x: f"format_number({x}, 2)"
C = lambda n, fill="1": f"lpad(CAST(id AS STRING), {n}, '{fill}')"
CODE = lambda n, fill="1": f"lpad(CAST(id AS VARCHAR), {n}, '{fill}')"
NO, BAR, T = "CAST(no % 90 + 1 AS STRING)", "lpad(CAST(id AS STRING), 13, '8')", "q * p"
PO = "PURCHASE ORDER"

PRINTS: dict[str, Print] = {
    "piped": Print("NO | KODE | NAMA", f"concat('| ', {NO}, ' | ', {C(8)}, ' | ', name, ' | ', q, ' | CTN | ', {EN('p')}, ' | ', {EN(T)}, ' |')", unit="'CTN'"),
    "barcode": Print("BARCODE NAMA QTY", _w(BAR, "name", "q", "'PCS'", EN("p"), EN("d"), EN("q * p - d")), CODE(13, "8"), unit="'PCS'", discount="d", total="q * p - d"),
    "unit-slash": Print("SKU NAMA QTY", _w(C(8), "name", "concat(q, '/PCS')", EN("p"), EN(T)), unit="'PCS'"),
    "code-name-qty": Print("NO ITEM QTY HARGA TOTAL", _w(NO, C(8), "name", "q", EN("p"), EN(T))),
    "received": Print("TANDA TERIMA BARANG", _w(NO, C(8), "name", "q", "'CTN'"), unit="'CTN'", price=None, total=None),
    "number-code-name": Print("ITEM LIST", _l(NO, C(8), "name", "concat(q, ' CTN')", EN("p"), EN(T)), unit="'CTN'"),
    "position-name": Print("POS ITEM", _l(f"concat(lpad(CAST((no % 90 + 1) * 10 AS STRING), 5, '0'), ' ', {C(8)})", "name", f"concat(q, ' CTN ', {EN('p')}, ' ', {EN(T)})"), unit="'CTN'"),
    "primafood-pipe": Print(PO, f"concat({NO}, ' | ', {C(8)}, ' | ', {BAR}, ' | ', name, ' | CTN | ', q, ' | ', {EN('p')}, ' | 2.5 | 0 | ', {EN(T)})", unit="'CTN'", discount="2.5"),
    # the order form prints the discount where the price should be; the proof puts them right
    "farmers-horizontal": Print(f"{PO}\nP.O No : 4501", _l(_w(NO, C(8), "'HL'", "concat(q, ',00')", "'KAR/12/'", "CASE WHEN id % 2 = 0 THEN '0' ELSE " + ID("p") + " END", "CASE WHEN id % 2 = 0 THEN " + ID("p") + " ELSE '0' END", ID(T)), f"concat('(', {BAR}, ')')", "name"), unit="'KAR/12/'", discount="0"),
    "dfj-inline": Print(f"{PO}\nNO PO : 771", f"concat({NO}, ' | ', {C(8)}, ' | ', name, ' | Y | N | ', q, ' CT | 12 EA | ', {EN('p')}, ' | 2.00% | 0.00% | ', {EN(T)})", unit="'CT'"),
    "dfj-horizontal": Print(f"{PO}\nNO PO : 771", _w(NO, f"concat({C(7)}, '(', {BAR}, ')')", "name", "'Y N'", "q", "'CT 1 x 12'", "'12 EA 4'", ID("p"), "'2,00% 0,00%'", ID(T), ID(T)), CODE(7), unit="'CT'"),
    "tiptop-barcode": Print(f"{PO}\n0001.PO.25.000001", _w(NO, C(7), "name", "'Disc: 3.00% 03 500ML LSN'", BAR, "q", EN("p"), EN(T)), CODE(7), "name || ' 500ML'", unit="'LSN'"),
    "boots-inline": Print(PO, _w("lpad(CAST((no % 90 + 1) * 10 AS STRING), 5, '0')", C(10), "name", "q", "'EA'", "'0 0 0'", EN("p"), EN(T)), CODE(10), unit="'EA'"),
    "aeon": Print(f"{PO}\nPO No : 71234567", _l(NO, "name", "'12.00'", "'CARTON'", "'12'", C(8, "5"), BAR, "concat(q, '.00')", "'0.00'", "'-'", EN("p"), EN(T)), CODE(8, "5"), unit="'CARTON'"),
    "dfj-vertical": Print(f"{PO}\nNO PO : 771", _l(NO, f"concat({C(7)}, '(', {BAR}, ')')", "name", "'12'", "'Y'", "'N'", "concat(q, ' CT')", "'144 EA'", EN("p"), "'2.00%'", "'0.00%'", EN(T)), CODE(7), unit="'CT'"),
    "boots-vertical": Print(PO, _l("lpad(CAST((no % 90 + 1) * 10 AS STRING), 5, '0')", f"concat('A', {C(11)})", BAR, "name", "'Country of Origin : ID'", "q", "'EA'", "'0'", "'0'", "CASE WHEN id % 2 = 0 THEN concat_ws(chr(10), " + EN("p") + ", '0.00') ELSE " + EN("p") + " END", EN(T)), f"'A' || {CODE(11)}", unit="'EA'"),
    "tiptop": Print(f"{PO}\n0001.PO.25.000001", _w(NO, C(8), "name", "'CTN12'", "q", EN("p"), EN(T)), CODE(8), "name || ' CTN12'", unit="'CTN'"),
    "mitra": Print(f"{PO}\nPR No : 123456", _w(NO, C(9), "name", "'BOX/12'", BAR, "q", "'v'", EN("p"), EN(T)), CODE(9), unit="'BOX/12'"),
    "primafood": Print(f"{PO}\nNomor P.O : 55123", _l(NO, C(8), "name", "'CTN'", BAR, "q", EN("p"), "'0'", "'0'", "'0'", EN(T)), discount="0"),
    "yogya": Print("ORDER NO\n4501234567", _l(NO, C(14, "2"), "'0101'", "'1234567'", "name", "q", "'1:'", "'0'", EN("p"), "'0'", "'0'", EN(T)), CODE(14, "2")),
    "kalimalang": Print(f"{PO}\nNo Pemesanan : 11", _w(NO, C(13, "8"), "name", "'1 DUS'", EN("p * 12"), "q", "'PCS'", EN("p"), EN("d"), EN("q * p - d")), CODE(13, "8"), unit="'PCS'", discount="d", total="q * p - d"),
    "bpb-line": Print("BUKTI PENERIMAAN BARANG\nNo. F/SJ/NPB : 1\nNo. PO : 99", _w(NO, C(8), "name", "concat(q, '/CTN')", "'12/0'", "'0'"), unit="'CTN'", price=None, total=None),
    "bpb-block": Print("BUKTI PENERIMAAN BARANG\nNo. F/SJ/NPB : 1\nNo. PO : 99", _l(NO, C(8), "name", "'12/CTN'", "concat(q, '/0')"), unit="'CTN'", price=None, total=None),
    "hypermart": Print("E-PO HYPERMART\nPO#: 4501234", _w("q", "name", BAR, C(8), "'1 12'", ID("p"), ID("d"), ID("q * p - d")), discount="CASE WHEN d = 0 AND q * p = 0 THEN 0 ELSE d END", total="q * p - d"),
    "lion": Print(f"{PO}\nPO Number : L450123", _w(f"concat({NO}, '.')", C(8), "name", "q", "'-'", ID("p"), ID("d"), "'100'", ID("q * p - d")), discount="d", total="q * p - d"),
    "astro": Print("PURCHASE ORDER DETAILS", _w(f"concat('SKU-', {C(8)})", "name", "q", ID("p"), ID(T)), f"'SKU-' || {CODE(8)}"),
    "midi": Print("LAPORAN PENERIMAAN BARANG\nNo. PO : 4501234", f"concat({NO}, '. | ', {C(8)}, ' | ', name, ' | ', q, ' PCS | 1*12 | ', {ID('p')}, ' | 0,00 | 0 | ', {ID(T)})"),
    "aeon-slip": Print(f"{PO}\nAEON\nPO No\n123456789012", _l(NO, "name", "'1.00'", "'EACH'", C(8, "5"), BAR, "concat(q, '.00')", "'0.00'", "'-'", EN("p"), EN(T)), CODE(13, "8"), unit="'EACH'"),
    "grandlucky": Print("GRANDLUCKY ORDER TO\nPO#: 123456", _w(NO, C(10), "name", "'CRT/12'", BAR, "q", "'Pcs'", ID("p"), ID(T)), CODE(10), "name || ' CRT/12'", unit="'Pcs'"),
    "harihari": Print("HARI HARI PASAR SWALAYAN\nNo PO : 12345", _l(NO, C(8), BAR, "name", ID("p % 900000 + 1001"), "'12 PCS'", "q"), CODE(13, "8"), qty="q * 12", unit="'PCS'", price="p % 900000 + 1001", total="q * 12 * (p % 900000 + 1001)"),
    "dutabuah": Print(f"{PO}\nDUTA BUAH SEGAR\nNOMER ORDER DB123456", _w(BAR, "name", "q", "'PCS'", ID("p"), "'0%|0%|Rp.0 0'", ID(T)), CODE(13, "8"), unit="'PCS'"),
    "gramedia": Print(f"GRAMEDIA {PO}", _w(NO, C(8), BAR, "name", "q", ID("p"), "'0 0'", ID(T))),
    "kage": Print(f"{PO}\nKAGE DWIJAYA\nNo. : PO-12345", _w(NO, "name", C(8), "q", ID("p"), "'0 0'", ID(T))),
    "berkah": Print("PT BERKAH MAKMUR OPS\nPO#: POID123456", _w(f"concat('ID', {C(8)})", BAR, "name", "'1/A1 CTN'", ID("p"), "'2.5%'", "'100'", "'x'", "'-'", ID("p"), "q", ID(T), "'100'"), f"'ID' || {CODE(8)}", unit="'CTN'"),
    "marimari-line": Print("RECEIVING SLIP ORDER", _w(NO, C(8), BAR, "name", "'12.00 PC'", "q", "'KTN'", EN("p"), "'2.50%'", EN(T)), unit="'KTN'"),
    "marimari-block": Print("RECEIVING SLIP ORDER", _l(NO, C(8), "name", "'12.00 PC'", "concat(q, ' KTN')", EN("p"), EN(T)), unit="'KTN'", price=None, total=None),
    "slip": Print("GOOD RECEIPT SLIP", _l(_w(NO, C(8), "'HL'", "q", "'EA'", "'0010'", "'00010'"), "name"), unit="'EA'", price=None, total=None),
    "boots-receipt-line": Print("GOOD RECEIPT", _w("lpad(CAST(no % 90 + 1 AS STRING), 4, '0')", f"concat('A', {C(9)})", BAR, "name", "'Country of Origin : ID'", "q", "'EA'", "'0 0 0'", EN("p"), EN(T)), f"'A' || {CODE(9)}", unit="'EA'"),
    "boots-receipt-block": Print("GOOD RECEIPT", _l("lpad(CAST(no % 90 + 1 AS STRING), 4, '0')", f"concat('A', {C(9)})", BAR, "name", "'Country of Origin : ID'", "q", "'EA'", "'0'", EN("p"), EN(T)), f"'A' || {CODE(9)}", unit="'EA'"),
    "grn": Print("GOODS RECEIVE NOTE\nNO PO : 1", _l(f"concat({NO}, ' ', {C(8)}, '(', {BAR}, ')')", "name", f"concat('Y N 1 CT 12 EA ', q, ' ', {EN('p')}, ' ', {EN(T)})"), unit="'EA'"),
    "tiptop-receipt": Print("RECEIVING NOTE SURAT JALAN TIP TOP", _w(NO, "'0001.PO.25.000123'", C(8), "name", "'LSN'", "q"), unit="'LSN'", price=None, total=None),
    "memo": Print("RECEIVING MEMO", _w(NO, "'0001.PL.25.123'", C(10), C(7), "name", "q", "'CRT/12'"), CODE(7), unit="'CRT/12'", price=None, total=None),
    "received-note": Print("RECEIVED NOTE\nREC NO\n1234567", _l(NO, BAR, "'LV'", C(8, "5"), "name", "concat(q, ' 0')", "'PCS'"), CODE(8, "5"), unit="'PCS'", price=None, total=None),
    "budi-receipt": Print("RECEIVING NOTE BUDI", _w(NO, "'0000.PL.25.12'", C(10), C(8), "name", "q", "'PAC'"), unit="'PAC'", price=None, total=None),
}


def printed(spark: SparkSession, d: str, how: Print) -> DataFrame:
    """(doc, text): a page for every document, its rows printed one below the other."""
    from pyspark.sql import Window as W

    po = table(spark, d, "po_customer")
    seen = spark.sql(_SPARK, po=po)
    rows = seen.withColumn("no", F.row_number().over(W.partitionBy("doc").orderBy("id")) - 1).select("doc", F.struct("id", F.expr(how.row).alias("t")).alias("r"))
    page = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["t"]), "\n")
    return rows.groupBy("doc").agg(F.concat(F.lit(how.head + "\n"), page, F.lit("\nTotal : 1")).alias("text"))


_CELLS = {"code": "VARCHAR", "name": "VARCHAR", "qty": "DECIMAL(18,4)", "unit": "VARCHAR", "price": "DECIMAL(18,4)", "discount": "DECIMAL(18,4)", "total": "DECIMAL(18,4)"}


def _register(layout: str, how: Print) -> None:
    want = ", ".join(f"CAST({getattr(how, c) or 'NULL'} AS {t}) AS {c}" for c, t in _CELLS.items())

    def run(spark: SparkSession, d: str) -> DataFrame:
        return layouts.parse_layouts(printed(spark, d, how), ["doc"]).select("doc", "layout", *_CELLS)

    run.__name__ = f"layout_{layout.replace('-', '_')}"
    run.__doc__ = f"Rows printed and read back in the layout {layout}."
    query(f"SELECT doc, '{layout}' AS layout, {want} FROM ({_DUCK})")(run)


for _name, _how in PRINTS.items():
    _register(_name, _how)


_TAX_ROWS = f"SELECT *, row_number() OVER (PARTITION BY doc ORDER BY id) AS no FROM ({_DUCK})"


@query(f"""WITH r AS ({_TAX_ROWS}) SELECT doc, CASE WHEN no % 3 = 2 THEN lpad(CAST(id AS VARCHAR), 8, '1') END AS code, name, CAST(p AS DECIMAL(18,4)) AS price, CAST(q AS DECIMAL(18,4)) AS qty, CAST(d AS DECIMAL(18,4)) AS discount,
  CAST(CASE WHEN no % 7 = 0 THEN q * p + 9999 ELSE q * p END AS DECIMAL(18,4)) AS amount, CASE WHEN no % 7 = 0 AND 9999 > greatest(0.01, (q * p + 9999) * 0.0005) THEN 'MISMATCH' ELSE 'PASS' END AS status FROM r""")
def tax_invoice_items(spark: SparkSession, d: str) -> DataFrame:
    """Items printed in the three shapes of tax invoices and read back; every seventh amount is wrong."""
    amount = "concat(translate(format_number(CASE WHEN (no + 1) % 7 = 0 THEN q * p + 9999 ELSE q * p END, 0), ',', '.'), ',00')"
    no = "CAST((no + 1) % 90 + 1 AS STRING)"
    price = f"concat('Rp ', {ID('p')}, ',00 x ', q)"
    less = f"concat('Potongan Harga : Rp ', {ID('d')}, ',00')"
    row = f"CASE (no + 1) % 3 WHEN 0 THEN {_l(no, amount, 'name', price, less)} WHEN 1 THEN {_l(f'concat({amount}, {no}, chr(32), name)', price, less)} ELSE {_l(f'concat({amount}, {no})', _w(C(8), 'name'), price, less)} END"
    pages = printed(spark, d, Print("FAKTUR PAJAK", row))
    return blocks.tax_invoice_items(pages, ["doc"]).select("doc", "code", "name", "price", "qty", "discount", "amount", "status")


@query(f"""SELECT doc, lpad(CAST(id AS VARCHAR), 7, '1') AS code, name || ' LAGI' AS name, '12 X 250 GR' AS pack, CAST(q AS INTEGER) AS cartons, 3 AS pieces, CAST(p AS DECIMAL(18,4)) AS price, CAST(d AS DECIMAL(18,4)) AS disc_1, CAST(q * p - d AS DECIMAL(18,4)) AS amount FROM ({_DUCK})""")
def invoice_lines(spark: SparkSession, d: str) -> DataFrame:
    """Sales-invoice lines whose name goes on in the next line, printed and read back."""
    row = _l(f"concat({C(7)}, ' ', name, ' ', q, ' / 3 ', {ID('p')}, ' ', {ID('d')}, ' 0 0 0 0 ', {ID('q * p - d')})", "'LAGI 12 X 250 GR'")
    return blocks.invoice_lines(printed(spark, d, Print("FAKTUR PENJUALAN", row)), ["doc"]).select("doc", "code", "name", "pack", "cartons", "pieces", "price", "disc_1", "amount")


@query("""WITH f AS (SELECT id, dasar_pengenaan_pajak AS base, ppn AS tax, regexp_replace(regexp_replace(npwp_pembeli, '\\D', '', 'g'), '^0+', '') AS b, regexp_replace(regexp_replace(npwp_pengusaha, '\\D', '', 'g'), '^0+', '') AS s, nama_pembeli FROM faktur_pajak
  WHERE dasar_pengenaan_pajak >= 0 AND ppn >= 0 AND regexp_matches(npwp_pembeli, '^[0-9.\\-]+$') AND regexp_matches(npwp_pengusaha, '^[0-9.\\-]+$') AND regexp_matches(nama_pembeli, '^[A-Za-z]'))
SELECT id, CAST(base AS DECIMAL(18,4)) AS base, CAST(tax AS DECIMAL(18,4)) AS tax, nullif(right(b, 15), '') AS buyer_id, nullif(right(s, 15), '') AS seller_id, 'KOTA ' || id AS seller_address, '010.002-25.' || lpad(CAST(id AS VARCHAR), 8, '0') AS serial, '7 Agustus 2025' AS date FROM f""")
def tax_header(spark: SparkSession, d: str) -> DataFrame:
    """Headers printed from the rows of tax invoices and read back: both sides in their order."""
    t = table(spark, d, "faktur_pajak").where("dasar_pengenaan_pajak >= 0 and ppn >= 0").where(F.col("npwp_pembeli").rlike(r"^[0-9.\-]+$") & F.col("npwp_pengusaha").rlike(r"^[0-9.\-]+$") & F.col("nama_pembeli").rlike("^[A-Za-z]"))
    lines = [
        F.concat(F.lit("Kode dan Nomor Seri Faktur Pajak : 010.002-25."), F.lpad(F.col("id").cast("string"), 8, "0")), F.concat(F.lit("Nama : "), "nama_pembeli"), F.lit("Alamat : JALAN SATU"), F.concat(F.lit("NPWP : "), "npwp_pembeli"), F.lit("NITKU : 0001"),
        F.lit("Nama : PENJUAL"), F.concat(F.lit("Alamat : KOTA "), F.col("id").cast("string")), F.concat(F.lit("NPWP : "), "npwp_pengusaha"), F.concat(F.lit("Dasar Pengenaan Pajak "), F.expr("translate(format_number(dasar_pengenaan_pajak, 2), ',.', '.,')")),
        F.concat(F.lit("Total PPN "), F.expr("translate(format_number(ppn, 2), ',.', '.,')")), F.lit("KOTA, 7 Agustus 2025"),
    ]
    return blocks.tax_header(t.select("id", F.concat_ws("\n", *lines).alias("text")), ["id"]).select("id", "base", "tax", "buyer_id", "seller_id", "seller_address", "serial", "date")


_PT = "upper(trim(pt))"


@query(f"""SELECT issuer_code, 'PO' || issuer_code AS order_no, '300045' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') AS vendor_code, CASE k % 4 WHEN 0 THEN {_PT} WHEN 1 THEN pt WHEN 2 THEN 'Toko Maju Jaya' END AS issuer,
  CASE k % 4 WHEN 0 THEN 'ISSUER-PT-PAGE' WHEN 1 THEN 'ISSUER-BRAND' WHEN 2 THEN 'ISSUER-STORENAME' ELSE 'ISSUER-MISSING' END AS issuer_tag, CASE WHEN k % 2 = 0 THEN '11%' ELSE '1.1%' END AS rate FROM (SELECT *, row_number() OVER (ORDER BY issuer_code) AS k FROM issuer_list WHERE brand IS NOT NULL AND regexp_matches(pt, '^PT [A-Z][A-Za-z ]{{4,40}}$'))""")
def order_header(spark: SparkSession, d: str) -> DataFrame:
    """Order headers printed for every issuer, by legal name, brand, store name or none, and read back."""
    from pyspark.sql import Window as W

    issuers = table(spark, d, "issuer_list").where(F.col("brand").isNotNull() & F.col("pt").rlike(r"^PT [A-Z][A-Za-z ]{4,40}$")).withColumn("k", F.row_number().over(W.orderBy("issuer_code")))
    names = [(r[0], r[1]) for r in issuers.select("brand", "pt").orderBy(F.desc(F.length("brand")), "brand").limit(2001).collect()]
    k = F.col("k") % 4
    who = F.when(k == 0, F.col("pt")).when(k == 1, F.concat(F.lit("# "), F.col("brand"))).when(k == 2, "Store : Toko Maju Jaya").otherwise("#")
    text = F.concat_ws("\n", F.lit("PURCHASE ORDER"), F.lit("PT OWN FIRM TBK"), who, F.concat(F.lit("PO Number : PO"), "issuer_code"), F.concat(F.lit("VENDOR : 300045"), F.lpad((F.col("k") % 1000).cast("string"), 3, "0")), F.when(F.col("k") % 2 == 0, "PPN 11 %").otherwise("PPN 1,1 %"))
    return layouts.order_header(issuers.select("issuer_code", text.alias("text")), ["issuer_code"], "OWN FIRM", names)


@query("""SELECT id, '7' || id AS delivery_no, '02/03/2025' AS delivery_date, '0001.RC.25.' || id AS receipt_no, '01/03/2025' AS receipt_date FROM tanda_terima WHERE document_no IS NOT NULL""")
def delivery_notes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tanda_terima").select("id", F.when(F.col("document_no").isNotNull(), F.concat(F.lit("RECEIVING NOTE\n0001.RC.25."), F.col("id").cast("string"), F.lit(" 01/03/2025 7"), F.col("id").cast("string"), F.lit(" 02/03/2025"))).otherwise("RECEIVING NOTE").alias("text"))
    return layouts.delivery_notes(t, ["id"])
