"""Text of pages, lines, paths and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What pages without text are replaced by.
BLANK, UNREADABLE = "[BLANK_PAGE]", "[BLANK_OR_UNREADABLE_PAGE]"
#: Words of table headings by column key.
HEADINGS = {
    "no": r"\bNO\b", "code": r"\b(KODE|CODE|SKU|PLU)\b", "name": r"\b(NAMA|ITEM|DESCRIPTION|DESKRIPSI)\b", "qty": r"\b(QTY|QUANTITY|JUMLAH BARANG)\b",
    "unit": r"\b(SAT|UOM|UNIT)\b", "price": r"\b(HARGA|PRICE)\b", "disc": r"\b(DISC|DISKON|POTONGAN)\b", "amount": r"\b(JUMLAH|AMOUNT|TOTAL)\b",
}


def squeeze(c: Column) -> Column:
    """Blanks of any kind at the ends removed, inside made one space."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def cell(c: Column, most: int = 280) -> Column:
    """A text cell: trimmed, cut, null if empty."""
    return F.nullif(F.substring(F.regexp_replace(c, r"^\s+|\s+$", ""), 1, most), F.lit(""))


def norm_line(c: Column) -> Column:
    """Upper case, digits as #, marks as blanks, squeezed: equal for lines of one layout."""
    s = F.regexp_replace(F.upper(c), r"\d", "#")
    return F.trim(F.regexp_replace(s, r"[^A-Z#]+", " "))


def split_product(c: Column) -> tuple[Column, Column]:
    """(code, name): a leading code of 6 to 14 digits and the rest."""
    s = squeeze(c)
    both, only = r"^(\d{6,14})\s+(.+)$", r"^\d+$"
    return F.when(s.rlike(both), F.regexp_extract(s, both, 1)).when(s.rlike(only), s).otherwise(""), F.when(s.rlike(both), F.regexp_extract(s, both, 2)).when(s.rlike(only), "").otherwise(s)


def pack_size(c: Column) -> Column:
    """Pieces of ``12 X 6 X 250 ML``: the product of the leading whole numbers between x or *; null if there is none."""
    lead = F.regexp_extract(F.upper(F.trim(c)), r"^(\d+(?:\s*[X*]\s*\d+)*)(?:\s*[X*].*)?$", 1)
    parts = F.filter(F.split(lead, r"\s*[X*]\s*"), lambda x: x.rlike(r"^\d{1,6}$"))
    return F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(1).cast("bigint"), lambda a, x: a * x.cast("bigint")))


def split_qty(c: Column) -> tuple[Column, Column]:
    """(qty, unit) of ``12 PCS`` or ``12/PCS``."""
    p = r"^(\d+(?:\.\d+)?)\s*/?\s*([A-Z][A-Z ]*)$"
    s = F.upper(F.trim(c))
    return F.nullif(F.regexp_extract(s, p, 1), F.lit("")).try_cast("decimal(16,4)"), F.nullif(F.trim(F.regexp_extract(s, p, 2)), F.lit(""))


def id_canon(c: Column) -> Column:
    """Digits of a tax number without leading zeros, the last 15; null if none."""
    s = F.regexp_replace(F.regexp_replace(c, r"\D", ""), "^0+", "")
    return F.nullif(F.right(s, F.lit(15)), F.lit(""))


def canon_company(c: Column, own: str, most: int = 60) -> Column:
    """A company in upper case without marks at its end, all writings of the own one as ``SELF``; null if blank."""
    s = F.regexp_replace(F.upper(squeeze(c)), r"[.,\s]+$", "")
    return F.nullif(F.when(s.rlike(own), "SELF").otherwise(F.substring(s, 1, most)), F.lit(""))


def source_page(c: Column) -> Column:
    """The page of ``p3 file`` or ``3``; null without one."""
    return F.nullif(F.regexp_extract(F.trim(c), r"^p?(\d{1,6})", 1), F.lit("")).try_cast("int")


def serial_number(c: Column) -> Column:
    """A 16-digit serial as ``010.002-25.12345678``; null if it has other digits."""
    s = F.regexp_replace(c, r"\D", "")
    return F.when(F.length(s) == 16, F.concat(F.substring(s, 1, 3), F.lit("."), F.substring(s, 4, 3), F.lit("-"), F.substring(s, 7, 2), F.lit("."), F.substring(s, 9, 8)))


def tax_file_parts(name: Column) -> dict[str, Column]:
    """buyer, seller and serial out of a digital tax invoice's file name; null if it isn't one."""
    p = r"^(\d{15})-(\d{16})-(\d{16})-\d{14}\.pdf$"
    return {n: F.nullif(F.regexp_extract(name, p, i), F.lit("")) for i, n in ((1, "buyer"), (2, "serial"), (3, "seller"))}


def tax_rate(printed: Column, base: Column, tax: Column) -> Column:
    """``11%`` or ``1.1%``: of a printed rate (8 and more, below 4, between), else of tax over base; null if neither tells."""
    r = F.nullif(F.regexp_extract(F.translate(printed, ",", "."), r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")
    q = F.try_divide(tax.cast("double"), base.cast("double"))
    return F.when(r.isNotNull(), F.when(r < 4, "1.1%").otherwise("11%")).when(q.between(0.08, 0.14), "11%").when(q.between(0.005, 0.02), "1.1%")


def loose_json(c: Column) -> Column:
    """The JSON text inside an answer: fences stripped, the outermost braces, commas before a closing bracket dropped; null if it still isn't JSON."""
    s = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    s = F.regexp_replace(s, r",\s*([}\]])", "$1")
    return F.when(F.try_parse_json(s).isNotNull(), s)


def code_shape(c: Column) -> Column:
    """The first shape that an order number fits."""
    s = F.upper(F.trim(c))
    return (
        F.when(s.rlike(r"^\d+(\.\d+)+$"), "dotted").when(s.rlike(r"^[A-Z]{2,5}-\d+$"), "dash-code").when(s.rlike(r"^\d{10}$"), "bare-10")
        .when(s.rlike(r"^(\d{13}|\d{15})$"), "bare-13/15").when(s.rlike(r"^\d{6,12}$"), "bare-6/12").when(s.rlike(r"[A-Z]") & s.rlike(r"\d"), "alpha-mix").otherwise("other")
    )


def layout_signature(c: Column, least: int = 3) -> Column:
    """Keys of the headings in a line, sorted and joined; null below ``least``."""
    s = F.upper(c)
    keys = F.array_sort(F.filter(F.array(*[F.when(s.rlike(p), k) for k, p in HEADINGS.items()]), lambda x: x.isNotNull()))
    return F.when(F.size(keys) >= least, F.array_join(keys, "#"))


def variant_key(signature: Column, company: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", signature, company)), 1, 12)


def excerpt(c: Column, most: int = 400) -> Column:
    return F.substring(F.trim(F.regexp_replace(c, r"\s+", " ")), 1, most)


def page_text(c: Column) -> Column:
    """A page's text; a marker if it is blank, another if most of it is unreadable."""
    lines = F.split(F.coalesce(c, F.lit("")), "\n")
    unclear = F.size(F.filter(lines, lambda x: F.lower(x).contains("unclear")))
    meaning = F.length(F.regexp_replace(F.lower(c), r"unclear|[^a-z0-9]", ""))
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", BLANK).when((unclear >= 5) & (meaning < 180), UNREADABLE).otherwise(c)


def tab_guess(path: Column) -> Column:
    """The target table that a path suggests: the first rule that holds."""
    s = F.lower(path)
    return (
        F.when(s.rlike(r"faktur pajak|e-faktur"), "faktur_pajak").when(s.rlike(r"faktur penjualan|sales invoice"), "faktur_penjualan")
        .when(s.rlike(r"tanda terima|receiv"), "tanda_terima").when(s.rlike(r"(^|/)po |purchase order"), "po_customer").otherwise("other")
    )


def issuer_from_path(folder: Column) -> Column:
    """``PT Name`` out of a folder like ``.../123 - PT NAME``; null if it names none."""
    p = r"(PT [A-Z][A-Z .]*)(?: - |/|$)"
    name = F.trim(F.regexp_extract(F.upper(folder), p, 1))
    return F.when(name != "", F.regexp_replace(F.initcap(name), "^Pt ", "PT "))


def mime_of(declared: Column, filename: Column, content: Column | None = None) -> Column:
    """A declared type that is known, else that of the first bytes, else one by extension, else octet-stream. A zip archive goes by its extension."""
    ext = F.lower(F.regexp_extract(filename, r"\.([A-Za-z0-9]+)$", 1))
    known = F.when(declared.isin("application/pdf", "text/plain", "image/jpeg", "image/png"), declared)
    by_ext = F.when(ext == "pdf", "application/pdf").when(ext == "txt", "text/plain").when(ext.isin("jpg", "jpeg"), "image/jpeg").when(ext == "png", "image/png").when(ext == "xlsx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet")
    bytes_ = F.lit(None).cast("string") if content is None else F.nullif(sniff_content(content), F.lit("application/zip"))
    return F.coalesce(known, bytes_, by_ext, F.lit("application/octet-stream"))


def sniff_content(content: Column) -> Column:
    """The type by the first bytes of a file; null if they tell nothing."""
    head = F.hex(F.substring(content, 1, 12))
    return (
        F.when(head.startswith("25504446"), "application/pdf").when(head.startswith("FFD8FF"), "image/jpeg").when(head.startswith("89504E470D0A1A0A"), "image/png")
        .when(head.startswith("52494646") & head.endswith("57454250"), "image/webp").when(head.startswith("504B0304"), "application/zip")
    )


#: The classes of pages in order: what a page in upper case must hold all of, and what it must not hold.
PAGE_CLASSES = (
    ("FAKTUR_PENJUALAN", (r"(?m)^\s*FAKTUR PENJUALAN",), ()),
    ("SLIP_MARIMARI", ("RECEIVING SLIP ORDER",), ()),
    ("GRN_DFI", ("GOODS RECEIVE NOTE",), ()),
    ("RJ_TIPTOP", ("RECEIVING NOTE", "SURAT JALAN", "TIP TOP"), ()),
    ("RJ_BUDI", ("RECEIVING NOTE", "BUDI"), ()),
    ("BPB", ("BUKTI PENERIMAAN BARANG", r"NO\. F/SJ/NPB"), ()),
    ("REC_NOTE", ("RECEIVED NOTE", "REC NO"), ()),
    ("RJ_MEMO", ("RECEIVING MEMO", r"\.PL\."), ()),
    ("GR_SLIP", ("GOOD RECEIPT SLIP",), ()),
    ("GR_BOOTS", (r"\bGOOD RECEIPT\b",), ()),
    ("FAKTUR_PAJAK", (r"(?m)^\s*(FAKTUR PAJAK|FORM 01)", "FAKTUR PAJAK"), ("PURCHASE ORDER",)),
    ("RECEIPT", (r"(?m)^\s*(RECEIVING NOTE|TANDA TERIMA|BUKTI PENERIMAAN BARANG)",), ()),
    ("PURCHASE_ORDER", (r"PURCHASE ORDER|NO PO\s*:|NO\. PO\b|NOMOR P\.O|P\.O NO\b|ORDER NO\b|PO#\s*:",), ()),
    ("RECEIPT", ("RECEIVING NOTE|TANDA TERIMA|PENERIMAAN BARANG",), ()),
    ("VENDOR_INVOICE", (r"(?m)SALES INVOICE|^\s*INVOICE",), ()),
)
#: Classes that are certain by their words alone; of the others only a page with rows is.
CERTAIN_CLASSES = ("FAKTUR_PENJUALAN", "FAKTUR_PAJAK", "PURCHASE_ORDER", "RJ_TIPTOP", "GR_BOOTS")


def page_class(text: Column) -> Column:
    """The class of a page: the first of ``PAGE_CLASSES`` that holds, else OTHER."""
    s = F.upper(F.coalesce(text, F.lit("")))
    out = F.lit("OTHER")
    for name, held, barred in reversed(PAGE_CLASSES):
        c = s.rlike(held[0])
        for p in held[1:]:
            c = c & s.rlike(p)
        for p in barred:
            c = c & ~s.rlike(p)
        out = F.when(c, name).otherwise(out)
    return out


#: Labels of pages and the word that gives each.
LABELS = (("INVOICE", "invoice"), ("FAKTUR", "faktur"), ("ORDER", "order"), ("RECEIPT", "receiv"), ("MAIL", "perihal"))


def page_label(text: Column) -> Column:
    """The label whose word stands first in the text; null if none does."""
    s = F.lower(text)
    at = F.array(*[F.when(F.locate(w, s) > 0, F.struct(F.locate(w, s).alias("at"), F.lit(n).alias("label"))) for n, w in LABELS])
    return F.array_min(F.filter(at, lambda x: x.isNotNull()))["label"]
