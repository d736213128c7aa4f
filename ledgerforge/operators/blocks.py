"""Rows and headers of invoices, read inside the page.

A page is an array of its lines; a row looks at its neighbours in that array, so
no line leaves its page before it is a row: no shuffle, no window, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.functions.money import parse_money
from ledgerforge.functions.text import id_canon
from ledgerforge.operators.layouts import page_lines

#: The lines of a tax invoice's item, and the line that ends the items.
ITEM_PRICE, ITEM_DISCOUNT, ITEM_END = r"^Rp ?([\d.,]+) ?[xX] ?([\d.,]+)$", r"^Potongan Harga ?[:=]? ?Rp ?([\d.,]+)", r"^Harga Jual / Pengganti(?:an)?\b"
AMOUNT, AMOUNT_NAME, AMOUNT_NO, CODE_NAME = r"^(\d[\d.]*(?:,\d+)?)$", r"^(\d[\d.]*,\d{2})(?:\d{1,3})? ?([^\d ].*)$", r"^(\d[\d.]*,\d{2})\d{1,3}$", r"^(\d{5,14}) (\S.*)$"


def _neighbours(pages: DataFrame, keys: list[str], text: str, hit: str, end: str | None = None) -> DataFrame:
    """keys, x: the lines that fit ``hit``, with the two lines before (b, a) and the one after (c); none from ``end`` on."""
    p = pages.where(F.col(text).isNotNull()).select(*keys, page_lines(F.col(text)).alias("_l"))
    if end:
        p = p.withColumn("_l", F.expr(f"""slice(_l, 1, cast(coalesce(nullif(array_position(transform(_l, x -> x.s rlike r"{end}"), true), 0) - 1, size(_l)) as int))"""))
    around = F.expr("transform(_l, (x, i) -> named_struct('n', x.n, 's', x.s, 'a', get(_l, i - 1).s, 'b', get(_l, i - 2).s, 'c', get(_l, i + 1).s))")
    return p.select(*keys, F.explode(F.filter(around, lambda x: x["s"].rlike(hit))).alias("x"))


def tax_invoice_items(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Items of digital tax invoices, up to the line of their sum: ``Rp price x qty`` stands under the name, a discount below it.

    The amount stands above the name, or before it in its line, with or without the running number glued to it; a code may
    lead the name. keys, line_no, code, name, price, qty, discount, amount, and status PASS if price x qty is the amount
    within 0.05 %, else MISMATCH.
    """
    x = _neighbours(pages, keys, text, ITEM_PRICE, ITEM_END)
    g = lambda c, p, i: F.when(F.col(f"x.{c}").rlike(p), F.regexp_extract(f"x.{c}", p, i))
    name = F.coalesce(g("a", AMOUNT_NAME, 2), g("a", CODE_NAME, 2), F.col("x.a"))
    amount = F.coalesce(g("a", AMOUNT_NAME, 1), g("b", AMOUNT_NO, 1), g("b", AMOUNT, 1), g("b", r"^(\d[\d.]*,\d{2})", 1))
    out = x.select(
        *keys, F.col("x.n").alias("line_no"), g("a", CODE_NAME, 1).alias("code"), F.trim(name).alias("name"), parse_money(F.regexp_extract("x.s", ITEM_PRICE, 1)).alias("price"), parse_money(F.regexp_extract("x.s", ITEM_PRICE, 2)).alias("qty"),
        F.coalesce(parse_money(g("c", ITEM_DISCOUNT, 1)), F.lit(0).cast("decimal(18,4)")).alias("discount"), parse_money(amount).alias("amount"),
    )
    fits = F.abs(F.col("price") * F.col("qty") - F.col("amount")) <= F.greatest(F.lit("0.01").cast("decimal(18,4)"), F.col("amount") * F.lit("0.0005").cast("decimal(6,4)"))
    return out.withColumn("status", F.when(fits, "PASS").otherwise("MISMATCH"))


#: Where the facts of a tax invoice stand. What a page prints of both sides stands for the buyer first, then for the seller.
TAX_HEADER = {
    "serial": r"(?i)kode dan nomor seri[^:\n]*:\s*([\d.\-]+)", "base": r"(?im)^ ?dasar pengenaan pajak ?[:*]? ?(?:rp)? ?([\d.,]+)", "tax": r"(?i)(?:total|jumlah) ppn[^\d\n]*([\d.,]+)",
    "reference": r"(?i)referensi\s*:?\s*\(?([A-Z0-9/\-]+)", "paid": r"(?m)^(\d+/?SOR\d+)", "date": r"(?i)(\d{1,2} (?:januari|februari|maret|april|mei|juni|juli|agustus|september|oktober|november|desember) \d{4})",
    "gross": r"(?im)^harga jual / pengganti(?:an)? ([\d.,]+)", "discount": r"(?im)^([\d.,]+) ?dikurangi potongan harga", "advance": r"(?im)^([\d.,]+) ?dikurangi uang muka", "tax_other": r"(?im)^([\d.,]+) ?dikurangi ppn yang harus dibayar",
}
TAX_SIDES = {"id": r"(?im)^npwp ?: ?([\d.\-/ ]+)", "unit": r"(?im)^nitku ?: ?([\d ]+)", "name": r"(?im)^nama ?: ?([^\n]+)\nalamat", "address": r"(?im)^alamat ?: ?([^\n]+)"}


def scan_header(docs: DataFrame, keys: list[str], patterns: dict[str, str], text: str = "text") -> DataFrame:
    """The first match of each pattern in a whole text, null without one."""
    return docs.select(*keys, *[F.nullif(F.regexp_extract(text, p, 1), F.lit("")).alias(n) for n, p in patterns.items()])


def tax_header(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The header of tax invoices: TAX_HEADER, and id, unit, name and address of ``buyer_`` and ``seller_``; amounts typed, tax numbers canonical."""
    both = {f"{side}_{n}": F.nullif(F.trim(F.get(F.regexp_extract_all(text, F.lit(p), 1), F.lit(i))), F.lit("")) for i, side in enumerate(("buyer", "seller")) for n, p in TAX_SIDES.items()}
    h = docs.select(*keys, *[F.nullif(F.regexp_extract(text, p, 1), F.lit("")).alias(n) for n, p in TAX_HEADER.items()], *[c.alias(n) for n, c in both.items()])
    for c in ("base", "tax", "gross", "discount", "advance", "tax_other"):
        h = h.withColumn(c, parse_money(F.col(c)))
    return h.withColumn("buyer_id", id_canon(F.col("buyer_id"))).withColumn("seller_id", id_canon(F.col("seller_id")))


#: A sales-invoice line, what its following line must not be, and a pack at the end of a name.
INVOICE_LINE = r"^(\d{7}) (?:\d{4,10} )?(.+?) (\d+) ?/ ?(\d+) (.+)$"
NO_NAME = r"(?i)^(?:\d{7} |total|dasar|ppn|subtotal|cap|jumlah|dpp)"
PACK = r"((?:\d+ ?[Xx] ?)+[\d.]+ ?(?:ML|GR|G|KG|L|CC))$"


def invoice_lines(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Sales-invoice lines ``code name carton/pieces ... numbers``: price, five discounts and amount are the last seven numbers.

    The line after it continues the name unless it begins a row or a sum; a pack that ends the name is split off. A line
    with fewer numbers is no row.
    """
    x = _neighbours(pages, keys, text, INVOICE_LINE)
    part = lambda i: F.regexp_extract("x.s", INVOICE_LINE, i)
    nums = F.regexp_extract_all(part(5), F.lit(r"((?<![A-Za-z\d])\d[\d.,]*)"), 1)
    more = F.when(F.col("x.c").rlike("[A-Za-z]") & ~F.col("x.c").rlike(NO_NAME) & ~F.col("x.c").rlike(r"\d{4,}"), F.col("x.c"))
    whole = F.concat_ws(" ", part(2), more)
    out = x.select(*keys, F.col("x.n").alias("line_no"), part(1).alias("code"), F.trim(F.regexp_replace(whole, PACK, "")).alias("name"), F.nullif(F.regexp_extract(whole, PACK, 1), F.lit("")).alias("pack"), part(3).cast("int").alias("cartons"), part(4).cast("int").alias("pieces"), nums.alias("_n")).where("size(_n) >= 7")
    at = lambda k: parse_money(F.element_at("_n", k - 8))
    return out.select(*keys, "line_no", "code", "name", "pack", "cartons", "pieces", at(1).alias("price"), *[at(i + 1).alias(f"disc_{i}") for i in range(1, 6)], at(7).alias("amount"))


#: The sums at the foot of a sales-invoice page.
FOOTER = {"base": r"(?i)(?:dasar pengenaan pajak|dpp) ?:? ?([\d.,]+)", "tax": r"(?im)^ppn? ?:? ?([\d.,]+)", "total": r"(?m)^TOTAL ?:? ?([\d.,]+)"}


def invoice_footers(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, base, tax, total of the pages that print any of them: the row of a page's sums."""
    f = scan_header(pages, keys, FOOTER, text)
    return f.select(*keys, *[parse_money(F.col(c)).alias(c) for c in FOOTER]).where("base is not null or tax is not null or total is not null")


def children(ranges: DataFrame, pages: DataFrame, doc: str, page: str = "page") -> DataFrame:
    """The pages of each part: parts know their document, so the range join is an equi-join with a filter."""
    return ranges.join(pages, doc).where(F.col(page).between(F.col("start_page"), F.col("end_page")))


def envelope(docs: DataFrame, version: str = "1") -> Column:
    """What is delivered of a document, as JSON: version, identity, and its body."""
    return F.to_json(F.struct(F.lit(version).alias("schema_version"), F.col("id").alias("document_id"), "filename", "sha256", F.substring(F.sha2(F.concat_ws("|", "id", F.lit(version)), 256), 1, 32).alias("task_id"), F.col("standard_json").alias("extracted")))
