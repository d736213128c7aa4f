"""Printed layouts as a table of rules, evaluated inside the page.

A rule says which pages it reads (classes and words), where a row begins, how
many lines it may take, and one pattern over those lines whose named groups are
the row's cells. All rules of a page are one lazy expression over its array of
lines: the first rule that yields a row keeps the page, later ones are not
evaluated, and rows leave by one explode. There is no shuffle, no window and no
Python. Amounts are typed after that, and the rule's proof settles what print
leaves open: which of the tail numbers is the price, whether price and discount
changed places, which number is the discount.

Defined results: null and blank pages give no row; a cell that is not printed is
null; a row whose rule demands proof and that fails it is no row, so a later
rule may read the page; blank lines count for nothing but the line number.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.functions.money import parse_money
from ledgerforge.functions.text import page_class

ORDER = ("PURCHASE_ORDER",)
#: What cells a rule may name; ``code2``, ``name2``, ``qty2`` and ``qty3`` stand in for, or follow, the cell they are named after.
CELLS = ("code", "code2", "name", "name2", "qty", "qty2", "qty3", "unit", "price", "discount", "rates", "tax", "total", "pack", "tail")


@dataclass(frozen=True)
class Layout:
    """name; row: the pattern of a row's lines, joined by line feeds, with named groups out of ``CELLS``.

    classes: page classes that are read, all if empty; gates: patterns that the page must hold; start: with ``span``
    above 1, the pattern of a row's first two lines; span: the most lines of a row; stop: a line that ends a row;
    fixed: cells that are the same in every row. proof: what settles a row's numbers:

    - read: nothing, the cells are as printed
    - prove: qty x price is the total within 3 %, else it is no row
    - pick: ``tail`` ends with the total; the price is the third or second last number, the one that qty times it is the total within 2 %
    - swap: price and discount change places if only that gives the total within 2 %
    - close: the total is the largest number of ``tail``, the discount the one that closes qty x price - discount within 3 %
    - ends: price and total are the first and last amount of ``tail``: numbers with two decimals, without any such those with thousands; percents are none
    - computed: qty is cartons times ``pack``, the total is computed
    """

    name: str
    row: str
    classes: tuple[str, ...] = ()
    gates: tuple[str, ...] = ()
    start: str = ""
    span: int = 1
    stop: str = r"(?i)^(?:grand |sub)?total|^jumlah total"
    proof: str = "read"
    fixed: dict[str, str] = field(default_factory=dict)


#: A printed number, a name in one line that holds letters, and what may follow a row in its block.
_N = r"-?\d[\d.,]*"
_NAME = r"[^\n]*[A-Za-z]{2}[^\n]*"
_REST = r"(?:\n(?s:.*))?$"

# The shapes of printed tables. The order is the priority: the first rule with rows keeps a page.
LAYOUTS = (
    # tables with a heading that names them
    Layout("code-name-qty-unit", rf"^\d+ (?<code>\d{{6,14}}) (?<name>.+?) (?<qty>{_N}) (?<unit>[A-Z]{{2,5}}) (?<price>{_N}) (?<total>{_N})$", gates=(r"(?m)^(NO ITEM QTY|No Kode|Line SKU)",)),
    Layout("piped", rf"^\| ?\d+ ?\| ?(?<code>\d{{6,14}}) ?\| ?(?<name>[^|]+?) ?\| ?(?<qty>{_N}) ?\| ?(?<unit>[A-Z]{{2,6}}) ?\| ?(?<price>{_N}) ?\| ?(?<total>{_N}) ?\|?$", gates=(r"(?m)^\|? *(NO|No) *\|",)),
    Layout("barcode", rf"^(?<code>\d{{13}}) (?<name>.+?) (?<qty>{_N}) (?<unit>[A-Z]{{2,6}}) (?<price>{_N}) (?<discount>{_N}) (?<total>{_N})$", gates=(r"(?m)^BARCODE ",)),
    Layout("unit-slash", rf"^(?<code>\d{{6,14}}) (?<name>.+?) (?<qty>\d+)/(?<unit>[A-Z]{{2,6}}) (?<price>{_N}) (?<total>{_N})$", gates=(r"(?m)^(SKU|PLU) ",)),
    Layout("code-name-qty", rf"^\d+ (?<code>\d{{6,14}}) (?<name>.+?) (?<qty>\d+) (?<price>{_N}) (?<total>{_N})$", gates=(r"(?m)^(NO ITEM|No Kode|Line SKU)",)),
    Layout("received", rf"^\d+ (?<code>\d{{6,14}}) (?<name>.+?) (?<qty>{_N}) (?<unit>[A-Z]{{2,5}})$", gates=(r"(?m)^(RECEIVING NOTE|TANDA TERIMA|BUKTI PENERIMAAN BARANG)",)),
    Layout("number-code-name", rf"^\d{{1,3}}\n(?<code>\d{{6,14}})\n(?<name>[^\n]+)\n(?<qty>{_N}) (?<unit>[A-Z]{{2,6}})\n(?<price>{_N})\n(?<total>{_N}){_REST}", gates=(r"(?m)^ITEM LIST$",), start=r"^\d{1,3}\n\d{6,14}$", span=6, proof="prove"),
    Layout("position-name", rf"^\d{{4,6}} (?<code>\d{{6,14}})\n(?<name>[^\n]+)\n(?<qty>{_N}) (?<unit>[A-Z]{{2,6}}) (?<price>{_N}) (?<total>{_N}){_REST}", gates=(r"(?m)^POS (ITEM|BARANG)$",), start=r"^0+[1-9]\d*0 \d{6,14}\n", span=3, proof="prove"),
    # orders without such a heading
    Layout("primafood-pipe", rf"^\|? ?\d{{1,2}} ?\| ?(?<code>\d{{8}}) ?\|(?: ?\d{{13}} ?\|)? ?(?<name>[^|]+?) ?\| ?(?<unit>[A-Za-z][^|]*?) ?\| ?(?<qty>{_N}) ?\| ?(?<price>{_N}) ?\|(?: ?(?<discount>[\d.]+) ?\|)?(?: ?[\d.]+ ?\|)* ?(?<total>{_N}) ?\|?$", ORDER),
    Layout("farmers-horizontal", rf"^\d{{1,3}} (?<code>\d{{7,}}) (?:HL|NH|HF|NF) (?<qty>{_N}) (?<unit>[A-Z]{{1,6}}/[\d.,/]+|EA|PAC|KTN|CTNS?) (?<price>{_N}) (?<discount>{_N}) (?<total>{_N})(?:\n\(\d{{10,14}}\))*(?:\n(?!.*(?i:PO Creation|Total|Discount))(?<name>[^\n]+))?{_REST}", ORDER, start=r"^\d{1,3} \d{7,} (?:HL|NH|HF|NF) ", span=4, proof="swap"),
    Layout("dfj-inline", rf"^\|? ?\d{{1,2}} ?\| ?(?<code>\d{{5,}})[^|]*\| ?(?<name>[^|]*[A-Za-z]{{2}}[^|]*?) ?\|(?:[^|]*\|)*? ?[YN] ?\| ?[YN] ?\|(?:[^|]*\|)*? ?(?<qty>{_N}) (?<unit>[A-Za-z]+) ?\|(?<tail>.*)$", ORDER, proof="ends"),
    Layout("dfj-horizontal", rf"^\d{{1,2}} (?<code>\d{{7}}(?=\(?\d{{12,14}}\)? )|\d{{5,9}})(?:\(?\d{{12,14}}\)?)? (?<name>.+?) (?:[YN] [YN] )?(?<qty>{_N}) (?<unit>CT|PAC|BGN|KRK|BOX) \d+ ?x ?\d+ {_N} ?EA \d+ (?<price>{_N}) (?<rates>(?:[\d.,]+% )+){_N} (?<total>{_N})$", ORDER),
    Layout("tiptop-barcode", rf"^\d{{1,2}} (?<code>\d{{7}}) (?<name>.+?) (?:Disc: ?(?<rates>[\d.]+%) )?(?:\d{{1,2}} )?(?<name2>\S{{2,8}}) (?<unit>[A-Z0-9]{{2,4}}) \d{{13}} (?<qty>\d+) (?<price>{_N}) (?<total>{_N})$", ORDER),
    Layout("boots-inline", rf"^0{{1,4}}[1-9]\d{{0,3}} (?<code>[A-Z]?\d{{7,12}}) (?<name>.+?) (?<qty>{_N}) (?<unit>EA|PAC|BTL|CTN) (?:{_N} ){{2,4}}(?<price>{_N}) (?<total>{_N})$", ORDER),
    Layout("aeon", rf"^\d{{1,2}}\n(?<name>[A-Z0-9 /&'().+-]{{6,}})\n\d{{2,3}}\.\d{{2}}\n(?<unit>(?i:CARTON|PCS|CTN))\n(?:\d{{1,5}}(?:\.\d+)?\n)?(?<code>\d{{8}})\n(?:\d{{12,14}}\n)?(?<qty>\d{{1,4}}\.\d{{2}})\n(?:(?:0\.00|-)\n)*(?<price>{_N})\n(?<total>{_N}){_REST}", ORDER, start=r"^\d{1,2}\n(?=.*[A-Z]{2})[A-Z0-9 /&'().+-]{6,}$", span=13),
    Layout("dfj-vertical", rf"^\d{{1,2}}\n(?<code>\d{{5,}})(?:\(\d{{12,14}}\))?\n(?<name>(?:(?![YN]\n)[^\n]+\n)*?)[YN]\n[YN]\n(?:(?!{_N} (?:CT|PAC|BGN|KRK|BOX)\n)[^\n]*\n)*?(?<qty>{_N}) (?<unit>CT|PAC|BGN|KRK|BOX|PCS|EA)\n(?<tail>(?s:.*))$", ORDER, start=r"^\d{1,2}\n\d{5,}(?:\(\d{12,14}\))?$", span=20, stop=r"(?i)^(?:PURCHASE|TOTAL|DPP|PPN|NON-RET|DISTRIBUTION|INTRO|SPEC|DIST|TRADE|FULL|HARGA|ISI|JUMLAH|NAMA|NO\.|\(SLP\)|\(TGL)|IDR", proof="ends"),
    Layout("boots-vertical", rf"^0\d{{3,5}}\n(?<code>(?=[^\n]*[A-Z])[A-Z0-9]{{10,16}})\n(?:\d{{12,14}}\n)?(?<name>{_NAME})\n(?:Country[^\n]*\n)?(?<qty>{_N})\n(?<unit>[A-Z]{{1,4}})\n(?<tail>{_N}(?:\n{_N})*){_REST}", ORDER, start=r"^0{1,4}[1-9]\d{0,2}0\n", span=16, proof="pick"),
    Layout("tiptop", rf"^\d{{1,2}} (?<code>\d{{7,}}) (?<name>.+?) (?<name2>(?:\d+ )?(?:CTN\d+|LTR\d+|PAC\d*|[A-Z]{{2,4}}\d*)) (?<qty>\d+) (?<price>{_N}) (?<total>{_N})$", ORDER, gates=(r"\d{4}\.PO\.\d{2}\.\d+",), fixed={"unit": "CTN"}),
    Layout("mitra", rf"^\d{{1,2}} (?<code>\d{{9,11}}) (?<name>.+?) (?<unit>[A-Z]+/\d+) \d{{13}} (?<qty>\d+) (?:[^\d\s] ?)?(?<price>{_N}) (?<total>{_N})$", ORDER),
    Layout("primafood", rf"^\d{{1,2}}\n(?<code>\d{{8}})\n(?:[A-Za-z]{{3}}\n)?(?<name>{_NAME})\n(?:[A-Za-z]{{2,4}}\n)?(?:\d{{9,}}\n)?(?<qty>{_N})\n(?<price>{_N})\n(?<discount>{_N})(?:\n{_N})*?\n(?<total>{_N})(?!\n{_N}){_REST}", ORDER, (r"(?i)Nomor P\.O",), start=r"^\d{1,2}\n\d{8}$", span=15),
    Layout("yogya", rf"^\d{{1,2}}\n(?<code>\d{{14}})\n(?:[^\n]*\n){{1,2}}?(?<name>(?!1:){_NAME})\n(?<qty>{_N})\n(?:(?:1:|0)\n)*(?<price>\d[\d,]*\.\d{{2}})\n(?:{_N}\n)*(?<total>\d[\d,]*\.\d{{2}})(?!\n{_N}){_REST}", ORDER, start=r"^\d{1,2}\n\d{14}$", span=20),
    Layout("kalimalang", rf"^\d{{1,2}} (?<code>\d{{11,14}}) (?<name>.+?) \d+ (?:DUS|PCS|BTL|KLG|BKS) {_N} (?<qty>\d+) (?<unit>DUS|PCS|BTL|KLG|BKS) (?<price>{_N}) (?<discount>{_N}) (?<total>{_N})$", ORDER),
    Layout("bpb-line", r"^\d{1,2} (?<code>\d{7,8}) (?<name>.+?) (?<qty>\d+)/(?:[A-Z]+|\d+) (?:\d+/\d+|\d+)(?: \d+)?$", (*ORDER, "BPB"), fixed={"unit": "CTN"}),
    Layout("bpb-block", rf"^\d{{1,2}}\n(?<code>\d{{7,8}})\n(?<name>{_NAME})\n(?<qty2>\d+)/\w+(?:\n(?<qty>\d+)/\d+)?{_REST}", (*ORDER, "BPB"), start=r"^\d{1,2}\n\d{7,8}$", span=7, fixed={"unit": "CTN"}),
    # orders told by a word on the page
    Layout("hypermart", rf"^(?<qty>\d{{1,5}}) (?<name>\S.*?) \d{{10,14}} (?<code>\d{{6,10}}) \d+ \d+ (?<price>{_N}) (?<tail>{_N}(?: {_N}){{0,2}})$", classes=ORDER, gates=(r"PO# ?:", r"(?i)E-PO|hyperma[rt]t"), proof="close"),
    Layout("lion", rf"^\d+\. (?<code>\d{{6,12}}) (?<name>.+?) (?<qty>\d+) - (?<price>{_N}) (?<discount>{_N}) (?<tax>{_N}) (?<total>{_N})$", ORDER, (r"(?i)(?:PO Number|NO PO) ?:?",)),
    Layout("astro", rf"^(?<code>(?=\S*\d)[A-Z0-9][A-Z0-9./-]{{5,20}}) (?<name>.+?) (?<qty>\d+) (?<price>{_N}) (?<total>{_N})$", classes=ORDER, gates=(r"(?i)PURCHASE ORDER DETAILS",)),
    Layout("midi", rf"^(?:#? ?\d{{1,3}}\.? ?\|? ?)?(?<code>\d{{6,8}}) ?\|? (?<name>[^|]+?) ?\|? (?<qty>{_N}) ?(?:PCS?)? ?\|? (?:\d+ ?\* ?\d+|\d+) ?\|? (?<price>{_N}) ?\|? \S.*? ?\|? \d ?\|? (?<total>{_N})$", classes=(*ORDER, "RECEIPT"), gates=(r"(?i)PENERIMAAN BARANG", r"(?i)No ?\.? ?PO ?:")),
    Layout("aeon-slip", rf"^\d{{1,3}}\n(?<name>[^\n]+(?:\n[^\n]+){{0,3}}?)\n(?:1\.00\n)?(?<unit>EACH|CTN|CS)\n(?:\d{{1,5}}(?:\.\d+)?\n)?(?<code2>\d{{8}})\n(?:(?<code>\d{{12,14}})\n)?(?<qty>{_N})\n(?:{_N}\n)??(?:-\n)?(?<price>{_N})\n(?<total>{_N}){_REST}", classes=ORDER, gates=("AEON", "PO No"), start=r"^\d{1,3}\n[^\n]*[A-Za-z]{3}", span=15, proof="prove"),
    Layout("grandlucky", rf"^\d{{1,3}} (?<code>\d{{9,12}}) (?<name>.+?) (?<name2>[A-Z]{{1,5}}/\d+) \d{{12,14}} (?<qty>\d+) (?<unit>[A-Za-z]{{2,5}}) (?<price>{_N}) (?<total>{_N})$", classes=ORDER, gates=(r"(?i)GRAND ?LUCKY|ORDER TO",)),
    Layout("harihari", rf"^\d{{1,3}}\n(?<code2>\d{{7,9}})\n(?:(?<code>\d{{12,14}})\n)?(?<name>[^\n]*[A-Za-z]{{4}}[^\n]*)\n(?<price>\d{{1,3}}[.,]\d{{3}})\n(?:[^\n]*\n)??(?<pack>\d{{1,4}}) ?(?i:PC|PCS|CTN|BOX)\n(?:[^\n]*\n)??(?<qty>\d{{1,5}}){_REST}", classes=ORDER, gates=(r"(?i)HARI HARI|PASAR SWALAYAN",), start=r"^\d{1,3}\n\d{7,9}$", span=9, proof="computed"),
    Layout("dutabuah", rf"^(?<code>\d{{12,14}}) (?<name>.+?) (?<qty>\d+) (?<unit>PCS|CTN|BOX) (?<price>{_N}) [\d%|Rp.]* ?\d+ (?<total>{_N})$", classes=ORDER, gates=(r"(?i)DUTA BUAH",)),
    Layout("gramedia", rf"^\d+ (?<code>\d{{6,12}}) \d{{8,14}} (?<name>.+?) (?<qty>\d+) (?<price>{_N}) {_N} {_N} (?<total>{_N})$", classes=ORDER, gates=(r"(?i)GRAMEDIA|ASRI MEDIA",)),
    Layout("kage", rf"^\d+ (?<name>.+?) (?<code>\d{{6,10}}) (?<qty>\d+) (?<price>{_N}) (?:{_N} ){{0,3}}(?<total>{_N})$", classes=ORDER, gates=(r"(?i)KAGE DWIJAYA",)),
    Layout("berkah", rf"^(?<code>ID\d{{4,8}}) \d{{6,14}} (?<name>.+?) \d+/[A-Z0-9]+ (?<unit>CTN) (?<price>{_N}) (?<rates>[\d.]+%) {_N} \S+ (?:- ?)?(?:\S+ )?{_N} (?<qty>\d+) (?<total>{_N}) {_N}$", classes=ORDER, gates=(r"(?i)PT BERKAH",)),
    # receipts
    Layout("marimari-line", rf"^\d+ (?<code>\d{{6,}}) \d{{12,14}} (?<name>.+?) {_N} [A-Z]+ (?<qty>\d+) ?(?<unit>KTN|CTN|PC) (?<price>{_N}) (?:[\d.]+% )?(?<total>{_N})$", ("SLIP_MARIMARI",)),
    Layout("marimari-block", rf"^\d{{1,2}}\n(?<code>\d{{6,}})\n(?:\d{{12,14}}\n)?(?<name>{_NAME})\n(?:(?!\d+ (?:KTN|CTN)(?:\n|$))[^\n]*\n)*?(?<qty>{_N}) ?(?<unit>KTN|CTN|PC)(?!\n\d+ (?:KTN|CTN)(?:\n|$)){_REST}", ("SLIP_MARIMARI",), start=r"^\d{1,2}\n\d{6,}$", span=10),
    Layout("slip", r"^\d{1,2} (?<code>\d{6,8}) (?:(?:HL|IS|NH|HF) )?(?<qty>\d+(?:\.\d+)?) (?<unit>EA|PAC|CTN|KTN) \d{4} \d{5}(?:\n[\d.,:]+)?(?:\n(?![^\n]*(?:Status|Page))(?<name>[^\n]+))?" + _REST, ("GR_SLIP",), start=r"^\d{1,2} \d{6,8} (?:[A-Z]{2} )?[\d.]+ (?:EA|PAC|CTN|KTN) \d{4} \d{5}\n", span=3),
    Layout("boots-receipt-line", rf"^0\d{{3}} (?<code>[A-Z0-9]{{8,16}}) (?:\d{{13}} )?(?<name>.+?) Country of Origin ?: ?(?:\S+ )?(?<qty>{_N}) (?<unit>[A-Z]+) (?:{_N} ){{1,5}}?(?<price>{_N}) (?<total>{_N})$", ("GR_BOOTS",)),
    Layout("boots-receipt-block", rf"^0\d{{3}}\n(?<code>(?=[^\n]*[A-Z])[A-Z0-9]{{8,16}})\n(?:\d{{13}}\n)?(?<name>(?!Country){_NAME})\n(?:Country[^\n]*\n)?(?<qty>{_N})\n(?<unit>EA|PAC|CTN)(?:\n(?<tail>{_N}(?:\n{_N})*))?{_REST}", ("GR_BOOTS",), start=r"^0\d{3}\n", span=14, proof="pick"),
    Layout("grn", rf"^\d{{1,2}} (?<code>\d{{5,}})(?:\(\d{{12,14}}\))?[ \n](?<name>(?s:.*?))[ \n][YN] [YN] (?:[^\n]*?(?<qty2>{_N}) ?(?<unit>EA)(?: (?<qty>{_N}))?|{_N} (?<qty3>{_N}))(?<tail>[^\n]*){_REST}", ("GRN_DFI",), start=r"^\d{1,2} \d{5,}(?:\(\d{12,14}\))?(?: |\n)", span=4, proof="ends"),
    Layout("tiptop-receipt", r"^\d{1,2} \d{4}\.PO\.\d{2}\.\d+ (?<code>\d{6,}) (?<name>.+?) (?<unit>[A-Z]{2,4}) (?<qty>\d+)$", ("RJ_TIPTOP",)),
    Layout("memo", r"^\d{1,2} \d{4}\.PL\.\d{2}\.\d+ \d{9,11} (?<code>\d{7}) (?<name>.+?) (?<qty>\d+) (?<unit>CRT/\d+|CTN/\d+|PAC)$", ("RJ_MEMO",)),
    Layout("received-note", rf"^\d{{1,2}}\n(?<code2>\d{{13}})\n(?:[A-Z]{{1,2}}\n)?(?:(?<code>\d{{8}})\n)?(?<name>{_NAME}(?:\n(?!{_N}(?: {_N})?(?:\n|$)){_NAME})?)\n(?<qty>{_N}) {_N}(?: |\n)(?<unit>Piece|PCS|CTN){_REST}", ("REC_NOTE",), start=r"^\d{1,2}\n\d{13}$", span=12),
    Layout("budi-receipt", r"^\d{1,2} \S+\.PL\.\d{2}\.\d+ \d{8,} (?<code>\d{6,}) (?<name>.+?) (?<qty>\d+) (?<unit>CRT/\d+|PAC|\d+)$", ("RJ_BUDI",)),
)


def _q(pattern: str) -> str:
    return f'r"{pattern}"'


def _rows_sql(r: Layout) -> str:
    """The rows of one rule over ``_lines``, an array of (n, s, two), as SQL: an array of structs of cells, null off its pages."""
    if r.span == 1:
        blocks = f"transform(filter(_lines, x -> x.s rlike {_q(r.row)}), x -> named_struct('n', x.n, 'b', x.s))"
    else:
        ends = f"y.two rlike {_q(r.start)} or y.s rlike {_q(r.stop)}"
        seg = f"slice(_lines, i + 2, {r.span - 1})"
        kept = f"slice(g, 1, cast(coalesce(nullif(array_position(transform(g, y -> {ends}), true), 0) - 1, size(g)) as int))"
        block = f"get(transform(array({seg}), g -> named_struct('n', get(_lines, i).n, 'b', array_join(concat(array(get(_lines, i).s), transform({kept}, y -> y.s)), chr(10)))), 0)"
        blocks = f"filter(transform(filter(sequence(0, size(_lines) - 1), i -> get(_lines, i).two rlike {_q(r.start)}), i -> {block}), x -> x.b rlike {_q(r.row)})"
    names = re.findall(r"\(\?<([a-z]\w*)>", r.row)
    cut = "\u0001".join(f"${i}" for i in range(1, len(names) + 1))  # no other group of a pattern captures
    cell = lambda c: f"nullif(trim(g[{names.index(c)}]), '')" if c in names else f"'{r.fixed[c]}'" if c in r.fixed else "cast(null as string)"
    made = f"named_struct('n', x.n, 'layout', '{r.name}', 'proof', '{r.proof}', {', '.join(f'{c!r}, {cell(c)}' for c in CELLS)})"
    rows = f"transform({blocks}, x -> get(transform(array(split(regexp_replace(x.b, {_q(r.row)}, '{cut}'), '\u0001')), g -> {made}), 0))"
    when = ["size(_lines) > 0", *([f"_class in ({', '.join(map(repr, r.classes))})"] if r.classes else []), *[f"_page rlike {_q(g)}" for g in r.gates]]
    return f"case when {' and '.join(when)} then {rows} end"


def _near(a: Column, b: Column, share: str) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(1).cast("decimal(18,4)"), F.abs(b) * F.lit(share).cast("decimal(4,2)"))


def _qty(c: Column) -> Column:
    """A quantity: ``3.000`` with a point alone is a decimal, everything else as ``parse_money`` has it."""
    return F.when(c.rlike(r"^\d+\.\d+$"), c.try_cast("decimal(18,4)")).otherwise(parse_money(c))


def _proved(r: Column) -> Column:
    return F.coalesce(_near((_qty(r["qty"]) * parse_money(r["price"])).cast("decimal(28,4)"), parse_money(r["total"]), "0.03"), F.lit(False))


def match_layouts(layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The rows of a page by the first rule that has any, over the columns _lines, _page and _class; null if none has."""
    tried = []
    for r in layouts:
        rows = F.expr(_rows_sql(r))
        if r.proof == "prove":
            rows = F.filter(rows, _proved)
        tried.append(F.get(F.filter(F.array(rows), lambda x: F.size(x) > 0), F.lit(0)))
    return F.coalesce(*tried)


def page_lines(text: Column) -> Column:
    """The lines of a page that hold anything, squeezed: (n, s), n from 1 over all lines."""
    numbered = F.transform(F.split(text, r"\r\n|\r|\n"), lambda s, i: F.struct((i + 1).alias("n"), F.trim(F.regexp_replace(s, r"\s+", " ")).alias("s")))
    return F.filter(numbered, lambda x: x["s"] != "")


def _prepared(pages: DataFrame, keys: list[str], text: str, kind: str | None) -> DataFrame:
    """keys, _page, _class and _lines of the pages that have a text."""
    own = F.col(kind) if kind else page_class(F.col(text))
    p = pages.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("_page"), own.alias("_class"), page_lines(F.col(text)).alias("_l"))
    two = F.expr("transform(_l, (x, i) -> named_struct('n', x.n, 's', x.s, 'two', concat(x.s, chr(10), coalesce(get(_l, i + 1).s, ''))))")
    return p.select(*keys, "_page", "_class", two.alias("_lines"))


def unread_lines(pages: DataFrame, keys: list[str], layouts: tuple[Layout, ...] = LAYOUTS, text: str = "text", kind: str | None = None) -> DataFrame:
    """keys, line_no, line of the pages that no layout reads."""
    # an outer explode, as a filter would be pushed below what it reads and evaluate that once for every rule
    p = _prepared(pages, keys, text, kind).select(*keys, "_lines", F.explode_outer(match_layouts(layouts)).alias("_r")).where("_r is null")
    return p.select(*keys, F.explode("_lines").alias("_x")).select(*keys, F.col("_x.n").alias("line_no"), F.col("_x.s").alias("line"))


def parse_layouts(pages: DataFrame, keys: list[str], layouts: tuple[Layout, ...] = LAYOUTS, text: str = "text", kind: str | None = None) -> DataFrame:
    """Rows of all pages: keys, line_no of the row's first line, layout, code, name, qty, unit, price, discount, rates, tax, total.

    kind: a column with the class of the page; without it the page's own text tells.
    """
    rows = _prepared(pages, keys, text, kind).select(*keys, F.explode(match_layouts(layouts)).alias("_r"))
    # letters of several lines are one name; lines of digits inside it are codes of other columns
    name = F.regexp_replace("_r.name", r"(?:^|\n)\d+(?=\n|$)", " ")
    name = F.concat_ws(" ", F.nullif(F.trim(F.regexp_replace(name, r"\s+", " ")), F.lit("")), F.col("_r.name2"))
    found = F.regexp_extract_all(F.regexp_replace("_r.tail", r"[\d.,]+%", " "), F.lit(r"((?<![\w.,])-?\d[\d.,]*(?![\w.,]))"), 1)
    cents = F.filter(found, lambda x: x.rlike(r"\d[.,]\d{2}$"))
    found = F.when(F.col("_r.proof") == "ends", F.when(F.size(cents) > 0, cents).otherwise(F.filter(found, lambda x: x.rlike(r"[.,]\d{3}$")))).otherwise(found)
    nums = F.filter(F.transform(F.filter(found, lambda x: ~x.rlike(r"^\d{9,}$")), lambda x: parse_money(F.rtrim(x, F.lit(".,")))), lambda x: x.isNotNull())
    typed = rows.select(
        *keys, "_r", nums.alias("_n"), F.coalesce("_r.code", "_r.code2").alias("_code"), F.nullif(name, F.lit("")).alias("_name"), F.col("_r.unit").alias("_unit"),
        _qty(F.coalesce("_r.qty", "_r.qty2", "_r.qty3")).alias("_q"), parse_money(F.col("_r.price")).alias("_p"), parse_money(F.col("_r.discount")).alias("_d"), parse_money(F.col("_r.total")).alias("_t"),
        parse_money(F.col("_r.tax")).alias("_tax"), parse_money(F.col("_r.pack")).alias("_pack"),
    )
    proof, n = F.col("_r.proof"), F.col("_n")
    q, p_, d, t = (F.col(f"_{c}") for c in "qpdt")
    last = lambda k: F.get(n, F.size(n) - k)
    times = lambda a, b: (a * b).cast("decimal(28,4)")
    close = F.get(F.filter(n, lambda v: (v != F.array_max(n)) & _near((times(q, p_) - v).cast("decimal(28,4)"), F.array_max(n), "0.03")), F.lit(0))
    swapped = (proof == "swap") & F.coalesce(~_near(times(q, p_), t, "0.02") & _near(times(q, d), t, "0.02"), F.lit(False))
    computed = times(q, F.col("_pack")).cast("decimal(18,4)")
    picked = F.when(F.coalesce(_near(times(q, last(3)), last(1), "0.02"), F.lit(False)), last(3)).otherwise(last(2))
    price = F.when(proof == "pick", picked).when(proof == "ends", F.when(F.size(n) > 1, F.get(n, F.lit(0)))).when(swapped, d).otherwise(p_)
    discount = F.when(proof == "close", F.coalesce(close, F.lit(0).cast("decimal(18,4)"))).when(swapped, p_).otherwise(d)
    total = F.when(proof.isin("pick", "ends"), last(1)).when(proof == "close", F.array_max(n)).when(proof == "computed", times(computed, p_).cast("decimal(18,4)")).otherwise(t)
    return typed.select(
        *keys, F.col("_r.n").alias("line_no"), F.col("_r.layout").alias("layout"), F.col("_code").alias("code"), F.col("_name").alias("name"), F.when(proof == "computed", computed).otherwise(q).alias("qty"),
        F.when(proof == "computed", "PCS").otherwise(F.col("_unit")).alias("unit"), price.alias("price"), discount.alias("discount"), F.trim("_r.rates").alias("rates"), F.col("_tax").alias("tax"), total.alias("total"),
    )


# ---- facts of a page ----------------------------------------------------------------------------------------

#: Where an order's number, its vendor code, a store name and the rate of tax stand on a page.
ORDER_NUMBER = (r"PO# ?: ?([0-9A-Z][0-9A-Z./-]{3,})", r"(?i)(?:No\.? PO|PO Number|Nomor P\.?O|Purchase Order No\.?) ?[: ] ?([0-9A-Z][0-9A-Z./_-]{4,})", r"(?i)P\.O No ?[: ] ?([0-9A-Z][0-9A-Z./-]{4,})", r"(?i)ORDER NO\s+([A-Z0-9]{6,})")
VENDOR_CODE = r"(?i)(?:VENDOR(?: Code)?|No\.? ?Supplier|Kode ?Supplier|Supplier(?: No)?(?: ?/ ?Contract No)?) ?:?\s*\(?(V?-?\d{5,14}|[A-Z]{2,5}\d(?:\.[A-Z0-9.]+){2,6})\)?"
STORE_NAME = r"(?im)^(?:Dikirim Dari|Store|Outlet|PO Issued By) ?: ?([^\n]{5,40})"
LEGAL_NAME = r"(?m)\b((?:PT|CV)\.? ?[A-Z][A-Za-z .,&'()\-]{4,48}?)(?=\s*(?:$|[:(\n])|\s{2,})"
NOT_A_NAME = r"(?i)^(?:PT|CV)\.? ?(?:ADDRESS|TOTAL|NAMA|NAME|NO|JALAN|JL|ORDER|DAN|YANG|TOKO|ALAMAT|VENDOR|KODE|SUPPLIER|SEND|SHIP|DELIVERY)\b"
PRINTED_RATE = r"(?i)(?:PPN|PPnBM|VAT) ?(?:%|RATE|TARIF)? ?:? ?(\d+(?:[.,]\d+)?) ?%"


def _first(text: str, *patterns: str) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])


def order_header(pages: DataFrame, keys: list[str], own: str, brands: list[tuple[str, str]] = (), text: str = "text") -> DataFrame:
    """Facts of an order's page: keys, order_no, vendor_code, issuer, issuer_tag, rate; null where the page doesn't say.

    own: the pattern of the names of the own firm, which is never the issuer. The issuer is the first legal name of
    another firm (ISSUER-PT-PAGE), else the legal name of the one of ``brands`` (brand, legal name) that the page names
    (ISSUER-BRAND), else a store name (ISSUER-STORENAME), else null (ISSUER-MISSING). brands: at most 2,000, a list that
    is part of the plan; longer ones are to be joined by word.
    """
    if len(brands) > 2000:
        raise ValueError("too many brands for one expression a page; join them by word")
    named = F.filter(F.regexp_extract_all(text, F.lit(LEGAL_NAME), 1), lambda x: ~x.rlike(f"(?i){own}") & ~x.rlike(NOT_A_NAME))
    legal = F.get(F.transform(named, lambda x: F.upper(F.regexp_replace(F.trim(x), r"[.,]+$", ""))), F.lit(0))
    alias = F.lit(None).cast("string")
    for brand, pt in reversed(list(brands)):
        alias = F.when(F.contains(F.upper(text), F.lit(brand.upper())), pt).otherwise(alias)
    store = _first(text, STORE_NAME)
    store = F.when(~store.rlike(f"(?i){own}") & store.rlike("[A-Za-z]{4}"), F.trim(store))
    h = pages.select(*keys, _first(text, *ORDER_NUMBER).alias("order_no"), _first(text, VENDOR_CODE).alias("vendor_code"), legal.alias("_a"), alias.alias("_b"), store.alias("_c"), F.regexp_replace(_first(text, PRINTED_RATE), ",", ".").try_cast("double").alias("_r"))
    tag = F.when(F.col("_a").isNotNull(), "ISSUER-PT-PAGE").when(F.col("_b").isNotNull(), "ISSUER-BRAND").when(F.col("_c").isNotNull(), "ISSUER-STORENAME").otherwise("ISSUER-MISSING")
    return h.select(*keys, "order_no", "vendor_code", F.coalesce("_a", "_b", "_c").alias("issuer"), tag.alias("issuer_tag"), F.when(F.col("_r") < 4, "1.1%").when(F.col("_r").isNotNull(), "11%").alias("rate"))


#: A receipt's number and date, then the delivery note's.
DELIVERY_NOTE = r"(\d{4}\.RC\.[\d.]+)\s+(\d{2}/\d{2}/\d{4})\s+(\d+)\s+(\d{2}/\d{2}/\d{4})"


def delivery_notes(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, delivery_no, delivery_date, receipt_no, receipt_date of the pages that print them in one line; no row without."""
    part = lambda i: F.regexp_extract(text, DELIVERY_NOTE, i)
    return pages.where(F.col(text).rlike(DELIVERY_NOTE)).select(*keys, part(3).alias("delivery_no"), part(4).alias("delivery_date"), part(1).alias("receipt_no"), part(2).alias("receipt_date"))


def first_company(pages: DataFrame, keys: list[str], own: str, most: int = 14, text: str = "text") -> DataFrame:
    """keys, company: the first legal name of another firm in the first ``most`` lines that hold anything; null without one."""
    heads = F.transform(F.slice(page_lines(F.col(text)), 1, most), lambda x: F.regexp_extract(x["s"], LEGAL_NAME, 1))
    fits = F.filter(heads, lambda x: (x != "") & ~x.rlike(f"(?i){own}") & ~x.rlike(NOT_A_NAME))
    return pages.select(*keys, F.upper(F.get(fits, F.lit(0))).alias("company"))
