import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerforge.llm import canonical, queries, spellings
from ledgerforge.llm.graph import components
from ledgerforge.llm.names import core_distance, edit, edits, encode, lines_agree, nickname, read_name

LINES = ("BOGA", "DISTRIBUSI", "LOGISTIK", "MAKMUR", "NIAGA", "PANGAN", "PERKASA", "RETAILINDO", "SEJAHTERA", "SENTOSA", "SWALAYAN", "UTAMA")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ABC", min_size=1, max_size=12), min_size=2, max_size=12))
def test_vector_edits_equal_the_table(words):
    letters, n = encode(words)
    a, b = (x.ravel() for x in np.meshgrid(range(len(words)), range(len(words))))
    got = edits(letters, n, a, b)
    assert all(got[i] == edit(words[a[i]], words[b[i]], 99) for i in range(len(a)))


def fits(a, b):
    x, y = read_name(a, LINES), read_name(b, LINES)
    return x is not None and y is not None and lines_agree(x, y) and core_distance(x, y) < 3


@pytest.mark.parametrize("b", ["PT. DAPO DETUTUN SEJAHTERA", "Dapo Detutun Sejahtera, PT", "DAPO OFTUTUN SEJAHTERA", "PT Daio Detuutn Sejahtera", "PT Dap. Detutun SEJAHTERA", "PT D. Detutun Sejahtera", "Detutun Dapo Sejahtera PT", "PT DAPODETUTUN SEJAHTERA", "PT Dapo Detutun S", "PT Dapo Detutun Sjht", "PT Dapo Detutun", "pt dapo detutun sejahtera", "PT Dapo Detutun Sejahtera - DC Widasari", "PT. DAPO DETUTUN SEJAHTERA (TOKO 060)", "PT DAPO DETUTUN SEJAHTERA SUDAH", "PT Dao Detuutn Sejahtera"])
def test_spellings_of_one_firm(b):
    assert fits("PT Dapo Detutun Sejahtera", b)


@pytest.mark.parametrize("b", ["PT Dapo Detutun Sentosa", "PT Dapo Detutun Niaga", "PT Dopa Tunedut Sejahtera", "PT M. Detutun Sejahtera", "Dapowan Detutun", "PT.", "Kepada Yth.", ""])
def test_other_firms(b):
    assert not fits("PT Dapo Detutun Sejahtera", b)


def test_persons():
    assert fits("Bpk. Turiwan Bapuluk", "H. T BAPULUK") and fits("Janape, Pipato", "Pipato Janape") and fits("Bulani Ginoke", "Bulaniginoke")
    assert not fits("Turiwan Bapuluk", "Turi Bapuluk Niaga")
    n = lambda s: read_name(s, LINES)
    assert nickname(n("Sobowan Panatun"), n("Bowan Panatun")) and not nickname(n("Sobowan Panatun"), n("Dubiwan Panatun"))


@pytest.mark.parametrize("v", ["", " ", "PT.", "11%", "Kepada Yth.", "RANGKAP 2", "00010", "?", "lihat lampiran", "x" * 100_000, "​"])
def test_no_names(v):
    n = read_name(v, LINES)
    assert n is None or not n.firm


def test_components_against_union_find(spark):
    r = random.Random(5)
    edges = [(f"n{r.randrange(300)}", f"n{r.randrange(300)}") for _ in range(260)] + [("hub", f"h{i}") for i in range(400)] + [(f"c{i}", f"c{i + 1}") for i in range(40)] + [("n1", "n1")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    want = {}
    for x in list(parent):
        want.setdefault(find(x), set()).add(x)
    got = {}
    for node, root in components(spark.createDataFrame(edges, "a string, b string")).collect():
        got.setdefault(root, set()).add(node)
    assert all(root == min(members) for root, members in got.items())
    linked = {frozenset(m) for m in want.values() if len(m) > 1}
    assert {frozenset(m) for m in got.values()} == linked
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_radius_join_is_exact(spark):
    """Against all pairs, for few and many pivots, with words longer than a machine word and blocks that no sample knows."""
    r = random.Random(3)
    words = sorted({"".join(r.choice("ABE") for _ in range(r.randint(3, 7))) for _ in range(250)} | {"B" + "A" * 70, "A" * 70, "A" * 71, "K" * 90, "K" * 45 + "L" + "K" * 45})
    points = sorted({(r.choice("XY"), w) for w in words} | {("Z", "A")})
    want = {(c, a, b) for c, a in points for d, b in points if c == d and a <= b and edit(a, b, 1) <= 1}
    df = spark.createDataFrame(points, "block string, word string")
    for pivots in (1, 7, 64, None):
        got = [tuple(x) for x in spellings.radius_pairs(df, 1, pivots).collect()]
        assert set(got) == want and len(got) == len(want)
    assert spellings.radius_pairs(df.where("false")).count() == 0
    swaps = {tuple(x) for x in spellings.swap_pairs(df).collect()}
    assert swaps == {(c, a, b) for c, a in points for d, b in points if c == d and a < b and any(a[:i] + a[i + 1] + a[i] + a[i + 2 :] == b for i in range(len(a) - 1))}


def test_the_pivots_carry_the_links(spark, sf, monkeypatch):
    """Without the radius join most pairs are lost; the rest read to one name or differ by a swap."""
    from ledgerforge.llm.queries import QUERIES

    whole = QUERIES["p5_found"](spark, sf).count()
    none = spark.createDataFrame([], "block string, a string, b string")
    monkeypatch.setattr(spellings, "radius_pairs", lambda *a, **k: none)
    assert QUERIES["p5_found"](spark, sf).count() < 0.3 * whole


def test_short_names_are_names(spark):
    values = ["PT KAO", "P.T. KAO", "kao", "PT ABC JAYA", "ABC JAYA", "PT", "-", "X", None, "LI AN", "LI  AN"]
    got = spellings.spelling_classes(spark.createDataFrame([(v,) for v in values], "v string"), LINES, frozenset()).collect()
    classes = {}
    for v, c in got:
        classes.setdefault(c, set()).add(v)
    assert sorted(map(sorted, classes.values())) == [["ABC JAYA", "PT ABC JAYA"], ["LI  AN", "LI AN"], ["P.T. KAO", "PT KAO", "kao"]]


def test_classes_by_brute_force(spark):
    """Classes of names made from known entities are those entities."""
    r = random.Random(11)
    syl = ["BA", "KO", "TU", "ME", "RI", "LA", "SO", "NU", "GE", "PI"]
    word = lambda n: "".join(r.choice(syl) for _ in range(n)) + r.choice("KNRS")
    firms = [(word(2), word(3), r.choice(LINES)) for _ in range(25)]
    truth = {}
    for i, (a, b, x) in enumerate(firms):
        j = r.randrange(1, len(b) - 2)
        for v in (f"PT {a} {b} {x}", f"PT. {a.title()} {b.title()} {x.title()}", f"{b} {a} {x} PT", f"PT {a}{b} {x}", f"PT {a} {b[:j]}{b[j + 1]}{b[j]}{b[j + 2 :]} {x}", f"PT {a[0]}. {b} {x}", f"PT {a} {b} {x} Cab. Kelung"):
            truth[v] = i
    values = spark.createDataFrame([(v,) for v in [*truth, None, "", "PT.", "ZAXZEZ STORE 003", "PT"]] + [(next(iter(truth)),)] * 50, "v string")
    got = {x.value: x["class"] for x in spellings.spelling_classes(values, LINES, frozenset({"ZAXZEZ"})).collect()}
    assert set(got) == set(truth)
    by = {}
    for v, c in got.items():
        by.setdefault(c, set()).add(truth[v])
    assert all(len(s) == 1 for s in by.values()) and len(by) == len(firms)


def test_lines_split_one_core(spark):
    rows = [("PT Kede Dupabu Boga",), ("KEDE DUPABU BOGA",), ("PT Kede Dupabu Sentosa",), ("PT Kede Dupabu",), ("PT Kede Dupabu B",)]
    got = {x.value: x["class"] for x in spellings.spelling_classes(spark.createDataFrame(rows, "v string"), LINES, frozenset()).collect()}
    assert got["PT Kede Dupabu Boga"] == got["KEDE DUPABU BOGA"] == got["PT Kede Dupabu B"] != got["PT Kede Dupabu Sentosa"]
    assert got["PT Kede Dupabu"] not in (got["PT Kede Dupabu Boga"], got["PT Kede Dupabu Sentosa"])  # it may be either


def test_names_of_short_words(spark):
    rows = [("EKO ADI",), ("Bpk. Eko Adi",), ("Adi, Eko",), ("EKA ADI",), ("PT ABC Boga",), ("ABC BOGA",), ("PT ABD Boga",), ("PT ABC Sentosa",), ("E. Adi",)]
    got = {x.value: x["class"] for x in spellings.spelling_classes(spark.createDataFrame(rows, "v string"), LINES, frozenset()).collect()}
    assert got["EKO ADI"] == got["Bpk. Eko Adi"] == got["Adi, Eko"] != got["EKA ADI"]
    assert got["PT ABC Boga"] == got["ABC BOGA"] and len({got[v] for v in ("PT ABC Boga", "PT ABD Boga", "PT ABC Sentosa")}) == 3


def test_pairs_and_empty(spark):
    none = spellings.spelling_classes(spark.createDataFrame([], "v string"), LINES, frozenset())
    assert none.count() == 0 and spellings.spelling_pairs(none).count() == 0


ISSUERS = [("I1", "ZAXZEZ", "PT Regi Bibagon Pangan"), ("I2", "ZAZZOX", "PT Nojer Bowake Utama Tbk"), ("I3", None, "PT Kede Dupabu Boga"), ("I4", "ZOO", None), ("I5", "Q", "PT Losu Lorumon Utama"), ("I6", "R", "PT Tasa Gitadan Pangan"), ("I7", "S", "PT Dapo Detutun Boga")]


@pytest.mark.parametrize(
    ("typed", "want"),
    [("PT. REGI BIBAGON PANGAN", "I1"), ("zaxzez", "I1"), ("Zaxzez Kelung", "I1"), ("ZAZZOX STORE 011", "I2"), ("PT N. Bowake Utama", "I2"), ("NOJER B0WAKE UTAMA ", "I2"), ("PT REGIBIBAGON PANGAN", "I1"), ("PT Kede Dupabu Sentosa", ""), ("PT Kede Dupabu", "I3"), ("Kepada Yth.", ""), ("", ""), ("-", ""), ("PT Nojre Bowaek Utama", "I2"), ("y" * 50_000, "")],
)
def test_issuers(typed, want):
    assert canonical.issuer_matcher(ISSUERS, LINES)(typed) == want


UNITS = [("PCS", "Buah, biji", "piece, each"), ("CTN", "Karton, dus", "carton, case"), ("LSN", "Lusin", "dozen"), ("LTR", "Liter", "litre"), ("ML", "Mililiter, cc", "millilitre"), ("BOX", "Kotak", "box"), ("SET", "Set", "set"), ("KODI", "Kodi", "score"), ("ONS", "Ons (100 gram)", "hectogram"), ("GR", "Gram", "gram")]


@pytest.mark.parametrize(("typed", "want"), [("KAR/72/", "CTN"), ("CTN24", "CTN"), ("karton @12", "CTN"), ("DUS ISI 6", "CTN"), ("C T N", "CTN"), ("PC5", "PCS"), ("PSC", "PCS"), ("L5N", "LSN"), ("bxo", "BOX"), ("CIN", "CTN"), ("5ET", "SET"), ("KD I", "KODI"), ("ons", "ONS"), ("Litter", "LTR"), ("12,00", ""), ("?", ""), ("KET", ""), ("JML", ""), ("LOT", ""), ("", "")])
def test_units(typed, want):
    assert canonical.unit_matcher(UNITS)(typed) == want


def test_mentions_longest_first():
    m = canonical.Mentions({"AB": {"x"}, "AB CD": {"y"}, "CD": {"z"}})
    assert m.find("AB CD AB") == [(0, 5, ("y",)), (6, 8, ("x",))]
    assert m.find("ABCD") == [] and canonical.Mentions({}).find("AB") == []


def test_map_values(spark):
    df = spark.createDataFrame([("PCS",), ("PCS",), (" ",), (None,), ("pcs",), ("zzz",)], "raw_value string")
    got = sorted(tuple(r) for r in canonical.map_values(df, "uon", canonical.Matcher("unit", UNITS)).collect())
    assert got == [("uon", "PCS", "PCS"), ("uon", "pcs", "PCS"), ("uon", "zzz", "")]
    with pytest.raises(ValueError):
        canonical.bounded_rows(spark.range(10), 5)


def test_p2_and_p5_whole_tables(spark, sf):
    po = pd.read_parquet(f"{sf}/po_customer.parquet")
    got = queries.p2_found(spark, sf).toPandas()
    for f in ("po_issuer", "uon"):
        want = {v for v in po[f].dropna() if v.strip()}
        assert set(got[got.field == f].raw_value) == want
    assert (got.canonical_key != "").mean() > 0.5
    pairs = queries.p5_found(spark, sf).toPandas()
    assert (pairs.name_a < pairs.name_b).all() and not pairs.duplicated().any()
    c = queries.p5_classes(spark, sf)
    assert c.where(F.col("n_links") > 0).count() > 0
