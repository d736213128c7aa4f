import datetime as dt
from decimal import Decimal as D

import pandas as pd
from pyspark.sql import functions as F

from ledgerforge.llm import queries, survivor

S = "id bigint, purchase_order_no string, vendor_code string, po_issuer string, ppn string, product_code string, product_name string, qty decimal(16,4), uon string, unit_price decimal(16,4), discount decimal(16,2), total decimal(16,2), document_id string, folder string, confidence string, updated_at timestamp_ntz, group_key string, first int"


def row(i, po="4500000001", doc="d1", code="1000001", name="SISIR BLACK 04", qty=3, price=10, total=30, conf="high", vendor="305275927", folder="/data/inbox/305275927 - PT A", at=1, disc=0):
    d = lambda x: None if x is None else D(x)
    return (i, po, vendor, "PT A", "11%", code, name, d(qty), "CTN", d(price), d(disc), d(total), doc, folder, conf, dt.datetime(2025, 1, at), "clash", 0)


def groups(spark, rows):
    got = survivor.line_groups(spark.createDataFrame(rows, S), {}).collect()
    out = {}
    for r in got:
        out.setdefault(r.group_key, set()).add(r.id)
    assert len(got) == len(rows)
    return {frozenset(v) for v in out.values()}


def test_groups(spark):
    rows = [
        row(1), row(2, po="No. PO : 4500000001", doc="d2"), row(3, po="45OOOOOOO1", doc="d3"), row(4, po=None),  # one line, read four times
        row(5, qty=4, total=40), row(6, qty=4, total=40, doc="d2", po="PO 4500000001", code=None),  # the other line of the product
        row(7, folder="/data/inbox/399999999 - PT B", doc="d9", vendor=None),  # another issuer's order of the same number
        row(8, code=None, name="SISSIR BLACK 04", doc="d2", po="4500000001.0"),  # code lost, name misread
        row(9, qty=None, total=40),  # qty lost; the total says which line
        row(10, po=None, doc=None, folder=None, vendor=None), row(11, po=None, doc=None, folder=None, vendor=None),  # nothing to go by
    ]
    assert groups(spark, rows) == {frozenset({1, 2, 3, 4, 8}), frozenset({5, 6, 9}), frozenset({7}), frozenset({10}), frozenset({11})}


def test_empty_and_nulls(spark):
    assert survivor.line_groups(spark.createDataFrame([], S), {"x": F.lit(1)}).count() == 0
    n = (1, *[None] * 5, "P", *[None] * 11)
    assert len(groups(spark, [n, (2, *n[1:])])) == 2


def test_first_by_the_given_order(spark):
    rows = [row(1, conf="low"), row(2, conf="Tinggi", at=1, vendor="N/A"), row(3, conf="HIGH", at=2, vendor=None), row(4, conf="high", at=2, vendor="VENDOR : 305275927"), row(5, conf="high", at=2)]
    g = survivor.grouped(spark.createDataFrame(rows, S), {"first": survivor.reading_order(), "code": F.when(survivor.vendor_code(F.col("vendor_code")).isNotNull(), F.lit("code"))})
    won = survivor.survive(g, "group_key", {"best": F.lit("x"), "vendor_code": F.col("code")}, precedence=F.col("first"), keep=("best", "vendor_code")).collect()
    assert [(r.best_id, r.vendor_code_id) for r in won] == [(4, 4)]


def test_votes_sum_trust_and_recency(spark):
    rows = [(1, "g", "a", 1.0), (2, "g", "b", 0.6), (3, "g", "b", 0.6), (4, "g", None, 9.0), (5, "h", "z", 0.0), (6, "h", "y", 0.0)]
    df = spark.createDataFrame(rows, "id bigint, k string, v string, w double")
    got = {r.k: (r.v, r.v_id) for r in survivor.survive(df, "k", {"v": F.col("v")}, weight=F.col("w")).collect()}
    assert got == {"g": ("b", 2), "h": ("z", 5)}


def test_codes_and_numbers(spark):
    df = spark.createDataFrame([(v,) for v in ["305275927", "VENDOR : 305275927", "3052 75927", "305275927.0", "000000000", "-", "N/A", "PT MUTO", "", None]], "v string")
    assert [r[0] for r in df.select(survivor.vendor_code(F.col("v"))).collect()] == ["305275927"] * 4 + [None] * 6
    df = spark.createDataFrame([(v,) for v in ["PO/26/07/55926260", "No. PO : PO/26/07/55926260", "po 26 07 5592626O", "#PO26-07-55926260.0", " ", None]], "v string")
    assert [r[0] for r in df.select(survivor.order_number(F.col("v"))).collect()] == ["260755926260"] * 4 + [None] * 2


def brute(po: pd.DataFrame) -> set:
    """Groups of rows with code and qty, by documents' majority number and folder code."""
    import re

    tr = str.maketrans("OILSBZGQ", "01158269")

    def number(s):
        if s is None:
            return None
        s = re.sub(r"\.0$", "", s.upper().strip()).split(":")[-1]
        return re.sub(r"^PO(?=.{6})", "", re.sub(r"[^A-Z0-9]", "", s)).translate(tr) or None

    po = po.copy()
    po["n"] = po.purchase_order_no.map(number)
    po["n"] = po.groupby("document_id").n.transform(lambda x: x.mode().iloc[0] if x.notna().any() else None)
    po["f"] = po.folder.str.extract(r"/(\d{6,}) - ")[0]
    po["f"] = po.groupby("document_id").f.transform("first")
    x = po.dropna(subset=["product_code", "qty", "f", "n"])
    return {frozenset(g) for g in x.groupby(["f", "n", "product_code", "qty"]).id.agg(set) if len(g) > 1}


def test_whole_table_against_brute_force(spark, sf):
    po = pd.read_parquet(f"{sf}/po_customer.parquet")
    rows = survivor.line_groups(spark.read.parquet(f"{sf}/po_customer.parquet"), {}).toPandas()
    by = rows.groupby("group_key").id.agg(set)
    where = {i: frozenset(g) for g in by for i in g}
    for g in brute(po):
        assert g <= where[next(iter(g))]
    found = queries.p1_found(spark, sf).toPandas()
    big = {min(g): g for g in by if len(g) > 1}
    assert set(found.group_first_id) == set(big)
    assert all(b in big[f] and (v == -1 or v in big[f]) for f, b, v in found.itertuples(index=False))
    assert len(queries.p1_survivors(spark, sf).collect()) == len(big)


def test_against_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view po_customer as select * from read_parquet('{sf}/po_customer.parquet')")
    want = sorted(con.sql(queries.SQL["p1_found"]).fetchall())
    got = sorted(tuple(r) for r in queries.p1_found(spark, sf).select("group_first_id", "best_id", "vendor_code_id").collect())
    order = ["group_first_id", "best_id", "vendor_code_id"]
    assert con.sql(queries.SQL["p1_found"]).columns == order
    assert got == want
