"""Plans that must hold at any size: no cross joins, filters and columns at the scan, no needless shuffles."""

import re

import pytest

from ledgerforge.plans import catalogue, generic

ALL = {**catalogue.QUERIES, **generic.QUERIES}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# the printed layouts have one plan
@pytest.mark.parametrize("name", sorted(n for n in ALL if not n.startswith("layout_") or n in ("layout_rows", "layout_chain", "layout_yogya")))
def test_no_cross_join(spark, sf, name):
    p = plan(ALL[name](spark, sf))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def columns(p: str) -> set[str]:
    return {c for s in re.findall(r"ReadSchema: struct<([^>]*)", p) for c in re.findall(r"(\w+):", s)}


def test_columns_reach_the_scan(spark, sf):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)  # else long schemas are cut in the plan's text
    assert columns(plan(ALL["po_gate"](spark, sf))) == {"id", "qty", "unit_price", "discount", "total", "ppn"}
    assert columns(plan(ALL["status_counts"](spark, sf))) == {"status"}
    assert columns(plan(ALL["page_classify"](spark, sf))) == {"doc_id", "text"}
    assert columns(plan(ALL["p3_found"](spark, sf))) == {"id", "kode_material", "kemasan", "nama_produk", "qty", "harga", "jumlah", *(f"disc_{i}" for i in range(1, 6))}


def test_filters_reach_the_scan(spark, sf):
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan(ALL["retry_backoff"](spark, sf))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(qty", plan(ALL["p3_found"](spark, sf)))


def exchanges(p: str) -> int:
    # of an adaptive plan only what will run first
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", p))


@pytest.mark.parametrize(("name", "most"), [("po_gate", 0), ("page_classify", 0), ("layout_signature", 2), ("p4_found", 0), ("p3_found", 1), ("status_counts", 1), ("tab_rollup", 1), ("key_conflict", 2), ("cell_diff", 2), ("dedupe_sha256", 3), ("layout_chain", 0)])
def test_shuffles(spark, sf, name, most):
    assert exchanges(plan(ALL[name](spark, sf))) <= most


@pytest.mark.parametrize("name", ["po_gate", "money_parse", "page_classify", "tax_rate", "norm_line"])
def test_expressions_stay_in_generated_code(spark, sf, name):
    p = plan(ALL[name](spark, sf))
    assert "*(1)" in p or "WholeStageCodegen" in p
    assert "Python" not in p and "Pandas" not in p
