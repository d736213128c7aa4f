"""Plans of the training-data operators that must hold at any size."""

import re

import pytest

from ledgerforge.llm import queries


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cross_join(spark, sf, name):
    p = plan(queries.QUERIES[name](spark, sf))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["p6_found", "p7_mix", "p8_found", "p8_scores"])
def test_texts_are_not_shuffled(spark, sf, name):
    assert not re.search(r"(?<!Broadcast)Exchange ", plan(queries.QUERIES[name](spark, sf)))


@pytest.mark.parametrize(("name", "text"), [("p6_found", True), ("p7_mix", False), ("p1_found", False)])
def test_columns_at_the_scan(spark, sf, name, text):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    p = plan(queries.QUERIES[name](spark, sf))
    assert any("text:" in s for s in re.findall(r"ReadSchema: struct<[^>]*", p)) == text
