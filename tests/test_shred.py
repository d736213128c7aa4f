import json

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerforge.operators.shred import LONE_KEYS, _deep, decode, shred_batch, shred_column, shred_json


def plain(value, lone):
    """Every object in an array, by walking the value: (path, parent)."""
    out = []

    def walk(v, path, parent):
        if isinstance(v, dict):
            for k, x in v.items():
                walk([x] if k in lone and isinstance(x, dict) else x, (path + "." if path else "") + k, parent)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                p = f"{path}[{i}]"
                if isinstance(x, dict):
                    out.append((p, parent))
                walk(x, p, p)

    walk(value, "", "")
    return out


leaf = st.none() | st.booleans() | st.integers(-5, 5) | st.text(max_size=3)
key = st.sampled_from(["a", "b", "lots", "moves", "pages"])
tree = st.recursive(leaf, lambda x: st.lists(x, max_size=3) | st.dictionaries(key, x, max_size=3), max_leaves=20)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.dictionaries(key, tree, max_size=3) | st.lists(tree, max_size=3), min_size=1, max_size=4))
def test_positions_come_back_from_levels(values):
    lone = frozenset(LONE_KEYS)
    want = sorted((i, *p) for i, v in enumerate(values) for p in plain(v, lone))
    got = shred_batch([(i, json.loads(json.dumps(v))) for i, v in enumerate(values)], lone)
    assert sorted(zip(got.record_id, got.path, got.parent_path)) == want


def test_fields_stand_with_their_object():
    v = {"line_items": [{"no": 1, "taxes": {"kind": "PPN"}}, None, {"no": 3, "x": {"y": True}}]}
    got = shred_batch([(9, v)], frozenset(LONE_KEYS)).set_index("path")
    assert got.fields["line_items[0]"] == {"no": "1"}
    assert got.fields["line_items[0].taxes[0]"] == {"kind": "PPN"}
    assert got.fields["line_items[2]"] == {"no": "3", "x.y": "true"}
    assert got.parent_path["line_items[0].taxes[0]"] == "line_items[0]"
    assert list(got.table_path[["line_items[0]", "line_items[0].taxes[0]"]]) == ["line_items", "line_items.taxes"]


def test_root_and_lists_of_values():
    """What stands above all lists is the record's own row, and a list of values comes back as it was."""
    v = {"no": 7, "head": {"name": "A"}, "tags": ["x\x1fy", "z"], "items": [{"codes": [1, None, 3], "n": {"deep": ["q"]}}], "empty": []}
    got = shred_batch([(9, v)], frozenset(), True, True).set_index("path")
    assert got.fields[""] == {"no": "7", "head.name": "A", "tags": json.dumps(["x\x1fy", "z"])}
    assert got.table_path[""] == "" and got.parent_path[""] == ""
    assert got.fields["items[0]"] == {"codes": "[1, 3]", "n.deep": '["q"]'}
    both = shred_batch([(1, {"tags": ["x\x1fy", "z"]}), (2, {"tags": ["x", "y", "z"]}), (3, [1])], frozenset(), True, True).set_index("record_id").fields
    assert json.loads(both[1]["tags"]) == ["x\x1fy", "z"] and json.loads(both[2]["tags"]) == ["x", "y", "z"] and 3 not in both.index


def test_a_record_may_be_deep(spark):
    deep = '{"a":' * 3000 + '{"pages":[{"t":1}]}' + "}" * 3000
    lists = "[" * 3000 + '{"t":"x"}' + "]" * 3000
    got = {(r.record_id, len(r.path), r.fields["t"]) for r in shred_json(spark.createDataFrame([(1, deep), (2, lists)], "id bigint, j string"), "id", "j").collect()}
    assert got == {(1, 3000 * 2 + len("pages[0]"), "1"), (2, 9000, "x")}


@settings(max_examples=300, deadline=None)
@given(tree)
def test_deep_reading_is_reading(value):
    text = json.dumps(value)
    assert _deep(text) == value
    for broken in (text + ",", "[" + text, text + "]", '{"a"' + text + "}", "[" + text + ",]", "[," + text + "]", '{"a":}', "[1 2]", ""):
        with pytest.raises(ValueError):
            _deep(broken)


def test_damaged_blank_and_twice_encoded():
    assert decode(None) is None and decode("") is None and decode('{"a":[{') is None
    assert decode(json.dumps(json.dumps({"a": 1}))) == {"a": 1}
    deep = "[" * 100_000
    assert decode(deep) is None


def test_json_and_typed_column(spark):
    rows = [(1, '{"pages":[{"a":1},null,{}]}', "x"), (2, None, "x"), (3, "{bad", "x"), (4, json.dumps('{"lots":{"q":1}}'), None), (None, '{"pages":[{}]}', None)]
    df = spark.createDataFrame(rows, "id bigint, j string, record_id string")
    got = {(r.record_id, r.path) for r in shred_json(df, "id", "j").collect()}
    assert got == {(1, "pages[0]"), (1, "pages[2]"), (4, "lots[0]")}
    t = spark.createDataFrame([(1, [(5, [("k",)]), None, (None, None)]), (2, None), (3, [])], "id bigint, line_items array<struct<n:int,taxes:array<struct<kind:string>>>>")
    got = {(r.record_id, r.path, r.parent_path) for r in shred_column(t, "id", "line_items").collect()}
    assert got == {(1, "line_items[0]", ""), (1, "line_items[0].taxes[0]", "line_items[0]"), (1, "line_items[2]", "")}
    assert shred_json(df.where("false"), "id", "j").count() == 0


def test_whole_tables(spark, sf):
    from ledgerforge.plans.generic import p4_found

    docs = pd.read_parquet(f"{sf}/documents.parquet")
    want = {("documents", int(i), *p) for i, v in zip(docs.doc_id, map(decode, docs.standard_json)) if v is not None for p in plain(v, frozenset(LONE_KEYS))}
    got = p4_found(spark, sf).where(F.col("table_name") == "documents")
    assert {tuple(r) for r in got.select("table_name", "record_id", "path", "parent_path").collect()} == want
