"""Columnar shredding of nested records (problem 4).

Every record is turned into column stripes, one per leaf path, each entry
carrying a repetition level (at which list the value repeats) and a definition
level (how much of the path exists). Lists of objects get one more stripe of
their own, the presence stripe, so that empty objects and null elements keep
their place. The flat tables, one per repeated ancestor, are rebuilt from the
level sequences alone, vectorised over a batch of records: the position in the
list of level k counts the entries with repetition level k since the last entry
with a lower one.

A record never leaves its batch, so there is no shuffle; a batch is bounded by
Arrow's batch size.

Defined results: a null, blank or damaged record yields no rows; a record that
is a JSON string holding JSON is decoded until it is no string; null elements
yield no row but keep their position; an empty object is a row without fields;
a list of plain values is one field of its object, written as a JSON array (lists
of such lists as one flat array); with ``root`` the record itself is a row too,
with path '', for what stands above all lists; a record may be nested as deep as
it likes, as it is read and walked without recursion; lists of lists repeat once
more (``a[0][1]``); a lone object under one of ``lone_keys`` counts as the list
with that one element.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The keys whose lone object counts as a list of one.
LONE_KEYS = (
    "pages", "sheets", "parts", "contacts", "schedule",
    "line_items", "taxes", "lots", "moves", "handwritten",
)

ROW_SCHEMA = "record_id bigint, table_path string, path string, parent_path string, fields map<string,string>"

_GONE = object()
#: The list step of a path; no key of an object equals it.
_LIST = 0


class _Node:
    """What one record holds at one path: a scalar, an object, a list, or several of them in turn."""

    __slots__ = ("leaf", "keys", "item")

    def __init__(self) -> None:
        self.leaf = False
        self.keys: dict[str, _Node] | None = None
        self.item: _Node | None = None


def _infer(root: _Node, record: object, lone: frozenset[str]) -> None:
    todo: list[tuple[_Node, object]] = [(root, record)]
    while todo:
        node, value = todo.pop()
        if isinstance(value, dict):
            if node.keys is None:
                node.keys = {}
            for k, v in value.items():
                if k in lone and isinstance(v, dict):
                    v = value[k] = [v]
                todo.append((node.keys.setdefault(k, _Node()), v))
        elif isinstance(value, list):
            if node.item is None:
                node.item = _Node()
            todo.extend((node.item, v) for v in value)
        elif value is not None:
            node.leaf = True


class _Stripe:
    """One column of a batch: for each entry the record, its levels and its value."""

    __slots__ = ("record", "rep", "dfn", "value", "owner", "name", "level", "full")

    def __init__(self, owner: tuple, name: str | None, level: int, full: int) -> None:
        self.owner, self.name, self.level, self.full = owner, name, level, full
        self.record: list[int] = []
        self.rep: list[int] = []
        self.dfn: list[int] = []
        self.value: list[object] = []


class _Writer:
    """Shreds records into stripes. Paths are tuples of keys and list steps."""

    def __init__(self, values: bool) -> None:
        self.stripes: dict[tuple, _Stripe] = {}
        self.values = values
        self.record = 0

    def _put(self, key: tuple[str, ...], owner: tuple, name: str | None, level: int, full: int, rep: int, dfn: int, value: object) -> None:
        s = self.stripes.get(key)
        if s is None:
            s = self.stripes[key] = _Stripe(owner, name, level, full)
        s.record.append(self.record)
        s.rep.append(rep)
        s.dfn.append(dfn)
        s.value.append(value)

    def shred(self, root: _Node, record: object) -> None:
        """Writes a record's stripes in the order of a walk from left to right.

        dfn: levels defined so far; depth: levels that the path could have defined; level: the lists above.
        """
        todo: list[tuple] = [(root, record, (), (), 0, 0, 0, 0)]
        while todo:
            node, value, path, owner, rep, dfn, level, depth = todo.pop()
            then: list[tuple] = []
            if node.leaf and self.values:
                there = value is not _GONE and value is not None and not isinstance(value, (dict, list))
                name = ".".join(x for x in path[len(owner) :] if x != _LIST)
                self._put((*path, "="), owner, name, level, depth + 1, rep, dfn + there, value if there else None)
            if node.keys is not None:
                there = isinstance(value, dict)
                in_list = bool(path) and path[-1] == _LIST
                own = path if in_list else owner
                if in_list:
                    self._put((*path, "{"), path, None, level, depth + 1, rep, dfn + there, None)
                for k, child in node.keys.items():
                    then.append((child, value.get(k, _GONE) if there else _GONE, (*path, k), own, rep, dfn + there, level, depth + 1))
            if node.item is not None:
                inner = (*path, _LIST)
                if isinstance(value, list) and value:
                    then.extend((node.item, v, inner, owner, rep if i == 0 else level + 1, dfn + 1, level + 1, depth + 1) for i, v in enumerate(value))
                else:
                    then.append((node.item, _GONE, inner, owner, rep, dfn, level + 1, depth + 1))
            todo.extend(reversed(then))


def _positions(rep: np.ndarray, levels: int) -> np.ndarray:
    """positions[:, k-1]: the place of each entry in the list of level k, from the repetition levels."""
    out = np.zeros((len(rep), levels), dtype=np.int64)
    for k in range(1, levels + 1):
        seen = np.cumsum(rep == k)
        out[:, k - 1] = seen - np.maximum.accumulate(np.where(rep < k, seen, 0))
    return out


def _template(path: tuple) -> str:
    text = ""
    for step in path:
        if step == _LIST:
            text += "[%d]"
        else:
            text += ("." if text else "") + step.replace("%", "%%")
    return text


def shred_batch(records: list[tuple[int, object]], lone: frozenset[str], values: bool = True, root: bool = False) -> pd.DataFrame:
    """Rows of the flat tables of a batch of decoded records; with ``root`` also one of each record that is an object."""
    w = _Writer(values)
    for i, (_, value) in enumerate(records):
        node = _Node()
        _infer(node, value, lone)
        w.record = i
        w.shred(node, value)
    ids = np.array([r for r, _ in records], dtype=np.int64)
    fields: dict[tuple[int, str], dict[str, str]] = {}
    if values:
        lists: dict[tuple[int, str, str], list] = {}
        for key, s in w.stripes.items():
            if s.name is None:
                continue
            # a list of plain values repeats deeper than its object does: its values are one field
            levels = s.owner.count(_LIST)
            plain = _LIST not in key[len(s.owner) : -1]
            pos = _positions(np.array(s.rep), levels)
            made = _template(s.owner)
            for j in np.flatnonzero(np.array(s.dfn) == s.full):
                at, v = made % tuple(pos[j]), s.value[j]
                if plain:
                    fields.setdefault((s.record[j], at), {})[s.name] = v if isinstance(v, str) else json.dumps(v)
                else:
                    lists.setdefault((s.record[j], at, s.name), []).append(v)
        for (record, at, name), found in lists.items():
            own = fields.setdefault((record, at), {})
            own[name if name not in own else name + "[]"] = json.dumps(found)
    cols: dict[str, list] = {"record_id": [], "table_path": [], "path": [], "parent_path": [], "fields": []}
    if root:
        whole = [i for i, (_, v) in enumerate(records) if isinstance(v, dict)]
        cols["record_id"].extend(ids[whole])
        for c in ("table_path", "path", "parent_path"):
            cols[c].extend([""] * len(whole))
        cols["fields"].extend([fields.get((i, ""), {}) for i in whole] if values else [None] * len(whole))
    for s in w.stripes.values():
        if s.name is not None:
            continue
        rows = np.flatnonzero(np.array(s.dfn) == s.full)
        if not len(rows):
            continue
        pos = _positions(np.array(s.rep), s.level)[rows]
        made, above = _template(s.owner), s.owner[:-1]
        while above and above[-1] != _LIST:
            above = above[:-1]
        parent, depth = _template(above), above.count(_LIST)
        table = ".".join(x for x in s.owner if x != _LIST)
        paths = [made % tuple(p) for p in pos]
        rec = [s.record[j] for j in rows]
        cols["record_id"].extend(ids[rec])
        cols["table_path"].extend([table] * len(rows))
        cols["path"].extend(paths)
        cols["parent_path"].extend([parent % tuple(p[:depth]) for p in pos] if depth else [""] * len(rows))
        cols["fields"].extend([fields.get(k, {}) for k in zip(rec, paths)] if values else [None] * len(rows))
    return pd.DataFrame(cols)


_TOKEN = re.compile(r'\s*(?:([\[\]{},:])|("(?:[^"\\]|\\.)*")|([^\s\[\]{},:"]+))', re.S)


def _deep(text: str) -> object:
    """The value of a JSON text of any depth: scalars are read by the library, nesting by a stack."""
    stack: list = []
    keys: list = []
    value: object = _GONE  # the value just ended, if any
    at, key, mark = 0, _GONE, ""
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError("no JSON")
        at, last, mark = m.end(), mark, m[1] or ""
        if mark in ("{", "["):
            if value is not _GONE or (stack and isinstance(stack[-1], dict) and key is _GONE):
                raise ValueError("no JSON")
            keys.append(key)
            stack.append({} if mark == "{" else [])
            key = _GONE
        elif mark == ":":
            if not stack or not isinstance(stack[-1], dict) or not isinstance(value, str) or key is not _GONE:
                raise ValueError("no JSON")
            key, value = value, _GONE
        elif mark in (",", "}", "]"):
            if not stack or (mark == "}") > isinstance(stack[-1], dict) or (mark == "]") > isinstance(stack[-1], list):
                raise ValueError("no JSON")
            top = stack[-1]
            if value is _GONE:
                if mark == "," or last == "," or key is not _GONE:
                    raise ValueError("no JSON")
            elif isinstance(top, dict):
                if key is _GONE:
                    raise ValueError("no JSON")
                top[key] = value
            else:
                top.append(value)
            value, key = _GONE, _GONE
            if mark != ",":
                value, key = stack.pop(), keys.pop()
        else:
            if value is not _GONE:
                raise ValueError("no JSON")
            value = json.loads(m[2] or m[3])
    if stack or value is _GONE:
        raise ValueError("no JSON")
    return value


def decode(text: str | None) -> object:
    """The value of a JSON text, decoded as often as it was encoded; None if null, blank or damaged."""
    value: object = text
    while isinstance(value, str):
        try:
            try:
                value = json.loads(value)
            except RecursionError:
                value = _deep(value)
        except ValueError:
            return None
    return value


def shred_json(df: DataFrame, id_col: str, json_col: str, lone_keys: tuple[str, ...] = LONE_KEYS, values: bool = True, root: bool = False) -> DataFrame:
    """Flat rows of all objects that are elements of arrays in a JSON column, with ``root`` also of the records themselves; see the module for defined results.

    Parents need not be objects: the parent of an object in a list of lists is the nearest array element, its inner list.
    """
    lone = frozenset(lone_keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            records = [(i, v) for i, v in ((i, decode(t)) for i, t in zip(pdf["record_id"], pdf["body"])) if isinstance(v, (dict, list))]
            for k in range(0, len(records), 500):
                rows = shred_batch(records[k : k + 500], lone, values, root)
                if len(rows):
                    yield rows

    src = df.select(F.col(id_col).cast("bigint").alias("record_id"), F.col(json_col).alias("body")).where("record_id is not null and body is not null")
    return src.mapInPandas(run, ROW_SCHEMA)


def shred_column(df: DataFrame, id_col: str, col: str, lone_keys: tuple[str, ...] = (), values: bool = True) -> DataFrame:
    """The same for a typed nested column, whose name becomes the first key of the paths."""
    typed = df.select(F.col(id_col).alias("record_id"), F.to_json(F.struct(F.col(col).alias(col))).alias("body")).where(F.col(col).isNotNull())
    return shred_json(typed, "record_id", "body", lone_keys, values)
