"""Where queries are registered with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def plain_counts(sql: str) -> str:
    """``count_if(x)`` as ``count(CASE WHEN x THEN 1 END)``: DuckDB's count_if is wider than bigint."""
    out, rest = "", sql
    while (at := rest.find("count_if(")) >= 0:
        start, depth, end = at + len("count_if("), 1, at + len("count_if(")
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[end], 0)
            end += 1
        out += rest[:at] + "count(CASE WHEN " + plain_counts(rest[start : end - 1]) + " THEN 1 END)"
        rest = rest[end:]
    return out + rest


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a query under its function's name, with the equivalent SQL for DuckDB if there is one."""

        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = plain_counts(sql)
            return f

        return add
