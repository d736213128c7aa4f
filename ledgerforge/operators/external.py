"""Calls to outside services (recognition, classification) from partitions, with bounded concurrency.

The client is given; without one nothing is called. Failures become rows with an
error, and what is done already is left out before the call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def call(df: DataFrame, key: str, body: str, client: Callable[[], Callable[[str], str]], at_once: int = 4, tries: int = 3) -> DataFrame:
    """(key, answer, error) of every row: ``client()`` is made once a partition, its answers are taken ``at_once`` at a time."""
    kind = df.schema[key].dataType.simpleString()

    def one(ask: Callable[[str], str], text: str) -> tuple[str | None, str | None]:
        error = None
        for _ in range(tries):
            try:
                return ask(text), None
            except Exception as e:  # the service's failure is the row's, not the job's
                error = f"{type(e).__name__}: {e}"[:300]
        return None, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        with ThreadPoolExecutor(at_once) as pool:
            for pdf in batches:
                got = list(pool.map(lambda t: one(ask, t), pdf["_b"]))
                yield pd.DataFrame({"_k": pdf["_k"], "answer": [a for a, _ in got], "error": [e for _, e in got]})

    return df.select(F.col(key).alias("_k"), F.col(body).alias("_b")).mapInPandas(run, f"_k {kind}, answer string, error string").withColumnRenamed("_k", key)


def undone(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys have no result yet."""
    return df.join(done.select(*keys), keys, "left_anti")


def agree(first: DataFrame, second: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Rows on which two readings agree in every column; null agrees with null."""
    b = second.select(key, *[F.col(c).alias(f"_{c}") for c in cols])
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return first.join(b, key).where(same).select(*first.columns)
