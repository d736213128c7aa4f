"""A watched folder: new files become rows once, and state is merged by one writer a batch."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerforge.sources.store import Store


def watch(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """The rows of Parquet files as they arrive, in bounded batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def once_by_content(stream: DataFrame, content: str, at: str, late: str = "1 day") -> DataFrame:
    """The first row of each content; state is dropped ``late`` behind the newest time, our bound, so later copies pass."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([content])


def merge_into(stream: DataFrame, store: Store, step: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Each batch makes a new version of the store out of the last one; a batch that is run again changes nothing.

    Batches count under the id of the query, which lives in its checkpoint: another stream, or the same one with a fresh
    checkpoint, has its own count, and what it reads is merged, not skipped. every: trigger interval; without it the query
    takes what there is and ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        query = json.loads(store._text(f"{checkpoint.rstrip('/')}/metadata"))["id"]
        store.commit(lambda old: step(old, batch), stream=query, batch=number)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def windowed_counts(stream: DataFrame, at: str, by: str, size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows by event-time window and value; rows later than ``late`` are dropped, which is ours to choose."""
    from pyspark.sql import functions as F

    return stream.withWatermark(at, late).groupBy(F.window(at, size), by).agg(F.count("*").alias("n"))
