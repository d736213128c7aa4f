"""Delivery of documents with retries, as a stream and as a batch.

The rules are one pure function; the stream keeps its state by key with
``applyInPandasWithState`` and a processing-time lease, the batch derives the
same end state with windows. Both agree on any order of arrival that keeps each
key's events in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Failed attempts after which a task is given up, and the first wait in seconds.
MOST_ATTEMPTS, FIRST_WAIT = 3, 5

STATE = "attempts int, status string, last_us bigint"
OUTPUT = "task bigint, status string, attempts int, next_attempt_us bigint"


@dataclass
class Delivery:
    attempts: int = 0
    status: str = "QUEUED"
    last_us: int = 0

    def see(self, failed: bool, delivered: bool, at_us: int, sent: bool = False) -> None:
        """One event: sending takes the task, a failure counts an attempt, a success ends the task; an ended task stays as it is."""
        if self.status in ("DELIVERED", "FAILED_PERMANENT"):
            return
        if sent and not failed and not delivered:
            self.status, self.last_us = "IN_FLIGHT", at_us
        if failed:
            self.attempts, self.last_us = self.attempts + 1, at_us
            self.status = "FAILED_PERMANENT" if self.attempts >= MOST_ATTEMPTS else "RETRY_WAIT"
        elif delivered:
            self.status, self.last_us = "DELIVERED", at_us

    @property
    def next_us(self) -> int | None:
        return self.last_us + FIRST_WAIT * 2 ** (self.attempts - 1) * 1_000_000 if self.status == "RETRY_WAIT" else None


def delivery_stream(events: DataFrame, task: str, failed: Column, delivered: Column, at: str, order: str, sent: Column | None = None, lease: str = "10 minutes") -> DataFrame:
    """The changed tasks of each micro-batch.

    A task that waits for its next attempt goes back to QUEUED when that is due, by the clock of the stream: so many
    seconds after its failure was seen. One that is IN_FLIGHT and has no news for ``lease`` goes back too. QUEUED and
    ended tasks have no timer.
    """
    lease_ms = int(pd.Timedelta(lease).total_seconds() * 1000)
    # what an event says travels as numbers, so the state function needs no knowledge of the events
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    src = events.select(F.col(task).cast("bigint").alias("task"), flag(failed).alias("failed"), flag(delivered).alias("delivered"), flag(sent if sent is not None else F.lit(False)).alias("sent"), F.unix_micros(F.col(at).cast("timestamp")).alias("us"), F.col(order).alias("ord"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        d = Delivery(*state.get) if state.exists else Delivery()
        if state.hasTimedOut:
            d.status = "QUEUED"
        else:
            for pdf in batches:
                for r in pdf.sort_values(["us", "ord"]).itertuples():
                    d.see(bool(r.failed), bool(r.delivered), int(r.us), bool(r.sent))
        state.update((d.attempts, d.status, d.last_us))
        if d.status == "RETRY_WAIT":
            state.setTimeoutDuration(FIRST_WAIT * 2 ** (d.attempts - 1) * 1000)
        elif d.status == "IN_FLIGHT":
            state.setTimeoutDuration(lease_ms)
        yield pd.DataFrame({"task": [key[0]], "status": [d.status], "attempts": [d.attempts], "next_attempt_us": pd.array([d.next_us], dtype="Int64")})

    return src.groupBy("task").applyInPandasWithState(step, OUTPUT, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)


def delivery_batch(events: DataFrame, task: str, failed: Column, delivered: Column, at: str, order: str) -> DataFrame:
    """The end state of every task, from all its events: attempts are the failures before the first success, at most three."""
    e = events.select(F.col(task).cast("bigint").alias("task"), failed.alias("f"), delivered.alias("d"), F.unix_micros(F.col(at).cast("timestamp")).alias("us"), F.col(order).alias("ord"))
    first = e.groupBy("task").agg(F.min(F.when(F.col("d"), F.struct("us", "ord"))).alias("won"))
    j = e.join(first, "task")
    open_ = F.col("f") & (F.col("won").isNull() | (F.struct("us", "ord") < F.col("won")))
    fails = j.where(open_).withColumn("k", F.row_number().over(W.partitionBy("task").orderBy("us", "ord"))).where(F.col("k") <= MOST_ATTEMPTS)
    n = fails.groupBy("task").agg(F.max("k").alias("attempts"), F.max("us").alias("last"))
    t = first.join(n, "task", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)).cast("int"))
    status = F.when(F.col("attempts") >= MOST_ATTEMPTS, "FAILED_PERMANENT").when(F.col("won").isNotNull(), "DELIVERED").when(F.col("attempts") > 0, "RETRY_WAIT").otherwise("QUEUED")
    t = t.withColumn("status", status)
    wait = F.when(F.col("status") == "RETRY_WAIT", F.col("last") + (F.lit(FIRST_WAIT * 1_000_000) * F.pow(F.lit(2), F.col("attempts") - 1)).cast("bigint"))
    return t.select("task", "status", "attempts", wait.alias("next_attempt_us"))
