"""Versioned Parquet datasets: write beside, then point. Readers see a whole version or the one before."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Store:
    """A dataset in a folder of any Hadoop file system.

    A version is written beside the others, then a pointer file with its number appears by one rename that fails if it
    is there already: nothing is ever deleted before its successor stands, so a reader always finds a whole version,
    and of two writers of one version the second raises. The pointer also names what is in: tags, and for each stream
    the last batch, so a batch that is run again changes nothing however long ago it was.
    """

    KEPT = 3

    def __init__(self, spark: SparkSession, path: str, schema: StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        jvm = spark.sparkContext._jvm
        self._p = lambda x: jvm.org.apache.hadoop.fs.Path(x)
        self.fs = self._p(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _text(self, path: str) -> str:
        stream = self.fs.open(self._p(path))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def versions(self) -> list[int]:
        at = self._p(f"{self.path}/versions")
        names = [f.getPath().getName() for f in self.fs.listStatus(at)] if self.fs.exists(at) else []
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _pointer(self) -> dict:
        there = self.versions()
        return json.loads(self._text(f"{self.path}/versions/v{there[-1]}.json")) if there else {"version": 0, "tags": [], "streams": {}}

    def read(self) -> DataFrame:
        """The current version; an empty table before the first."""
        v = self._pointer()["version"]
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{v}") if v else self.spark.createDataFrame([], self.schema)

    def commit(self, change: Callable[[DataFrame], DataFrame], tag: str | None = None, stream: str | None = None, batch: int | None = None) -> int:
        """Writes ``change`` of the current version as the next one. A tag, or a batch of a stream, that is in already changes nothing."""
        now = self._pointer()
        if (tag and tag in now["tags"]) or (stream and batch is not None and batch <= now["streams"].get(stream, -1)):
            return now["version"]
        v = now["version"] + 1
        change(self.read()).select(*[f.name for f in self.schema]).write.mode("overwrite").parquet(f"{self.path}/v{v}")
        self._point({"version": v, "tags": [*now["tags"], *([tag] if tag else [])], "streams": {**now["streams"], **({stream: batch} if stream else {})}})
        for old in self.versions()[: -self.KEPT]:
            self.fs.delete(self._p(f"{self.path}/versions/v{old}.json"), False)
            self.fs.delete(self._p(f"{self.path}/v{old}"), True)
        return v

    def _point(self, to: dict) -> None:
        at = self._p(f"{self.path}/versions/v{to['version']}.json")
        tmp = self._p(f"{self.path}/versions/_{uuid.uuid4().hex}.tmp")
        out = self.fs.create(tmp, True)
        out.write(bytearray(json.dumps(to).encode()))
        out.close()
        if self.fs.exists(at) or not self.fs.rename(tmp, at):
            self.fs.delete(tmp, False)
            raise RuntimeError(f"version {to['version']} of {self.path} was written by another writer")


def export_csv(df: DataFrame, path: str, headers: dict[str, str], order: list[str]) -> None:
    """CSV under other headings, blanks for nulls, sorted; one folder of files in order."""
    from pyspark.sql import functions as F

    df.orderBy(*order).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(h) for h, c in headers.items()]).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def dump_json(tabs: dict[str, DataFrame], path: str) -> None:
    """One JSON dataset a tab."""
    for name, df in tabs.items():
        df.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")
