"""Session helpers shared by tests, bench and queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerforge")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only a local master, whose executors are this machine, may do without: tests and local runs use a local folder then.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return d or os.environ.get("LEDGERFORGE_CHECKPOINT", "/tmp/ledgerforge-checkpoint")


def _cuts(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/ledgerforge-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: cuts lineage, survives lost executors.

    The files stay until ``drop_cut`` or, for all of a session, ``clear_cuts``: results are lazy and may read them later.
    """
    spark = df.sparkSession
    path = f"{_cuts(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path  # type: ignore[attr-defined]
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a ``cut`` that nothing will read any more."""
    _delete(df.sparkSession, df._cut_path)


def clear_cuts(spark: SparkSession) -> None:
    """Delete all cuts of this session, once its results are written."""
    _delete(spark, _cuts(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
