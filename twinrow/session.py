"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "twinrow", master: str | None = None, **conf: object
) -> SparkSession:
    """A session with the settings the comparisons rely on.

    The time zone is pinned because rows are compared as text. The RocksDB
    state store keeps streaming state off the heap.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state."
            "RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="twinrow-")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, in the shared folder the cluster names.

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    A join with them is planned by their true size, and as they come from a scan
    rather than an aggregation, Spark can split a hot key of the other side.
    """
    folder = run_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _file_system(spark: SparkSession, path: str):
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark reads."""
    own, files = _file_system(spark, path)
    return files.exists(own)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder the library made, with what it holds."""
    own, files = _file_system(spark, path)
    files.delete(own, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    own, files = _file_system(spark, path)
    return files.getContentSummary(own).getLength() if files.exists(own) else 0
