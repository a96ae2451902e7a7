"""Hash records kept by run, in tables bucketed by key hash.

Two kept runs are compared bucket by bucket, without an exchange. A later run of the
same source hashes only the files that are new or have changed, by their time and
size, and takes the records of the others from the run before it. Records know the
file they come from.

A bucket is read by one task, so there should be enough of them for the largest run;
a key's records are counted as they are read, so a hot key costs no memory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinrow.functions import render
from twinrow.operators.agreement import status
from twinrow.session import settled

BUCKETS = 64
FILE = ["file", "modified", "bytes"]


@dataclass(frozen=True)
class Run:
    """A kept run: the table of its hash records and the folder it lies in."""

    table: str
    folder: str

    def files(self, spark: SparkSession) -> DataFrame:
        """The source's files, with their times and sizes, when the run was kept."""
        return spark.read.parquet(f"{self.folder}/files")


def source_files(rows: DataFrame) -> DataFrame:
    """One row a file of a frame read from files."""
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("bytes"),
    ).distinct()


def hashed_files(rows: DataFrame, fields: Sequence[str], key_fields: Sequence[str]) -> DataFrame:
    """Key hash, value hash and file of every row of a frame read from files."""
    return rows.select(
        render.digest(render.render_json(render.field_texts(rows, key_fields))).alias("key_hash"),
        render.digest(render.render_json(render.field_texts(rows, fields))).alias("value_hash"),
        F.col("_metadata.file_path").alias("file"),
    )


def keep_run(
    spark: SparkSession, run: Run, read: Callable[[Sequence[str]], DataFrame], paths: Sequence[str],
    fields: Sequence[str], key_fields: Sequence[str], before: Run | None = None, buckets: int = BUCKETS,
) -> int:
    """Keeps the hash records of a source, and returns how many of its files were hashed.

    ``read`` reads files of the source by their paths. ``before`` is an earlier run of
    it with the same fields.
    """
    source_files(read(paths)).write.parquet(f"{run.folder}/files")
    files = run.files(spark)
    if before is None:
        hashed, records = files.count(), hashed_files(read(paths), fields, key_fields)
    else:
        fresh = files.join(before.files(spark), FILE, "left_anti")
        same = settled(files.join(fresh, FILE, "left_anti").select("file"), "same-files")
        # One line a file, as the driver lists files anyway.
        todo = [r["file"] for r in fresh.select("file").collect()]
        hashed = len(todo)
        records = spark.table(before.table).join(same, "file", "left_semi")
        if todo:
            records = records.unionByName(hashed_files(read(todo), fields, key_fields))
    (
        records.select("key_hash", "value_hash", "file").repartition(buckets, "key_hash")
        .write.bucketBy(buckets, "key_hash").sortBy("key_hash")
        .option("path", f"{run.folder}/records").saveAsTable(run.table)
    )
    return hashed


def compare_runs(spark: SparkSession, left: Run, right: Run) -> DataFrame:
    """Class of every key of two kept runs, with rows per side, as ``classify`` gives it."""
    counted = [
        spark.table(run.table).groupBy("key_hash").agg(
            F.count(F.lit(1)).alias(f"{side}_rows"),
            F.min("value_hash").alias(f"{side}_lo"), F.max("value_hash").alias(f"{side}_hi"),
        )
        for run, side in ((left, "left"), (right, "right"))
    ]
    both = counted[0].join(counted[1], "key_hash", "full_outer")
    alike = F.least("left_lo", "right_lo") == F.greatest("left_hi", "right_hi")
    rows = [F.coalesce(f"{side}_rows", F.lit(0)).alias(f"{side}_rows") for side in ("left", "right")]
    return both.select("key_hash", *rows, alike.alias("alike")).select(
        "key_hash", "left_rows", "right_rows", status("left_rows", "right_rows", F.col("alike")).alias("status")
    )
