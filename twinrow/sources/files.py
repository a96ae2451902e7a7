"""CSV rows and text lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_csv_rows(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str = ",",
    line_sep: str = "\n",
) -> DataFrame:
    """CSV without header or quoting, all columns text.

    Every line is a row, also an empty one; lines end at ``line_sep`` alone, so a
    carriage return before it belongs to the last field. A line with too many or
    too few fields fails the read. An empty field is an empty text, never null,
    since a digest tells the two apart.
    """
    lines = spark.read.option("lineSep", line_sep).text(path)
    fields = F.split("value", re.escape(sep), -1)
    message = F.format_string(
        f"expected {len(columns)} fields, found %d: %s", F.size("fields"), F.col("value")
    )
    checked = F.when(F.size("fields") == len(columns), F.col("fields")).otherwise(
        F.raise_error(message)
    )
    rows = lines.select("value", fields.alias("fields")).select(checked.alias("fields"))
    return rows.select(*[F.col("fields")[i].alias(c) for i, c in enumerate(columns)])


def split_csv_rows(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str = ",",
    line_sep: str = "\n",
) -> tuple[DataFrame, DataFrame]:
    """The rows that ``read_csv_rows`` reads, and beside them the lines that would fail it.

    A wrong line comes with its ``file``, its ``offset`` there in bytes, the number of
    ``fields`` found and its ``line``. Rows go through without waiting for that: only
    for the wrong lines the lengths of all lines are added up, within the block that a
    task reads and then over the blocks of a file. Compressed files are one block.
    """
    lines = spark.read.option("lineSep", line_sep).text(path)
    parts = F.split("value", re.escape(sep), -1)
    right = F.size("parts") == len(columns)
    rows = lines.select(parts.alias("parts")).where(right).select(
        *[F.col("parts")[i].alias(c) for i, c in enumerate(columns)]
    )
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        (F.octet_length("value") + len(line_sep.encode())).cast("bigint").alias("bytes"),
        F.size(parts).alias("fields"), "value",
    ).select(
        "file", "block", "nth", "bytes", "fields",
        F.when(F.col("fields") != len(columns), F.col("value")).alias("line"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A block's first whole line begins where the last line of the block before it ends.
    starts = placed.groupBy("file", "block").agg(F.sum("bytes").alias("held")).select(
        "file", "block", F.coalesce(F.sum("held").over(in_file), F.lit(0)).alias("start")
    )
    wrong = (
        placed.withColumn("ahead", F.coalesce(F.sum("bytes").over(in_block), F.lit(0)))
        .where("line is not null").join(starts, ["file", "block"])
        .select("file", (F.col("start") + F.col("ahead")).alias("offset"), "fields", "line")
    )
    return rows, wrong


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of all the text files, in column ``value``."""
    return spark.read.text(list(paths))
