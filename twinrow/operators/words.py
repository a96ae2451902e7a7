"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.functions.tokens import tokens


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Number of times each word occurs. Counts are added up before the shuffle."""
    return tokens(lines, column).groupBy("word").agg(F.count("*").alias("n"))


def union_lines(*frames: DataFrame) -> DataFrame:
    """All lines of all inputs, repeats included."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
