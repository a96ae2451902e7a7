"""Reconciliation of tagged hash records: what has no equal on the other side.

Equal records from opposite sides cancel one for one. What is left over is
outstanding: ``net`` is lefts minus rights. The aggregation runs unchanged on
batch and streaming frames; copies collapse before the shuffle, and records are
spread by key and value, so a key with many rows does not land on one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.operators.agreement import LEFT_ONLY, RIGHT_ONLY, VALUE_MISMATCH

RECORD = ["case_id", "run_id", "key_hash", "value_hash"]
KEY = ["case_id", "run_id", "key_hash"]


def reconcile(hashed: DataFrame) -> DataFrame:
    """Net count of every record; zero when both sides cancelled out."""
    sign = F.when(F.col("side") == "LEFT", F.lit(1)).otherwise(F.lit(-1)).cast("bigint")
    return hashed.groupBy(*RECORD).agg(F.sum(sign).alias("net"))


def outstanding(nets: DataFrame) -> DataFrame:
    """Records that have not cancelled out."""
    return nets.where("net <> 0")


def outstanding_status(nets: DataFrame) -> DataFrame:
    """Class of every key that still has outstanding records."""
    return left_over(nets, KEY)


def left_over(nets: DataFrame, on: Sequence[str]) -> DataFrame:
    """Records left on each side of every key that has any, and the key's class."""
    return (
        outstanding(nets)
        .groupBy(*on)
        .agg(
            F.sum(F.greatest("net", F.lit(0))).alias("left_left"),
            F.sum(F.greatest(-F.col("net"), F.lit(0))).alias("right_left"),
        )
        .withColumn(
            "status",
            F.when((F.col("left_left") > 0) & (F.col("right_left") > 0), F.lit(VALUE_MISMATCH))
            .when(F.col("left_left") > 0, F.lit(LEFT_ONLY))
            .otherwise(F.lit(RIGHT_ONLY)),
        )
    )


def latest(history: DataFrame) -> DataFrame:
    """Current net of every record, from rows written batch by batch."""
    return history.groupBy(*RECORD).agg(F.max_by("net", "batch_id").alias("net"))
