"""Joins on a key with two thirds of the rows are split, seen in the executed plan."""

import pytest

from twinrow.operators import agreement, diff, hashing, windows

LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.files.maxPartitionBytes": "32k",
}


@pytest.fixture
def sides(spark, folder):
    old = {k: spark.conf.get(k, None) for k in LIMITS}
    for k, v in LIMITS.items():
        spark.conf.set(k, v)
    made = []
    for name, n in (("left", 30_000), ("right", 300)):
        df = spark.range(n).selectExpr(
            "if(id % 3 < 2, 'hot', concat('k', id)) as k", f"concat('{name}', id * 7919 % 1000003) as a",
            "timestamp_seconds(id % 20) as ts",
        )
        df.repartition(6).write.parquet(f"{folder}/{name}")
        made.append(spark.read.parquet(f"{folder}/{name}"))
    yield made
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_keys(sides):
    left, right = sides
    keys = hashing.with_key_hash(right, ["k"]).select("key_hash").distinct()
    assert "skew=true" in executed(agreement.keep_keys(left, keys, ["k"]))


def test_window_matches(sides):
    assert "skew=true" in executed(windows.window_matches(*sides, ["k"]))


def test_diff_report(sides):
    plan = executed(diff.diff_report(*sides, ["a"], ["k"]))
    assert "skew=true" in plan
    assert plan.split("Initial Plan")[0].count("FileScan") <= 4
