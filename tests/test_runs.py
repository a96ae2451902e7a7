"""Kept runs: compared without an exchange, hashed again only where files changed."""

import time
import uuid

from conftest import rows
from pyspark.sql import functions as F

from twinrow.operators import runs
from twinrow.operators.agreement import classify
from twinrow.operators.hashing import hash_rows


def put(spark, folder, name, items):
    spark.createDataFrame(items, "id string, val string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def test_runs_are_compared_without_an_exchange(spark, folder):
    parts = {"a": [("1", "x"), ("2", "x"), ("2", "x")], "b": [("3", "y"), (None, "z")], "c": [("5", "q")]}
    for name, items in parts.items():
        put(spark, f"{folder}/in", name, items)

    def read(paths):
        return spark.read.parquet(*paths)

    def kept(name, before=None):
        run = runs.Run(f"run_{uuid.uuid4().hex}", f"{folder}/{name}")
        paths = [f"{folder}/in/{n}" for n in "abc"]
        return run, runs.keep_run(spark, run, read, paths, ["val"], ["id"], before, buckets=3)

    first, hashed = kept("first")
    assert hashed == 3
    time.sleep(1.1)
    put(spark, f"{folder}/in", "b", [("3", "changed"), ("6", "new")])
    second, hashed = kept("second", first)
    assert hashed == 1
    third, hashed = kept("third", second)
    assert hashed == 0
    now = hash_rows(read([f"{folder}/in/{n}" for n in "abc"]), ["val"], ["id"]).select("key_hash", "value_hash")
    old = hash_rows(
        spark.createDataFrame(sum(parts.values(), []), "id string, val string"), ["val"], ["id"]
    ).select("key_hash", "value_hash")
    for run, want in ((first, old), (second, now), (third, now)):
        assert rows(spark.table(run.table).select("key_hash", "value_hash")) == rows(want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = runs.compare_runs(spark, first, second)
        assert rows(found) == rows(classify(old, now))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert runs.compare_runs(spark, second, third).where(F.col("status") != "MATCH").isEmpty()
    for run in (first, second, third):
        spark.sql(f"drop table {run.table}")
