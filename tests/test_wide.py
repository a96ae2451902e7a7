"""Field differences of wide tables: the plain answer, and how little is rendered."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from twinrow.operators import diff, wide

FIELDS = [f"c{k}" for k in range(200)]
KINDS = ["string", "bigint", "double", "boolean", "date"]


def wide_tables(spark, n, changes, seed=1):
    pick = random.Random(seed)
    base = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        *[
            F.when(F.xxhash64("id", F.lit(k)) % 9 == 0, None).otherwise(
                {"string": F.concat(F.lit('q"'), F.col("id").cast("string")), "bigint": F.col("id") + k,
                 "double": F.col("id") * 0.0, "boolean": F.col("id") % 2 == 0,
                 "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))}[KINDS[k % 5]]
            ).alias(f"c{k}")
            for k in range(200)
        ],
    )
    other = base
    for _ in range(changes):
        k, i = pick.randrange(200), pick.randrange(n)
        new = {"string": F.lit("new"), "bigint": F.lit(-1).cast("bigint"), "double": F.lit(-0.0), "boolean": F.lit(None).cast("boolean"),
               "date": F.lit("1999-09-09").cast("date")}[KINDS[k % 5]]
        other = other.withColumn(f"c{k}", F.when(F.col("id") == str(i), new).otherwise(F.col(f"c{k}")))
    return base, other


def test_two_hundred_columns(spark, folder):
    for name, df in zip("lr", wide_tables(spark, 60, 9)):
        df.write.parquet(f"{folder}/{name}")
    left, right = (spark.read.parquet(f"{folder}/{n}") for n in "lr")
    got = wide.wide_diff(left, right, FIELDS, ["id"])
    want = diff.diff_pairs(left, right, FIELDS, ["id"])
    assert rows(got) == rows(want.select(got.columns)) and got.count() >= 5
    # What is rendered is the differing groups' texts alone.
    def size(frame, names):
        return frame.select(sum(F.coalesce(F.octet_length(F.concat_ws("", n)), F.lit(0)) for n in names).alias("b")).agg(F.sum("b")).first()[0]

    parts = wide.differing_parts(left, right, FIELDS, ["id"])
    groups = [c for c in parts[0].columns if c.startswith("g")]
    rendered = sum(size(p, groups) for p in parts)
    all_texts = sum(size(diff.rendered(diff.keyed(s, FIELDS, ["id"]), FIELDS, ["id"], ["keys"]), ["texts"]) for s in (left, right))
    assert rendered < 0.05 * all_texts


def test_small_tables(spark):
    schema = "id string, a double, b string, c bigint"
    left = spark.createDataFrame([("1", 0.0, None, 1), ("2", 1.0, "x", None), ("3", None, "y", 3), (None, 1.0, "z", 4)], schema)
    right = spark.createDataFrame([("1", -0.0, None, 1), ("2", 1.0, None, 2), ("4", None, "y", 3), (None, 2.0, "z", 4), ("1", 0.0, "w", 1)], schema)
    got = wide.wide_diff(left, right, ["a", "b", "c"], ["id"])
    assert rows(got) == rows(diff.diff_pairs(left, right, ["a", "b", "c"], ["id"]).select(got.columns))
    assert rows(wide.wide_diff(left, left, ["a", "b", "c"], ["id"])) == []
    text = right.withColumn("c", F.col("c").cast("string"))
    mixed = wide.wide_diff(left, text, ["a", "c"], ["id"], ["a", "c"])
    assert rows(mixed) == rows(diff.diff_pairs(left, text, ["a", "c"], ["id"]).select(mixed.columns))
    with pytest.raises(ValueError):
        wide.wide_diff(left.union(left), right.union(right), ["a", "b"], ["id"])
    with pytest.raises(ValueError):
        wide.wide_diff(left.withColumn("keys", F.lit(1)), right, ["a"], ["id"])


def test_records(spark, records):
    left = records(['{"id":1,"a":"x","b":[1]}', '{"id":2,"a":"x"}'])
    right = records(['{"id":1,"a":"x","b":[2]}', '{"id":2,"a":null}'])
    got = wide.wide_diff(left, right, ["a", "b"], ["id"])
    assert rows(got) == rows(diff.diff_pairs(left, right, ["a", "b"], ["id"]).select(got.columns))
