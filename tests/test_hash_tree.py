"""Comparison by digests: equal to the plain classes, and little read again."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from twinrow.operators import hash_tree
from twinrow.operators.hashing import LEFT, RIGHT
from twinrow.operators.reconcile import outstanding_status, reconcile

SIDE = "key_hash string, value_hash string"


def copies(spark, n, seed, changes, keys=None):
    pick = random.Random(seed)
    items = [(str(pick.randrange(keys or 10 * n)), str(pick.randrange(5))) for _ in range(n)]
    other = list(items)
    for _ in range(changes):
        k = pick.randrange(len(other))
        what = pick.randrange(4)
        if what == 0:
            other[k] = (other[k][0], "changed")
        elif what == 1:
            other.pop(k)
        elif what == 2:
            other.append(other[k])
        else:
            other.append((f"new{k}", "v"))
    pick.shuffle(other)
    return [spark.createDataFrame(x, SIDE) for x in (items, other)]


def expected(left, right):
    tagged = [
        side.withColumns({"case_id": F.lit(1).cast("bigint"), "run_id": F.lit(1).cast("bigint"), "side": F.lit(name)})
        for side, name in ((left, LEFT), (right, RIGHT))
    ]
    return rows(outstanding_status(reconcile(tagged[0].unionByName(tagged[1]))).drop("case_id", "run_id"))


@pytest.mark.parametrize("n, changes, keys", [(600, 9, None), (300, 200, 7), (0, 0, None)])
@pytest.mark.parametrize("bits, least", [(12, 32), (2, 3)])
def test_differences_equal_a_reconciliation(spark, monkeypatch, n, changes, keys, bits, least):
    monkeypatch.setattr(hash_tree, "BITS", bits)
    monkeypatch.setattr(hash_tree, "ROWS_PER_NODE", least)
    left, right = copies(spark, n, n + changes, changes if n else 0, keys)
    assert rows(hash_tree.differences(left, right)) == expected(left, right)
    assert rows(hash_tree.differences(left, left.orderBy(F.rand()))) == []


def test_doubled_rows_do_not_cancel_out(spark):
    left = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], SIDE)
    right = spark.createDataFrame([("b", "y")], SIDE)
    for pair in ((left, right), (right, left)):
        assert rows(hash_tree.differences(*pair)) == expected(*pair)
    twice = right.union(right).union(right)
    assert hash_tree.differing_nodes(right, twice)[0].count() == 1


def test_a_thousandth_that_differs_leaves_little_to_shuffle(spark):
    left = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("key_hash"), F.lit("v").alias("value_hash"))
    changed = F.when(F.col("key_hash").endswith("000"), F.lit("w")).otherwise(F.col("value_hash"))
    right = left.withColumn("value_hash", changed)
    wrong = right.where("value_hash = 'w'").count()
    assert 0 < wrong <= 40
    nodes, bits = hash_tree.differing_nodes(left, right)
    again = sum(hash_tree.rows_in(side, nodes, ["key_hash"], bits).count() for side in (left, right))
    assert again < 0.05 * 80_000
    got = hash_tree.differences(left, right)
    assert got.count() == wrong and {r.status for r in got.collect()} == {"VALUE_MISMATCH"}


def test_equal_nodes_of_stored_runs_are_not_read(spark, folder):
    left, right = copies(spark, 3000, 5, 4)
    for name, side in (("l", left), ("r", right)):
        hash_tree.store(side, f"{folder}/{name}")
    got = hash_tree.stored_differences(spark, f"{folder}/l", f"{folder}/r")
    assert rows(got) == expected(left, right)
    level = hash_tree._against(*[spark.read.parquet(f"{folder}/{n}/digests") for n in "lr"])
    assert level.where("apart").count() <= 5 < 200 < level.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [node#") >= 2
    same = hash_tree.stored_differences(spark, f"{folder}/l", f"{folder}/l")
    assert same.isEmpty()
