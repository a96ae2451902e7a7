import random
from collections import Counter

import pytest
from conftest import rows

from twinrow.operators import agreement, hashing, reconcile

LABELS = {"Id": "id", "Name": "name", "Val": "val"}
ROW = "id string, name string, val string"


def random_rows(seed, keys=6, n=40):
    pick = random.Random(seed)
    return [
        (str(pick.randrange(keys)), pick.choice("ab"), pick.choice("xyz")) for _ in range(n)
    ]


def brute_pairs(left, right):
    return Counter(a[0] for a in left for b in right if a[0] == b[0] and a != b)


@pytest.mark.parametrize("seed", range(4))
def test_mismatches_equal_brute_force(spark, seed):
    left, right = random_rows(seed), random_rows(seed + 100, keys=9, n=25)
    frames = [spark.createDataFrame(side, ROW) for side in (left, right)]
    pairs = brute_pairs(left, right)
    got = {r.id: (r.left_rows, r.right_rows) for r in agreement.mismatch_ids(*frames, "id", LABELS).collect()}
    sizes = [Counter(r[0] for r in side) for side in (left, right)]
    assert got == {k: (sizes[0][k], sizes[1][k]) for k in pairs}
    counted = agreement.mismatch_pairs(*frames, "id", LABELS).collect()
    assert {r.id: int(r.pairs) for r in counted} == dict(pairs)


def test_hot_key_counts_exactly(spark):
    """One key holds most rows of both sides; its pairs are counted, not formed."""
    from pyspark.sql import functions as F

    n = 200_000
    side = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("n").alias("name"), (F.col("id") % 5).cast("string").alias("val"),
    )
    got = agreement.mismatch_pairs(side, side, "id", LABELS).collect()
    hot = Counter(str(i % 5) for i in range(n) if i % 3 > 0)
    total = sum(hot.values())
    assert [(r.id, int(r.pairs)) for r in got] == [
        ("hot", total * total - sum(c * c for c in hot.values()))
    ]


def test_pairs_beyond_64_bits(spark):
    """Copy counts whose product passes 64 bits stay exact."""
    from pyspark.sql import functions as F

    big = 4_000_000_000
    df = spark.createDataFrame([("k", big, big)], "id string, l long, r long")
    assert df.select(F.col("l").cast(agreement.PAIRS) * F.col("r")).first()[0] == big * big


def test_comparing_a_copy_with_itself(spark):
    df = spark.createDataFrame(sorted(set(random_rows(1))), ROW).dropDuplicates(["id"])
    assert agreement.mismatch_ids(df, df, "id", LABELS).collect() == []
    hashed = hashing.hash_rows(df, ["name", "val"], ["id"])
    assert {r.status for r in agreement.classify(hashed, hashed).collect()} == {"MATCH"}


@pytest.mark.parametrize("seed", range(3))
def test_classify_and_its_symmetry(spark, seed):
    left, right = random_rows(seed, keys=12, n=15), random_rows(seed + 50, keys=12, n=15)
    frames = [
        hashing.hash_rows(spark.createDataFrame(s, ROW), ["name", "val"], ["id"]).withColumnRenamed("keys", "k")
        for s in (left, right)
    ]
    expected = {}
    for k in {r[0] for r in left + right}:
        l, r = ({x[1:] for x in side if x[0] == k} for side in (left, right))
        expected[f'"{k}"|'] = (
            "LEFT_ONLY" if not r else "RIGHT_ONLY" if not l
            else "MATCH" if len(l | r) == 1 else "VALUE_MISMATCH"
        )
    got = agreement.classify(*frames, on=["k"]).collect()
    assert {r.k: r.status for r in got} == expected
    turned = {"LEFT_ONLY": "RIGHT_ONLY", "RIGHT_ONLY": "LEFT_ONLY"}
    swapped = agreement.classify(*frames[::-1], on=["k"]).collect()
    assert {r.k: turned.get(r.status, r.status) for r in swapped} == expected


def test_null_and_missing_keys_meet(records):
    left = hashing.hash_rows(records(['{"id":null,"a":1}']), ["a"], ["id"])
    right = hashing.hash_rows(records(['{"a":2}', '{"id":"null","a":1}']), ["a"], ["id"])
    assert sorted(r.status for r in agreement.classify(left, right).collect()) == [
        "RIGHT_ONLY", "VALUE_MISMATCH",
    ]


WIDE = (
    "left_key string, left_key_hash string, left_value_hash string, "
    "right_key string, right_key_hash string, right_value_hash string"
)


def test_wide_records(spark):
    wide = spark.createDataFrame(
        [
            ("ann", "a1", "f0", "ann", "a1", "f0"),
            ("bob", "b7", "09", None, None, None),
            (None, None, None, "cyd", "c3", "77"),
            ("dan", "d9", "4e", "dan", "d9", "4f"),
        ],
        WIDE,
    )
    got = [r.status for r in agreement.classify_wide(wide).collect()]
    assert got == ["MATCH", "LEFT_ONLY", "RIGHT_ONLY", "VALUE_MISMATCH"]
    assert rows(agreement.mismatch_keys(wide)) == [("d9",)]


def test_keep_keys(spark):
    df = spark.createDataFrame(random_rows(3), ROW)
    keys = hashing.with_key_hash(df.where("id = '2'"), ["id"])
    assert rows(agreement.keep_keys(df, keys, ["id"]).select("id", "name", "val")) == rows(
        df.where("id = '2'")
    )


def test_reconcile_agrees_with_classify_on_unique_keys(spark):
    left = spark.createDataFrame([(str(k), "n", "v") for k in range(30)], ROW)
    right = spark.createDataFrame(
        [(str(k), "n", "w" if k % 7 == 0 else "v") for k in range(5, 35)], ROW
    )
    args = (["name", "val"], ["id"])
    classes = agreement.classify(*(hashing.hash_rows(s, *args) for s in (left, right)))
    nets = reconcile.reconcile(hashing.hash_both(left, right, *args))
    assert rows(classes.where("status <> 'MATCH'").select("key_hash", "status")) == rows(
        reconcile.outstanding_status(nets).select("key_hash", "status")
    )


def test_reconcile_cancels_one_for_one(spark):
    left = spark.createDataFrame([("1", "a", "x")] * 3 + [("2", "a", "x")], ROW)
    right = spark.createDataFrame([("1", "a", "x")] * 2 + [("2", "a", "y")] * 2, ROW)
    nets = reconcile.reconcile(hashing.hash_both(left, right, ["name", "val"], ["id"], 9, 8))
    assert sorted(r.net for r in nets.collect()) == [-2, 1, 1]
    got = {(r.left_left, r.right_left): r.status for r in reconcile.outstanding_status(nets).collect()}
    assert got == {(1, 0): "LEFT_ONLY", (1, 2): "VALUE_MISMATCH"}
    assert {(r.case_id, r.run_id) for r in nets.collect()} == {(9, 8)}


def test_partitioning_and_order_do_not_matter(spark):
    left, right = (spark.createDataFrame(random_rows(s), ROW) for s in (7, 8))
    once = rows(agreement.mismatch_pairs(left, right, "id", LABELS))
    again = agreement.mismatch_pairs(
        left.repartition(7).orderBy("val"), right.coalesce(1).orderBy("name"), "id", LABELS
    )
    assert rows(again) == once


def test_sides_are_checked(spark):
    df = spark.createDataFrame([("1", "a", "x")], ROW)
    with pytest.raises(ValueError):
        hashing.hash_rows(df, ["name"], ["id"], side="BOTH")
    with pytest.raises(ValueError):
        hashing.hash_rows(df, ["name"], ["id"], mode="xml")


def test_sort_partitions_orders_within_each(spark):
    df = spark.createDataFrame(random_rows(5), ROW).repartition(3)
    parts = hashing.sort_partitions(df, "id").rdd.glom().collect()
    assert all([r.id for r in p] == sorted(r.id for r in p) for p in parts)
