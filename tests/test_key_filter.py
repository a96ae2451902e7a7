from conftest import rows
from pyspark.sql import functions as F

from twinrow.operators import key_filter
from twinrow.operators.agreement import keep_keys


def hashed(spark, n, start=0):
    return spark.range(start, start + n).select(F.md5(F.col("id").cast("string")).alias("key_hash"), "id")


def test_rows_equal_the_plain_semi_join(spark, monkeypatch):
    left, keys = hashed(spark, 500), hashed(spark, 200, 400)
    want = rows(keep_keys(left, keys, []))
    assert len(want) == 100
    assert rows(key_filter.keep_keys_filtered(left, keys, [])) == want
    assert key_filter.keep_keys_filtered(left, keys.limit(0), []).count() == 0
    assert key_filter.keep_keys_filtered(left, keys.unionByName(keys), []).count() == 100
    monkeypatch.setattr(key_filter, "MOST_KEYS", 10)
    assert rows(key_filter.keep_keys_filtered(left, keys, [])) == want


def test_little_passes_where_a_hundredth_matches(spark):
    left, keys = hashed(spark, 40_000), hashed(spark, 400, 39_600)
    words = key_filter._words(400)
    bits = key_filter.key_bits(keys, words=words)
    assert len(bits.first()["bits"]) == words
    passed = left.where(key_filter.may_hold(bits.scalar(), "key_hash", words))
    assert 400 <= passed.count() < 0.05 * 40_000
    assert passed.where("id >= 39600").count() == 400


def test_null_keys_are_kept_by_neither(spark):
    frame = spark.createDataFrame([("a",), (None,)], "key_hash string")
    assert rows(key_filter.keep_keys_filtered(frame, frame, [])) == [("a",)]


def test_the_filter_stands_at_the_scan(spark, folder):
    hashed(spark, 1000).write.parquet(f"{folder}/t")
    left = spark.read.parquet(f"{folder}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = key_filter.keep_keys_filtered(left, hashed(spark, 10), [])
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join, rest = plan.split("Join LeftSemi", 1)
    assert "scalar-subquery" in rest and rest.index("scalar-subquery") < rest.index("Relation")
