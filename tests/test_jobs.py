import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_files import put

from twinrow.operators import reconcile
from twinrow.plans import jobs
from twinrow.sources import topics
from twinrow.streaming import running


def lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def test_compare_csv(spark, folder):
    left = put(folder, "l", "1,a,x\n2,b,y\n3,c,z\n3,c,z\n5,,\n")
    right = put(folder, "r", "1,a,x\n2,b,Y\n3,c,Z\n4,d,w\n5,,\n")
    jobs.compare_csv(spark, left, right, f"{folder}/out")
    assert lines(spark, f"{folder}/out") == ["2", "3"]
    jobs.compare_csv(spark, left, right, f"{folder}/pairs", count_pairs=True)
    assert lines(spark, f"{folder}/pairs") == ["(2,1)", "(3,2)"]


def test_compare_csv_prints(spark, folder, capsys):
    path = put(folder, "l", "1,a,x\n")
    jobs.compare_csv(spark, path, put(folder, "r", "1,a,y\n"))
    assert "|1  |" in capsys.readouterr().out


def test_clean_rows(spark, folder):
    path = put(folder, "in", "1,a,x\n2,,y\n3, ,\n4,\u0001,z\n")
    assert jobs.clean_rows(spark, path, f"{folder}/out") == {"kept": 2, "blanks": [0, 2, 1]}
    assert lines(spark, f"{folder}/out") == ["(1,a,x)", "(4,\u0001,z)"]


def test_clean_triples(spark, folder, capsys):
    path = put(folder, "in", "a;b;c\nd;\u0001;f\n;;\ng; ;i\n")
    expected = {"kept": 2, "blanks": [1, 2, 1]}
    assert jobs.clean_triples(spark, path, f"{folder}/out") == expected
    assert lines(spark, f"{folder}/out") == ["a,b,c", "g, ,i"]
    assert jobs.clean_triples(spark, spark.createDataFrame([("a", "b", None)], "f0 string, f1 string, f2 string")) == {
        "kept": 0, "blanks": [0, 0, 1]
    }


def test_count_words(spark, folder):
    paths = [put(folder, "a", "One two\nTwo\n"), put(folder, "b", "two--one three\n")]
    jobs.count_words(spark, paths, f"{folder}/out")
    assert lines(spark, f"{folder}/out") == ["one 2", "three 1", "two 3"]


@pytest.fixture
def broker(spark, folder, monkeypatch):
    """Topics as folders of message files, in place of the connector."""

    def send(topic, *values):
        df = spark.createDataFrame([(v.encode(), s) for v, s in values], "value binary, s long")
        df.select(
            F.lit(None).cast("binary").alias("key"), "value",
            F.timestamp_seconds(F.col("s")).alias("timestamp"),
        ).coalesce(1).write.mode("append").parquet(f"{folder}/{topic}")

    def read(spark, servers, topic, envelope=False, strict=True, **options):
        schema = "key binary, value binary, timestamp timestamp"
        return topics.decode_json(
            spark.readStream.schema(schema).parquet(f"{folder}/{topic}"), envelope, strict
        )

    def write(encoded, servers, topic, checkpoint, mode="append", **options):
        return (
            encoded.writeStream.format("text").outputMode(mode)
            .option("checkpointLocation", checkpoint).start(f"{folder}/{topic}")
        )

    monkeypatch.setattr(topics, "read_json_topic", read)
    monkeypatch.setattr(topics, "write_json_topic", write)
    return send


def settle(*queries):
    for query in queries:
        query.processAllAvailable()
        query.stop()


def test_hash_topic(spark, folder, broker):
    broker("in", ('{"id":1,"name":"a","val":"x"}', 0))
    for mode in ("json", "text"):
        settle(jobs.hash_topic(spark, "host", "in", f"out-{mode}", f"{folder}/check-{mode}", mode))
    got = json.loads(lines(spark, f"{folder}/out-json")[0])
    assert got["valueHash"] == "aef608f99d76f759f6af08a47b2b1e7e"
    assert json.loads(lines(spark, f"{folder}/out-text")[0])["keys"] == "id|null|name|a|val|x|"


def test_hash_topic_with_bad_records_and_envelope(spark, folder, broker):
    broker("bad", ('{"id":1}', 0), ("{", 0))
    settle(jobs.hash_topic(spark, "host", "bad", "out-bad", f"{folder}/check-bad", strict=False))
    assert [json.loads(x)["keys"] for x in lines(spark, f"{folder}/out-bad")] == ["1|", "malformed:{|"]
    broker("env", ('{"id":1}', 0))
    settle(jobs.hash_topic(spark, "host", "env", "out-env", f"{folder}/check-env", envelope=True,
                           fields=["value"], key_fields=["value"]))
    assert json.loads(lines(spark, f"{folder}/out-env")[0])["keys"] == '{"id":1}|'


def test_reconcile_topics(spark, folder, broker):
    broker("l", ('{"id":1,"name":"a","val":"x"}', 0), ('{"id":2,"name":"a","val":"x"}', 0))
    broker("r", ('{"id":1,"name":"a","val":"x"}', 0), ('{"id":2,"name":"a","val":"y"}', 0))
    settle(*jobs.reconcile_topics(
        spark, "host", "l", "r", "out", f"{folder}/nets", f"{folder}/check"))
    assert len(lines(spark, f"{folder}/out")) == 4
    left = reconcile.outstanding_status(running.reconciled(spark, f"{folder}/nets"))
    assert [r.status for r in left.collect()] == ["VALUE_MISMATCH"]


def test_report_topics(spark, folder, broker):
    broker("l", ('{"id":1,"name":"a","val":"x"}', 1), ('{"id":0}', 1000))
    broker("r", ('{"id":1,"name":"b","val":"y"}', 2), ('{"id":0}', 1000))
    settle(jobs.report_topics(spark, "host", "l", "r", f"{folder}/rep", f"{folder}/check"))
    got = running.window_report(spark, f"{folder}/rep")
    assert rows(got.select("left_key", "left_field", "left_value", "right_value")) == [
        ("1", "name", '"a"', None), ("1", "name", None, '"b"'),
        ("1", "val", '"x"', None), ("1", "val", None, '"y"'),
    ]
