import datetime
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from twinrow.functions import render
from twinrow.operators import agreement, hashing
from twinrow.sources import topics

MESSAGE = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
AT = datetime.datetime(2024, 1, 1)


def messages(spark, *pairs):
    return spark.createDataFrame(
        [(k and k.encode(), v.encode(), "t", 0, i, AT) for i, (k, v) in enumerate(pairs)], MESSAGE
    )


def test_decode(spark):
    got = topics.decode_json(messages(spark, (None, '{"id":1}')))
    assert got.columns == ["value", "ts", "v"]
    assert got.select("value", "ts").first() == ('{"id":1}', AT)


def test_envelope_holds_key_and_value(spark):
    df = messages(spark, ("7", '{"id": 1.0}'), (None, '"x"'))
    got = topics.decode_json(df, envelope=True)
    assert rows(got.select("value", render.json_field("key"), render.json_field("value"))) == [
        ('{"key":7,"value":{"id": 1.0}}', "7", '{"id":1.0}'), ('{"value":"x"}', "null", '"x"'),
    ]
    # Fields of the payload are not fields of the envelope.
    hashed = hashing.hash_rows(got, ["id", "name", "val"], ["id"], mode="text")
    assert {r.value_hash for r in hashed.collect()} == {"2edf2958166561c5c08cd228e53bbcdc"}


def test_malformed_fails_or_is_marked(spark):
    df = messages(spark, (None, '{"id":1}'), (None, "{"), (None, '{"a":1,"a":2}'))
    with pytest.raises(Exception, match="MALFORMED|DUPLICATE"):
        topics.decode_json(df).select("v").collect()
    marked = topics.decode_json(df, strict=False)
    assert rows(marked.select("value", "malformed")) == [
        ('{"a":1,"a":2}', True), ('{"id":1}', False), ("{", True),
    ]


def test_malformed_records_agree_only_by_their_text(spark):
    left = messages(spark, (None, "{bad left"), (None, "{same"), (None, '{"id":1,"name":"a"}'))
    right = messages(spark, (None, "{bad right"), (None, "{same"), (None, '{"id":1,"name":"a"}'))
    sides = [topics.decode_json(s, strict=False) for s in (left, right)]
    hashed = [hashing.hash_rows(s, ["id", "name"], ["id"]) for s in sides]
    assert sorted(r.status for r in agreement.classify(*hashed).collect()) == [
        "LEFT_ONLY", "MATCH", "MATCH", "RIGHT_ONLY",
    ]
    good, bad = topics.split_malformed(sides[0])
    assert (good.count(), rows(bad.select("value"))) == (1, [("{bad left",), ("{same",)])
    texts = [hashing.hash_rows(s, ["id"], ["id"], mode="text") for s in sides]
    assert len({r.value_hash for t in texts for r in t.collect()}) == 4


def test_encode(spark):
    records = topics.decode_json(messages(spark, (None, '{"id":1,"name":"a","val":"x"}')))
    tagged = hashing.hash_rows(records, ["id", "name", "val"], ["id"], "LEFT", 1, 2)
    assert json.loads(topics.encode_hashes(tagged).first().value) == {
        "testCaseId": 1, "testCaseRunId": 2, "comparisonSide": "LEFT", "keys": "1|",
        "keyHash": "77529b68d130d125ff07a534a7b69adb",
        "valueHash": "aef608f99d76f759f6af08a47b2b1e7e",
    }
    plain = hashing.hash_rows(records, ["id"], ["id"])
    assert list(json.loads(topics.encode_hashes(plain).first().value)) == [
        "keys", "keyHash", "valueHash",
    ]
    nulls = spark.createDataFrame([(1, None)], "a int, b string")
    assert topics.encode_json(nulls).first().value == '{"a":1,"b":null}'


def test_topic_needs_its_connector(spark):
    try:
        stream = topics.read_json_topic(spark, "host:9092", "t")
    except Exception as error:
        assert "kafka" in str(error).lower()
    else:
        assert stream.isStreaming and stream.columns == ["value", "ts", "v"]


def test_raised_errors_name_no_record_twice(spark):
    df = messages(spark, (None, '{"id":1}')).withColumn("value", F.lit(None).cast("binary"))
    assert topics.decode_json(df, strict=False).first().malformed
