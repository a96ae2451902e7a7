"""Topics of JSON records.

The connector is a separate package of Spark and has to be on the class path.
Decoding and encoding are plain functions of Kafka-shaped frames, so they serve
any source with binary ``key`` and ``value`` and a ``timestamp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinrow.functions.render import parse_record

# The property names of an encoded hash record.
HASH_PROPERTIES = {
    "case_id": "testCaseId",
    "run_id": "testCaseRunId",
    "side": "comparisonSide",
    "keys": "keys",
    "key_hash": "keyHash",
    "value_hash": "valueHash",
}


def decode_json(messages: DataFrame, envelope: bool = False, strict: bool = True) -> DataFrame:
    """Record text, its parsed form and its time, from Kafka-shaped messages.

    With ``envelope`` the record is an object of the message key and value.
    Malformed records fail the job. Without ``strict`` they are kept, with
    ``malformed`` set, and render as their whole text, so that they agree only with
    a record of the same text. ``split_malformed`` takes them out.
    """
    text = F.col("value").cast("string")
    if envelope:
        key = F.col("key").cast("string")
        text = F.concat(
            F.lit("{"),
            F.concat_ws(
                ",", F.concat(F.lit('"key":'), key), F.concat(F.lit('"value":'), text)
            ),
            F.lit("}"),
        )
    records = messages.select(text.alias("value"), F.col("timestamp").alias("ts")).withColumn(
        "v", parse_record("value", strict)
    )
    if strict:
        return records
    return records.withColumn("malformed", F.col("v").isNull())


def split_malformed(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records that are JSON, and the text and time of those that are not."""
    return (
        records.where("not malformed").drop("malformed"),
        records.where("malformed").drop("malformed", "v"),
    )


def read_json_topic(
    spark: SparkSession, servers: str, topic: str, envelope: bool = False,
    strict: bool = True, **options: str,
) -> DataFrame:
    """Stream of the records of a topic, from its earliest offset."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
    return decode_json(messages, envelope, strict)


def encode_hashes(hashed: DataFrame) -> DataFrame:
    """Hash records as JSON text in column ``value``."""
    return encode_json(
        hashed.select(
            *[F.col(c).alias(p) for c, p in HASH_PROPERTIES.items() if c in hashed.columns]
        )
    )


def encode_json(df: DataFrame) -> DataFrame:
    """Each row as a JSON object in column ``value``; nulls are written out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_json_topic(
    encoded: DataFrame, servers: str, topic: str, checkpoint: str,
    mode: str = "append", **options: str,
) -> StreamingQuery:
    """Send a stream of encoded records to a topic."""
    return (
        encoded.writeStream.format("kafka")
        .outputMode(mode)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .start()
    )
