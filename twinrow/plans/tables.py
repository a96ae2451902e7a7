"""The given tables as the two sides of a comparison.

The second copy of ``orders`` is the first with faults of every kind, chosen by
content: lost rows, changed prices, changed names, doubled rows and added ids.
Records of ``events`` are JSON text, as a topic would carry them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinrow.functions.render import field_texts
from twinrow.sources.topics import decode_json

ID_FIELDS = ["id", "name", "val"]
LABELS = {"Id": "id", "Name": "name", "Val": "val"}
EVENT_FIELDS = ["event_id", "user_id", "event_type", "value", "props", "note"]


def path_of(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(path_of(folder, name))


def _price(column: Column) -> Column:
    return column.cast("decimal(18,2)").cast("string")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as rows of id, name and value, all text."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("name"),
        _price(F.col("o_totalprice")).alias("val"),
    )


LOST = "o_orderstatus = 'P' and o_totalprice >= 495000"
ADDED = "o_orderstatus = 'O' and o_totalprice >= 490000"
DOUBLED = "o_orderpriority in ('1-URGENT', '5-LOW') and o_totalprice < 12000"
PRICED = "o_orderpriority in ('2-HIGH', '5-LOW') and o_totalprice < 10000"
RENAMED = "o_orderpriority = '4-NOT SPECIFIED' and o_totalprice < 20000"


def _faulty(df: DataFrame) -> tuple[Column, Column, Column]:
    key = F.col("o_orderkey").cast("string")
    name = F.when(F.expr(RENAMED), F.lit("UNKNOWN")).otherwise(F.col("o_orderpriority"))
    price = F.col("o_totalprice") + F.when(F.expr(PRICED), F.lit(1.0)).otherwise(F.lit(0.0))
    return key, name, _price(price)


def orders_copy(spark: SparkSession, folder: str) -> DataFrame:
    """The faulty copy, from one scan."""
    df = table(spark, folder, "orders")
    key, name, val = _faulty(df)
    ids = F.array(
        F.when(~F.expr(LOST), key),
        F.when(F.expr(DOUBLED), key),
        F.when(F.expr(ADDED), F.concat(F.lit("+"), key)),
    )
    return df.select(F.explode(ids).alias("id"), name.alias("name"), val.alias("val")).where(
        "id is not null"
    )


NEARLY = "o_totalprice between 250000 and 250500"


def orders_nearly(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as rows of id, name and value, about one in a thousand with another name."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.expr(NEARLY), F.lit("OTHER")).otherwise(F.col("o_orderpriority")).alias("name"),
        _price(F.col("o_totalprice")).alias("val"),
    )


WIDE_FIELDS = [f"c{k}" for k in range(200)]


def orders_of_many_columns(spark: SparkSession, folder: str, faulty: bool = False) -> DataFrame:
    """Orders with two hundred columns made of their own; the faulty copy has another
    value in one column of about a row in a thousand."""
    df = table(spark, folder, "orders")
    wrong = F.expr(NEARLY) if faulty else F.lit(False)
    columns = []
    for k, name in enumerate(WIDE_FIELDS):
        own, other = (
            (F.col("o_custkey") + k, F.lit(-1).cast("bigint")) if k % 2 == 0
            else (F.concat("o_orderpriority", F.lit(f"#{k}")), F.lit("OTHER"))
        )
        columns.append(F.when(wrong & (F.col("o_custkey") % 200 == k), other).otherwise(own).alias(name))
    return df.select("o_orderkey", *columns)


def orders_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Wide hash records of each order and its faulty form; lost ones lack the right half."""
    df = table(spark, folder, "orders")
    key, name, val = _faulty(df)
    bar = F.lit("|")
    halves = {
        "left": (key, F.col("o_orderpriority"), _price(F.col("o_totalprice"))),
        "right": (F.when(~F.expr(LOST), key), name, val),
    }
    columns = []
    for side, (k, n, v) in halves.items():
        columns += [
            k.alias(f"{side}_key"),
            F.md5(F.concat(k, bar)).alias(f"{side}_key_hash"),
            F.md5(F.concat(k, bar, n, bar, v, bar)).alias(f"{side}_value_hash"),
        ]
    return df.select(*columns)


def orders_matched(spark: SparkSession, folder: str) -> DataFrame:
    """Each order next to its faulty form, both rendered; lost ones left out."""
    df = table(spark, folder, "orders").where(f"not ({LOST})")
    key, name, val = _faulty(df)
    sides = df.select(
        key.alias("left_key"), key.alias("right_key"),
        F.col("o_orderpriority").alias("name"), _price(F.col("o_totalprice")).alias("val"),
        name.alias("label"), val.alias("amount"),
    )
    return sides.select(
        "left_key", "right_key",
        F.array(*field_texts(sides, ["name", "val"])).alias("left_texts"),
        F.array(*field_texts(sides, ["label", "amount"])).alias("right_texts"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Topic-shaped messages of events; the props stay a nested object."""
    text = F.format_string(
        '{"event_id":%d,"user_id":%d,"event_type":"%s","value":%s,"props":%s}',
        "event_id", "user_id", "event_type", F.col("value").cast("string"), "props",
    )
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def event_records(
    spark: SparkSession, folder: str, event_type: str | None = None
) -> DataFrame:
    """Events, or those of one type, as JSON records."""
    events = table(spark, folder, "events")
    if event_type:
        events = events.where(F.col("event_type") == event_type)
    return decode_json(event_messages(events))


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their label, if any, and their text, blank in some of them.

    Which are blank depends on their length. Each language has spaces of its own
    kind, so the two blank rules differ.
    """
    kinds = {"fr": "\u2003", "de": "\u0001", "es": "\u00a0"}
    space = F.lit(" ")
    for lang, mark in kinds.items():
        space = F.when(F.col("lang") == lang, F.lit(mark)).otherwise(space)
    body = F.when(F.col("n_chars") % 7 == 0, F.repeat(space, 3)).otherwise(F.col("text"))
    return (
        table(spark, folder, "documents")
        .join(table(spark, folder, "labels"), "doc_id", "left")
        .select(
            "doc_id", "lang", F.col("quality").cast("string").alias("quality"),
            body.alias("body"),
        )
    )


def text_lines(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [table(spark, folder, name).select(F.col("text").alias("value")) for name in names]
