"""Which keys agree: comparison of two sides key by key.

Every operator here is an aggregation over the union of both sides, tagged by
side, rather than a join. A key's rows collapse to a few numbers before the
shuffle, so a key that holds a third of all rows costs one small row per task,
where a join would pair its rows up many to many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinrow.functions import render
from twinrow.operators.hashing import with_key_hash
from twinrow.session import settled

MATCH = "MATCH"
VALUE_MISMATCH = "VALUE_MISMATCH"
LEFT_ONLY = "LEFT_ONLY"
RIGHT_ONLY = "RIGHT_ONLY"

# Pairs of a key with n rows a side number n * n, which can pass 64 bits.
PAIRS = "decimal(38,0)"


def both_sides(left: DataFrame, right: DataFrame, n: str | None = None) -> DataFrame:
    """Union of both sides, with their copies (one, or column ``n``) in ``l`` or ``r``."""
    own = F.col(n) if n else F.lit(1).cast("bigint")
    none = F.lit(0).cast("bigint")
    return left.withColumns({"l": own, "r": none}).unionByName(
        right.withColumns({"l": none, "r": own})
    )


def fingerprint(text: str) -> list[Column]:
    """Two 64-bit hashes, ``a`` and ``b``, that stand in for a text.

    Together they are as wide as an MD5. Unlike text they have a fixed width, so
    an aggregation can keep their extremes in place and needs no sort.
    """
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")]


def tally(
    left: DataFrame, right: DataFrame, on: Sequence[str], text: str, n: str | None = None
) -> DataFrame:
    """Rows of each side per key, and whether all rows of the key agree.

    Rows agree when their ``text``, a rendering or its digest, is the same. A row
    stands for one record, or for as many as column ``n`` says.
    """
    seen = both_sides(
        *[
            side.select(*on, *fingerprint(text), *([n] if n else []))
            for side in (left, right)
        ],
        n=n,
    )
    agree = (F.min("a") == F.max("a")) & (F.min("b") == F.max("b"))
    return seen.groupBy(*on).agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        agree.alias("agree"),
    )


def status(left_rows: str, right_rows: str, agree: Column) -> Column:
    """Class of a key from its row counts and its agreement."""
    return (
        F.when(F.col(right_rows) == 0, F.lit(LEFT_ONLY))
        .when(F.col(left_rows) == 0, F.lit(RIGHT_ONLY))
        .when(agree, F.lit(MATCH))
        .otherwise(F.lit(VALUE_MISMATCH))
    )


def classify(
    left: DataFrame, right: DataFrame, on: Sequence[str] = ("key_hash",)
) -> DataFrame:
    """Class of every key of two hash record frames, with rows per side.

    A key whose rows do not all carry the same value is a ``VALUE_MISMATCH``:
    some left row of it differs from some right row.
    """
    return tally(left, right, on, "value_hash").select(
        *on, "left_rows", "right_rows",
        status("left_rows", "right_rows", F.col("agree")).alias("status"),
    )


def classify_wide(wide: DataFrame) -> DataFrame:
    """Class of ready-made wide hash records, whose halves may be null."""
    return wide.withColumn(
        "status",
        F.when(F.col("right_key_hash").isNull(), F.lit(LEFT_ONLY))
        .when(F.col("left_key_hash").isNull(), F.lit(RIGHT_ONLY))
        .when(F.col("left_value_hash") == F.col("right_value_hash"), F.lit(MATCH))
        .otherwise(F.lit(VALUE_MISMATCH)),
    )


def mismatch_keys(wide: DataFrame) -> DataFrame:
    """Key hashes present on both sides of a wide table with different values."""
    return wide.where(
        "left_key_hash = right_key_hash and left_value_hash <> right_value_hash"
    ).select(F.col("left_key_hash").alias("key_hash")).distinct()


def _labelled(df: DataFrame, key: str, labels: dict[str, str]) -> DataFrame:
    text = render.render_labelled({label: f"`{c}`" for label, c in labels.items()})
    return df.select(F.col(f"`{key}`").alias("id"), text.alias("text"))


def mismatch_ids(
    left: DataFrame, right: DataFrame, key: str, labels: dict[str, str]
) -> DataFrame:
    """Ids that both tables hold and whose rendered rows differ, with row counts.

    ``labels`` maps the label in the rendered row to its column.
    """
    found = tally(_labelled(left, key, labels), _labelled(right, key, labels), ["id"], "text")
    return found.where("left_rows > 0 and right_rows > 0 and not agree").select(
        "id", "left_rows", "right_rows"
    )


def mismatch_pairs(
    left: DataFrame, right: DataFrame, key: str, labels: dict[str, str]
) -> DataFrame:
    """Like ``mismatch_ids``, with the number of differing row pairs per id.

    Rows with equal ids pair up many to many. The pairs are counted from the
    copies of each row and never formed.
    """
    sides = [
        _labelled(side, key, labels).select("id", *fingerprint("text"))
        for side in (left, right)
    ]
    copies = (
        both_sides(*sides)
        .groupBy("id", "a", "b")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    equal = F.sum(F.when((F.col("l") > 0) & (F.col("r") > 0), F.col("l").cast(PAIRS) * F.col("r")))
    totals = copies.groupBy("id").agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        F.coalesce(equal, F.lit(0)).cast(PAIRS).alias("equal"),
    )
    pairs = (F.col("left_rows").cast(PAIRS) * F.col("right_rows")).cast(PAIRS) - F.col("equal")
    return totals.select("id", pairs.cast(PAIRS).alias("pairs")).where("pairs > 0")


def keep_keys(df: DataFrame, keys: DataFrame, key_fields: Sequence[str]) -> DataFrame:
    """Records whose key hash is in ``keys.key_hash``, which is written when called.

    A semi-join with a table of known size: Spark broadcasts the keys when that
    allows it and otherwise shuffles, splitting a hot key of the records.
    """
    hashed = df if "key_hash" in df.columns else with_key_hash(df, key_fields)
    return hashed.join(settled(keys.select("key_hash"), "kept-keys"), "key_hash", "left_semi")
