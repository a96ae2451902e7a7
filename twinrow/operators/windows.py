"""Records of two sides that meet inside one tumbling window of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinrow.functions.render import VARIANT, is_records
from twinrow.operators.agreement import both_sides
from twinrow.operators.diff import check_fields, diff_keyed, keyed
from twinrow.operators.hashing import with_key_hash
from twinrow.session import settled

WIDTH = "30 seconds"
GROUP = ["window_start", "key_hash"]


def record(df: DataFrame) -> Column:
    """All columns of a row, without the parsed form of a JSON record."""
    drop = VARIANT if is_records(df) else None
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c != drop])


def _in_window(
    df: DataFrame, key_fields: Sequence[str], ts: str, width: str, delay: str | None, name: str
) -> DataFrame:
    if df.isStreaming:
        if delay is None:
            raise ValueError("a stream needs a watermark delay, or its state never expires")
        df = df.withWatermark(ts, delay)
    own = record(df).alias(name)
    return with_key_hash(df, key_fields).select("key_hash", F.window(ts, width).alias("w"), own)


def window_join(
    left: DataFrame,
    right: DataFrame,
    key_fields: Sequence[str],
    ts: str = "ts",
    width: str = WIDTH,
    delay: str | None = None,
    right_key_fields: Sequence[str] | None = None,
    salts: int = 1,
) -> DataFrame:
    """Pairs of records with equal keys in the same window, on batches or streams.

    Windows follow the time column, so results can be repeated. On streams
    ``delay`` says how late a record may come. A batch join on a hot key is
    split by adaptive execution; for a stream, which has none, ``salts`` spreads
    the left records of each key and window over that many tasks.
    """
    l = _in_window(left, key_fields, ts, width, delay, "left")
    r = _in_window(right, right_key_fields or key_fields, ts, width, delay, "right")
    on = ["key_hash", "w"]
    if salts > 1:
        l = l.withColumn("salt", F.pmod(F.xxhash64("left"), F.lit(salts)))
        r = r.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
        on.append("salt")
    return l.join(r, on).select(F.col("w.start").alias("window_start"), "key_hash", "left", "right")


def window_diff(
    left: DataFrame,
    right: DataFrame,
    left_fields: Sequence[str],
    key_fields: Sequence[str],
    ts: str = "ts",
    width: str = WIDTH,
    right_fields: Sequence[str] | None = None,
    right_key_fields: Sequence[str] | None = None,
) -> DataFrame:
    """Differing fields of records that meet in a window, without forming pairs
    for keys that are crowded within it."""
    right_fields = right_fields or left_fields
    right_key_fields = right_key_fields or key_fields
    check_fields(left_fields, right_fields)
    start = F.window(ts, width)["start"].alias("window_start")
    return diff_keyed(
        keyed(left, left_fields, key_fields, keep=[start]),
        keyed(right, right_fields, right_key_fields, keep=[start]),
        left_fields, right_fields, key_fields, right_key_fields,
        on=["window_start", "keys"],
        keep=["window_start"],
    )


def window_matches(
    left: DataFrame,
    right: DataFrame,
    key_fields: Sequence[str],
    ts: str = "ts",
    width: str = WIDTH,
    right_key_fields: Sequence[str] | None = None,
) -> DataFrame:
    """Records that meet a partner in their window, with the rows of both sides.

    This is the window join before its pairs are multiplied out: each record
    appears once, and the pairs of a window and key are all its left records
    with all its right ones. Which windows and keys meet is found when called.
    """
    sides = [
        with_key_hash(side, keys).select(
            F.window(ts, width)["start"].alias("window_start"), "key_hash",
            F.lit(tag).alias("side"),
            record(side).alias("record"),
        )
        for tag, side, keys in (
            ("LEFT", left, key_fields), ("RIGHT", right, right_key_fields or key_fields),
        )
    ]
    counts = both_sides(*[side.select(*GROUP) for side in sides]).groupBy(*GROUP).agg(
        F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows")
    )
    met = settled(counts.where("left_rows > 0 and right_rows > 0"), "met-keys")
    return sides[0].unionByName(sides[1]).join(met, GROUP)


def window_pairs(matches: DataFrame) -> DataFrame:
    """The pairs behind ``window_matches``, told record by record.

    Each record is a row of its own with the other half left null. ``left_rows``
    and ``right_rows`` say how many records it speaks for: itself, and all the
    records of the other side that it meets.
    """
    one = F.lit(1).cast("bigint")
    lone = F.col("side") == "LEFT"
    return matches.select(
        *GROUP,
        F.when(lone, F.col("record")).alias("left"),
        F.when(~lone, F.col("record")).alias("right"),
        F.when(lone, one).otherwise(F.col("left_rows")).alias("left_rows"),
        F.when(lone, F.col("right_rows")).otherwise(one).alias("right_rows"),
    )
