"""Hash records: the narrow rows a comparison ships instead of whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinrow.functions import render

LEFT = "LEFT"
RIGHT = "RIGHT"


def _renderings(
    df: DataFrame, fields: Sequence[str], key_fields: Sequence[str], mode: str
) -> tuple[Column, Column]:
    if mode == "json":
        keys = render.render_json(render.field_texts(df, key_fields))
        return keys, render.render_json(render.field_texts(df, fields))
    if mode == "text":
        # The key form of this rendering has always covered all fields.
        return render.render_text(fields, key=True), render.render_text(fields)
    if mode == "labelled":
        keys = F.concat_ws(
            "|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null")) for k in key_fields]
        )
        return keys, render.render_labelled({f[:1].upper() + f[1:]: f"`{f}`" for f in fields})
    raise ValueError(f"unknown rendering: {mode!r}")


def hash_rows(
    df: DataFrame,
    fields: Sequence[str],
    key_fields: Sequence[str],
    side: str | None = None,
    case_id: int | None = None,
    run_id: int | None = None,
    mode: str = "json",
) -> DataFrame:
    """Key text, key hash and value hash of every row, tagged if asked.

    ``df`` is a JSON record frame (text ``value``, variant ``v``) or, for the
    ``json`` and ``labelled`` renderings, a plain table. Works on streams.
    """
    if side not in (None, LEFT, RIGHT):
        raise ValueError(f"side must be {LEFT} or {RIGHT}: {side!r}")
    keys, values = _renderings(df, fields, key_fields, mode)
    hashed = df.select(keys.alias("keys"), render.digest(values).alias("value_hash"))
    tags = []
    if side is not None:
        tags = [
            F.lit(case_id).cast("bigint").alias("case_id"),
            F.lit(run_id).cast("bigint").alias("run_id"),
            F.lit(side).alias("side"),
        ]
    return hashed.select(
        *tags, "keys", render.digest(F.col("keys")).alias("key_hash"), "value_hash"
    )


def hash_both(
    left: DataFrame,
    right: DataFrame,
    fields: Sequence[str],
    key_fields: Sequence[str],
    case_id: int = 1,
    run_id: int = 1,
    right_fields: Sequence[str] | None = None,
    right_key_fields: Sequence[str] | None = None,
) -> DataFrame:
    """Tagged hash records of both sides in one frame or stream."""
    return hash_rows(left, fields, key_fields, LEFT, case_id, run_id).unionByName(
        hash_rows(
            right, right_fields or fields, right_key_fields or key_fields,
            RIGHT, case_id, run_id,
        )
    )


def with_key_hash(
    df: DataFrame, key_fields: Sequence[str], name: str = "key_hash"
) -> DataFrame:
    """Keep the record and add the hash of its key fields."""
    keys = render.render_json(render.field_texts(df, key_fields))
    return df.withColumn(name, render.digest(keys))


def sort_partitions(df: DataFrame, key: str) -> DataFrame:
    """Order rows by key inside each partition, without moving any."""
    return df.sortWithinPartitions(key)
