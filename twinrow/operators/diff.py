"""Which fields of which records differ.

A report row names a key, a field and the two values. Fields of the two sides
are paired by position, so their names may differ. Values are in the ``json``
rendering, so text shows its quotes.

The work has two phases. The first ships only hashes and finds the keys whose
rows differ, with their rows on both sides; it is written to the shared folder,
so that the second can plan with its true size. The second goes back to the rows
of those keys alone, once a side.

``diff_report`` has one form for every key, linear in its records: a row for each
value of a field that differs from some row of the other side, the other value
left null. ``left_rows`` and ``right_rows`` say how many rows it speaks for: its
own copies, and the rows of the other side whose value is another. Their product
is the number of record pairs, told once from the left values and once from the
right ones.

``diff_pairs`` has the other form, which the caller must choose: one row for each
pair of records and differing field. A key that repeats on both sides would
multiply, so it fails if there is one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinrow.functions import render
from twinrow.operators.agreement import both_sides, tally
from twinrow.session import settled

KEYS = ["left_key", "right_key"]
FIELDS = ["left_field", "left_value", "right_field", "right_value"]
ROWS = ["left_rows", "right_rows"]
REPORT = [*KEYS, *FIELDS, *ROWS]


def check_fields(left_fields: Sequence[str], right_fields: Sequence[str]) -> None:
    """Fields pair up by position, so both lists must be equally long."""
    if not left_fields or len(left_fields) != len(right_fields):
        raise ValueError(
            f"field lists must be non-empty and equally long: "
            f"{len(left_fields)} and {len(right_fields)}"
        )


def keyed(
    df: DataFrame,
    fields: Sequence[str],
    key_fields: Sequence[str],
    keep: Sequence[str | Column] = (),
) -> DataFrame:
    """Records with their rendered key, without columns the comparison does not need."""
    if render.is_records(df):
        columns = [render.VALUE, render.VARIANT]
    else:
        columns = list(dict.fromkeys([*fields, *key_fields]))
    keys = render.render_json(render.field_texts(df, key_fields))
    # A rendering is never null; saying so spares a join on it the test.
    return df.select(
        *keep, F.coalesce(keys, F.lit("")).alias("keys"), *[f"`{c}`" for c in columns]
    )


def rendered(
    df: DataFrame, fields: Sequence[str], key_fields: Sequence[str], on: Sequence[str]
) -> DataFrame:
    """Key text for display, rendered fields as an array, and a count of one copy."""
    return df.select(
        *on,
        render.key_text(df, key_fields).alias("key"),
        F.array(*render.field_texts(df, fields)).alias("texts"),
        F.lit(1).cast("bigint").alias("n"),
    )


def _differences(
    left_fields: Sequence[str], right_fields: Sequence[str], left: str, right: str
) -> Column:
    """Array of the fields whose texts differ, null where they agree."""
    return F.array(
        *[
            F.when(
                F.col(left)[i] != F.col(right)[i],
                F.struct(
                    F.lit(lf).alias("left_field"), F.col(left)[i].alias("left_value"),
                    F.lit(rf).alias("right_field"), F.col(right)[i].alias("right_value"),
                ),
            )
            for i, (lf, rf) in enumerate(zip(left_fields, right_fields))
        ]
    )


def field_diff(
    pairs: DataFrame,
    left_fields: Sequence[str],
    right_fields: Sequence[str],
    left: str = "left_texts",
    right: str = "right_texts",
    keep: Sequence[str] = ("left_key", "right_key"),
) -> DataFrame:
    """One row per differing field of matched records.

    ``left`` and ``right`` are arrays of rendered fields. Records equal as a
    whole are dropped before their fields are looked at.
    """
    check_fields(left_fields, right_fields)
    return (
        pairs.where(F.col(left) != F.col(right))
        .select(*keep, F.explode(_differences(left_fields, right_fields, left, right)).alias("d"))
        .where("d is not null")
        .select(*keep, "d.*")
    )


def _pairs(
    left: DataFrame, right: DataFrame, on: Sequence[str],
    left_fields: Sequence[str], right_fields: Sequence[str], keep: Sequence[str],
) -> DataFrame:
    """One row a pair and differing field."""
    pairs = left.drop(*ROWS, "n").withColumnsRenamed(
        {"key": "left_key", "texts": "left_texts"}
    ).join(
        right.drop(*ROWS, "n").withColumnsRenamed({"key": "right_key", "texts": "right_texts"}),
        list(on),
    )
    return field_diff(pairs, left_fields, right_fields, keep=[*keep, *KEYS])


def _values(
    left: DataFrame, right: DataFrame, on: Sequence[str],
    left_fields: Sequence[str], right_fields: Sequence[str], keep: Sequence[str],
) -> DataFrame:
    """One row a value that differs from some row of the other side."""
    values = both_sides(
        *[
            side.select(*on, "key", *ROWS, F.posexplode("texts").alias("at", "text"), "n")
            for side in (left, right)
        ],
        n="n",
    )
    # Dealt by value as well as key, so that the values of a hot key spread, and
    # so that the join below may be split without breaking this aggregation.
    counts = (
        values.repartition(*on, "at", "text")
        .groupBy(*on, "key", *ROWS, "at", "text")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    left_name = F.array(*[F.lit(f) for f in left_fields])[F.col("at")]
    right_name = F.array(*[F.lit(f) for f in right_fields])[F.col("at")]

    def told(own: Column, other: Column, side: str) -> Column:
        values = [F.col("text"), F.lit(None).cast("string")]
        rows = [own, other]
        if side == "right":
            values.reverse()
            rows.reverse()
        return F.when(
            (own > 0) & (other > 0),
            F.struct(
                left_name.alias("left_field"), values[0].alias("left_value"),
                right_name.alias("right_field"), values[1].alias("right_value"),
                rows[0].alias("left_rows"), rows[1].alias("right_rows"),
            ),
        )

    both = F.array(
        told(F.col("l"), F.col("right_rows") - F.col("r"), "left"),
        told(F.col("r"), F.col("left_rows") - F.col("l"), "right"),
    )
    return (
        counts.select(
            *keep, F.col("key").alias("left_key"), F.col("key").alias("right_key"),
            F.explode(both).alias("d"),
        )
        .where("d is not null")
        .select(*keep, *KEYS, "d.*")
    )


def differing_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Phase one: keys that both sides hold with differing rows, and how many rows.

    The sides have a rendering ``text`` and stand for ``n`` records a row.
    """
    return (
        tally(left, right, on, "text", "n")
        .where("left_rows > 0 and right_rows > 0 and not agree")
        .select(*on, *ROWS)
    )


def diff_rendered(
    left: DataFrame,
    right: DataFrame,
    left_fields: Sequence[str],
    right_fields: Sequence[str],
    on: Sequence[str] = ("keys",),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Report over frames made by ``rendered``. Runs phase one when called."""
    check_fields(left_fields, right_fields)
    sides = (left, right)
    texts = [
        side.select(*on, F.concat_ws("|", "texts").alias("text"), "n") for side in sides
    ]
    found = settled(differing_keys(*texts, on), "differing-keys")
    rows = [side.join(found, list(on)) for side in sides]
    return _values(*rows, on, left_fields, right_fields, keep)


def _rows_of_differing_keys(
    sides: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]], on: Sequence[str], pairs: bool
) -> list[DataFrame]:
    """Phase one now, then the rendered rows of the keys it finds.

    Fields are rendered for display only in rows whose key differs. JSON text is
    parsed again there, which costs less than moving its parsed form along.
    """
    texts = [
        df.select(
            *on,
            render.render_json(render.field_texts(df, fields)).alias("text"),
            F.lit(1).cast("bigint").alias("n"),
        )
        for df, fields, _ in sides
    ]
    found = settled(differing_keys(*texts, on), "differing-keys")
    if pairs and (many := found.where("left_rows > 1 and right_rows > 1").count()):
        raise ValueError(f"{many} keys repeat on both sides; use diff_report for them")
    kept = []
    for df, fields, key_fields in sides:
        records = render.is_records(df)
        rows = (df.drop(render.VARIANT) if records else df).join(found, list(on))
        if records:
            rows = rows.withColumn(render.VARIANT, render.parse_record())
        kept.append(rendered(rows, fields, key_fields, [*on, *ROWS]))
    return kept


def diff_keyed(
    left: DataFrame,
    right: DataFrame,
    left_fields: Sequence[str],
    right_fields: Sequence[str],
    left_key_fields: Sequence[str],
    right_key_fields: Sequence[str],
    on: Sequence[str] = ("keys",),
    keep: Sequence[str] = (),
    pairs: bool = False,
) -> DataFrame:
    """Report over frames made by ``keyed``. Runs phase one when called."""
    check_fields(left_fields, right_fields)
    sides = ((left, left_fields, left_key_fields), (right, right_fields, right_key_fields))
    rows = _rows_of_differing_keys(sides, on, pairs)
    return (_pairs if pairs else _values)(*rows, on, left_fields, right_fields, keep)


def diff_report(
    left: DataFrame,
    right: DataFrame,
    left_fields: Sequence[str],
    key_fields: Sequence[str],
    right_fields: Sequence[str] | None = None,
    right_key_fields: Sequence[str] | None = None,
) -> DataFrame:
    """Differing fields of all keys that both sides hold."""
    right_fields = right_fields or left_fields
    right_key_fields = right_key_fields or key_fields
    check_fields(left_fields, right_fields)
    return diff_keyed(
        keyed(left, left_fields, key_fields),
        keyed(right, right_fields, right_key_fields),
        left_fields, right_fields, key_fields, right_key_fields,
    )


def diff_pairs(
    left: DataFrame,
    right: DataFrame,
    left_fields: Sequence[str],
    key_fields: Sequence[str],
    right_fields: Sequence[str] | None = None,
    right_key_fields: Sequence[str] | None = None,
) -> DataFrame:
    """Differing fields of every pair of records with equal keys.

    Fails, with their number, if keys repeat on both sides with differing rows.
    """
    right_fields = right_fields or left_fields
    right_key_fields = right_key_fields or key_fields
    check_fields(left_fields, right_fields)
    return diff_keyed(
        keyed(left, left_fields, key_fields),
        keyed(right, right_fields, right_key_fields),
        left_fields, right_fields, key_fields, right_key_fields, pairs=True,
    )
