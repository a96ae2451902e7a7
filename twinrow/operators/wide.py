"""Differing fields of wide tables, by digests of field groups.

The raw values of ``GROUP`` fields make one digest, and the digests of all groups make
that of the row. Work goes down level by level: keys whose row digests differ, then,
for these keys alone, the groups whose digests differ, then the fields of those
groups. Text is made only of the fields in such groups; all else is compared as
numbers and never rendered. Wide rows are not shuffled: keys and digests are, and in
the end the texts of differing groups.

A digest is over values, so it must tell apart whatever renders differently: each
value comes with whether it is null, and a zero with its sign. Columns at the same
position whose types differ between the sides are compared by their rendering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinrow.functions import render
from twinrow.operators.diff import FIELDS, KEYS, check_fields, differing_keys
from twinrow.operators.key_filter import MOST_KEYS, _words, key_bits, may_hold
from twinrow.session import settled

GROUP = 16


def _kinds(df: DataFrame, fields: Sequence[str]) -> list[T.DataType]:
    if render.is_records(df):
        return [T.VariantType()] * len(fields)
    return [df.select(df[f"`{name}`"]).schema[0].dataType for name in fields]


def _value(name: str, text: Column, kind: T.DataType, raw: bool) -> list[Column]:
    """What of a field goes into a digest."""
    own = F.col(f"`{name}`")
    if not raw or isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return [text]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # Hashes of both zeros are the same.
        return [own.isNull(), own, F.when(own == 0, F.atan2(own.cast("double"), F.lit(-1.0)))]
    return [own.isNull(), own]


class _Side:
    """One table with what the levels need of it."""

    def __init__(self, df: DataFrame, fields: Sequence[str], key_fields: Sequence[str], raw: Sequence[bool]):
        self.df, self.fields, self.key_fields = df, list(fields), key_fields
        self.texts = render.field_texts(df, fields)
        self.keys = F.coalesce(render.render_json(render.field_texts(df, key_fields)), F.lit("")).alias("keys")
        values = [_value(n, t, k, r) for n, t, k, r in zip(fields, self.texts, _kinds(df, fields), raw)]
        self.groups = [
            F.xxhash64(F.lit(at), *[c for own in values[at : at + GROUP] for c in own])
            for at in range(0, len(values), GROUP)
        ]

    def rows(self) -> DataFrame:
        """Key and row digest."""
        digest = F.hex(F.xxhash64(*self.groups))
        again = F.hex(F.xxhash64(F.lit(1), *self.groups))
        return self.df.select(
            self.keys, F.concat(digest, F.lit("-"), again).alias("text"), F.lit(1).cast("bigint").alias("n")
        )

    def digests(self, only) -> DataFrame:
        """Key and group digests of some keys."""
        return only(self.df.select(self.keys, F.array(*self.groups).alias("digests")))

    def parts(self, only, apart: DataFrame) -> DataFrame:
        """Key, its text, and the rendered fields of the groups in ``apart``, others null."""
        wide = only(self.df.select(self.keys, *[F.col(f"`{c}`") for c in self._needed()]))
        taken = wide.join(apart, "keys")
        texts = [
            F.when(F.array_contains("groups", at // GROUP), F.array(*self.texts[at : at + GROUP])).alias(f"g{at // GROUP}")
            for at in range(0, len(self.texts), GROUP)
        ]
        return taken.select("keys", render.key_text(self.df, self.key_fields).alias("key"), *texts)

    def _needed(self) -> list[str]:
        if render.is_records(self.df):
            return [render.VALUE, render.VARIANT]
        return [c for c in dict.fromkeys([*self.fields, *self.key_fields]) if c != "keys"]


def _only(keys: DataFrame):
    """Rows of some keys: a filter at the scan where the keys are few enough, then the join."""
    n = keys.count()
    words = _words(n)
    bits = settled(key_bits(keys, "keys", words), "key-bits") if n <= MOST_KEYS else None

    def keep(rows: DataFrame) -> DataFrame:
        near = rows.where(may_hold(bits.scalar(), "keys", words)) if bits is not None else rows
        return near.join(keys, "keys", "left_semi")

    return keep


def differing_parts(
    left: DataFrame, right: DataFrame, left_fields: Sequence[str], key_fields: Sequence[str],
    right_fields: Sequence[str] | None = None, right_key_fields: Sequence[str] | None = None,
) -> list[DataFrame]:
    """Of both sides, the rows of keys that differ, with the texts of differing groups.

    The levels above are compared when called. Fails, with their number, if keys repeat
    on both sides with differing rows.
    """
    right_fields = list(right_fields or left_fields)
    right_key_fields = list(right_key_fields or key_fields)
    check_fields(left_fields, right_fields)
    for df, own_keys in ((left, key_fields), (right, right_key_fields)):
        if "keys" in df.columns and "keys" not in own_keys:
            raise ValueError("a column named keys stands for the rendered key here")
    records = render.is_records(left) or render.is_records(right)
    raw = [False] * len(left_fields) if records else [
        a == b for a, b in zip(_kinds(left, left_fields), _kinds(right, right_fields))
    ]
    sides = [_Side(left, left_fields, key_fields, raw), _Side(right, right_fields, right_key_fields, raw)]
    found = settled(differing_keys(*[s.rows() for s in sides], ["keys"]), "differing-keys")
    if many := found.where("left_rows > 1 and right_rows > 1").count():
        raise ValueError(f"{many} keys repeat on both sides; use diff_report for them")
    only = _only(found.select("keys"))
    a, b = (s.digests(only).withColumnRenamed("digests", n) for s, n in zip(sides, ("a", "b")))
    apart = F.filter(
        F.transform(F.arrays_zip("a", "b"), lambda p, i: F.when(p["a"] != p["b"], i)), lambda i: i.isNotNull()
    )
    # A key may have several rows on one side; its groups are those of any pair.
    groups = settled(
        a.join(b, "keys").select("keys", F.explode(apart).alias("group"))
        .groupBy("keys").agg(F.collect_set("group").alias("groups")),
        "differing-groups",
    )
    return [s.parts(only, groups) for s in sides]


def wide_diff(
    left: DataFrame, right: DataFrame, left_fields: Sequence[str], key_fields: Sequence[str],
    right_fields: Sequence[str] | None = None, right_key_fields: Sequence[str] | None = None,
) -> DataFrame:
    """One row for each differing field of each pair of rows with equal keys."""
    right_fields = list(right_fields or left_fields)
    parts = differing_parts(left, right, left_fields, key_fields, right_fields, right_key_fields)
    names = [c for c in parts[0].columns if c.startswith("g")]
    l, r = (
        p.select("keys", F.col("key").alias(k), F.struct(*names).alias(n))
        for p, k, n in zip(parts, KEYS, ("l", "r"))
    )
    fields = F.array(*[F.struct(F.lit(a).alias("left_field"), F.lit(b).alias("right_field"))
                       for a, b in zip(left_fields, right_fields)])

    def group(at: int, name: str) -> Column:
        both = F.arrays_zip(
            F.slice(fields, at * GROUP + 1, GROUP).alias("f"), F.col(f"l.{name}").alias("a"), F.col(f"r.{name}").alias("b")
        )
        told = F.transform(F.filter(both, lambda p: p["a"] != p["b"]), lambda p: F.struct(
            p["f"]["left_field"].alias("left_field"), p["a"].alias("left_value"),
            p["f"]["right_field"].alias("right_field"), p["b"].alias("right_value"),
        ))
        return F.when(F.col(f"l.{name}").isNotNull() & F.col(f"r.{name}").isNotNull(), told)

    every = F.flatten(F.filter(F.array(*[group(i, n) for i, n in enumerate(names)]), lambda g: g.isNotNull()))
    return l.join(r, "keys").select(*KEYS, F.explode(every).alias("d")).select(*KEYS, *[f"d.{c}" for c in FIELDS])
