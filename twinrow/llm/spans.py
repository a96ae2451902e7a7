"""Spans of texts as arrays of structs, and digests of them.

A span is a kind, a start and an end, counted in code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinrow.llm.common import by_bytes, in_batches

Span = tuple[str, int, int]
SPAN_TYPE = "array<struct<kind string, start bigint, end bigint, base boolean>>"
_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
)


def scanned(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str]], list[list[tuple[str, int, int, bool]]]]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id and ``spans`` of every row. ``make`` builds the finder once a task; the
    finder takes a few megabytes of texts at a time."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make()
        for batch in by_bytes(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [
                [dict(zip(("kind", "start", "end", "base"), s)) for s in own]
                for own in find(texts)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, _ARROW)], ["id", "spans"]
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return in_batches(rows, scan, f"id {kind}, spans {SPAN_TYPE}").select(
        F.col("id").alias(id_col), "spans"
    )


def joined(spans: Column, kinds: Sequence[str], by_start: bool) -> Column:
    """``kind:start:end`` of the spans, joined by commas, in order of kind as listed
    and start, or of start and kind."""
    rank = F.array(*[F.lit(k) for k in kinds])

    def keyed(s: Column) -> Column:
        order = [F.array_position(rank, s["kind"]), s["start"]]
        if by_start:
            order.reverse()
        text = F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.struct(order[0].alias("a"), order[1].alias("b"), s["end"].alias("c"), text.alias("t"))

    return F.array_join(F.transform(F.array_sort(F.transform(spans, keyed)), lambda s: s["t"]), ",")


def digests(
    df: DataFrame, base: Sequence[str], more: Sequence[str], by_start: bool, id_col: str = "doc_id"
) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans joined."""
    own = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        of_kind = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(of_kind).cast("bigint").alias(f"n_{kind}")

    return df.select(
        id_col,
        *[count(k) for k in base],
        F.sha2(joined(own, base, by_start).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans"), [*base, *more], by_start).alias("spans"),
    )
