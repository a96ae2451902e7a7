"""Shards of nearly equal bytes that are contiguous runs of whole groups.

Equal texts form a group, and a group never spans shards. Groups are ordered by
their smallest id (then by digest), and the shards are the contiguous partition
whose largest shard is as small as can be: the smallest capacity is found by
binary search, each capacity checked greedily, and the groups are cut there.

Running sums of the group sizes lie in a table, sorted and cut into buckets. The
driver holds one line per bucket and fetches the sums of a bucket, a bounded
number, only when a cut falls into it. So neither the groups nor their sums pass
through the driver, and no task sees more than its range.

A null text has no bytes and equals the empty one. Every row has the size of its
text in UTF-8 plus 1. Rows within a shard are numbered without gaps in the order
of group and id. If one group alone holds more than its share, the shard that
holds it is the largest, and the following shards may be empty.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinrow.llm.common import bounded, settled, whole

#: Running sums in a bucket, which is what the driver fetches at a time.
BUCKET = 65_536
LAW = "bytes"


def smallest_capacity(
    total: int, largest: int, shards: int, reach: Callable[[int], int]
) -> tuple[int, list[int]]:
    """The smallest capacity under which ``shards`` runs hold all, and its cuts.

    ``reach(x)`` is the largest running sum that is not above ``x``.
    """

    def cuts(capacity: int) -> list[int] | None:
        at, found = 0, []
        for _ in range(shards):
            at = reach(at + capacity)
            found.append(at)
            if at >= total:
                return found + [total] * (shards - len(found))
        return None

    low, high = max(largest, -(-total // shards)), max(total, largest)
    # Below the mean plus one group, greedy shards could not all be too full.
    high = min(high, low + largest)
    while low < high:
        middle = (low + high) // 2
        if cuts(middle) is None:
            low = middle + 1
        else:
            high = middle
    return low, cuts(low) or [0] * shards


def running(df: DataFrame, order: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """Running sums, each row's own included, in an order over all rows.

    Rows are dealt by range and summed within their range; the sums of the
    ranges before it, one line a range, are added as constants.
    """
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = settled(
        df.repartitionByRange(int(parts), *order).withColumn("part", F.spark_partition_id()),
        f"{name}-dealt",
    )
    totals = (
        dealt.groupBy("part").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
        .orderBy("part").collect()
    )
    before = {k: 0 for k in sums}
    offsets = []
    for row in totals:
        offsets.append((row["part"], *before.values()))
        before = {k: before[k] + (row[k] or 0) for k in sums}
    schema = "part int, " + ", ".join(f"before_{k} bigint" for k in sums)
    starts = df.sparkSession.createDataFrame(offsets, schema)
    own = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({k: F.sum(c).over(own) for k, c in sums.items()})
    return (
        local.join(F.broadcast(starts), "part")
        .withColumns({k: F.col(k) + F.col(f"before_{k}") for k in sums})
        .drop("part", *[f"before_{k}" for k in sums])
    )


class _Sums:
    """Looks running sums up in a sorted table by fetching the bucket they lie in."""

    def __init__(self, sums: DataFrame):
        self.sums = sums
        ends = sums.groupBy("bucket").agg(F.max("reach").alias("end")).orderBy("bucket")
        self.ends = [row["end"] for row in ends.collect()]
        self.held: dict[int, np.ndarray] = {}

    def reach(self, x: int) -> int:
        at = bisect_right(self.ends, x)
        below = self.ends[at - 1] if at else 0
        if at == len(self.ends):
            return below
        if at not in self.held:
            rows = self.sums.where(F.col("bucket") == at).select("reach").toArrow()
            self.held[at] = np.sort(rows["reach"].to_numpy())
        held = self.held[at]
        inside = int(np.searchsorted(held, x, side="right"))
        return int(held[inside - 1]) if inside else below


def sharded(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shard and slot of every row; law ``bytes``."""
    if shards < 1:
        raise ValueError(f"shards must be positive: {shards}")
    text = whole(text_col)
    rows = settled(
        docs.select(
            F.col(f"`{id_col}`").cast("bigint").alias("id"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("digest").agg(
        F.min("id").alias("first"),
        F.sum("size").alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
    )
    order = ["first", "digest"]
    ranked = settled(
        running(
            groups, order,
            {"reach": F.col("bytes"), "place": F.lit(1).cast("bigint"), "row_end": F.col("rows")},
            "shard-groups",
        ).withColumn("bucket", ((F.col("place") - 1) / BUCKET).cast("bigint")),
        "shard-sums",
    )
    head = ranked.agg(F.sum("bytes").alias("total"), F.max("bytes").alias("largest")).first()
    total, largest = head["total"] or 0, head["largest"] or 0
    _, cuts = smallest_capacity(total, largest, shards, _Sums(ranked).reach)

    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard = shard + F.when(F.col("reach") > cut, 1).otherwise(0)
    begins = {
        row["shard"]: row["start"]
        for row in ranked.groupBy(shard.alias("shard"))
        .agg(F.min(F.col("row_end") - F.col("rows")).alias("start")).collect()
    }
    start = F.element_at(F.array(*[F.lit(begins.get(i, 0)) for i in range(shards)]),
                         F.col("shard") + 1)
    # Reach is a group's rank; within a group rows are ranked by id. Ranges over
    # both split a group of any size, which a window by group would not.
    placed = settled(ranked.select("digest", "reach", shard.cast("int").alias("shard")),
                     "shard-placed")
    ordered = running(
        rows.join(placed, "digest")
        .select("reach", "shard", "id", "size", "text_crc32"),
        ["reach", "id"], {"nth": F.lit(1).cast("bigint")}, "shard-rows-in-order",
    )
    return ordered.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("nth") - 1 - start).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
