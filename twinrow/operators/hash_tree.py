"""Comparison by digests over ranges of hashed keys, for copies that mostly agree.

Keys are hashed to 64 bits, and the leading bits name a node of a tree. A node's
digest does not depend on the order of its rows: row counts, sums of the row prints'
parts and their exclusive or, left taken positive and right negative. It is nothing
but zeros when both sides hold the same rows there, copies included. Digests are
combined before the shuffle, so a level moves one narrow row for each node and
task, whatever the size of the tables or of a hot key.

Only the rows of nodes that differ are looked at again: a node with many rows is
split by the bits that follow, and of what is left equal records cancel one for one,
as in a reconciliation. Tables that agree end after one level and shuffle no row.

``store`` keeps the hash records of a run in folders by node, with their digests. Two
stored runs are compared by their digests first; of the records only the folders
of nodes that differ are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinrow.operators.agreement import both_sides
from twinrow.operators.reconcile import left_over
from twinrow.session import settled

#: Bits of a level; the nodes of a task's digests are at most two to this power.
BITS = 12
#: Nodes of about so many rows are not split further.
ROWS_PER_NODE = 32
#: Bits of the folders of a stored run.
FOLDER_BITS = 8

_SUMS = ["rows", "s0", "s1", "s2"]


def _spot(on: Sequence[str]) -> Column:
    return F.xxhash64(F.lit(3), *on)


def node(on: Sequence[str], bits: int) -> Column:
    """Where a key lies: the leading bits of its hash."""
    return F.shiftrightunsigned(_spot(on), 64 - bits)


def _prints(side: DataFrame, on: Sequence[str], value: str, bits: int) -> DataFrame:
    """Node, and the print of the row in parts whose sums never overflow."""
    own = F.xxhash64(*on, value)
    return side.select(
        node(on, bits).alias("node"), own.alias("x"), F.xxhash64(F.lit(1), *on, value).alias("y"),
        F.lit(1).cast("bigint").alias("rows"),
        *[(F.shiftrightunsigned(own, 21 * k).bitwiseAND(F.lit((1 << 21) - 1))).alias(f"s{k}") for k in range(3)],
    )


def digests(side: DataFrame, on: Sequence[str] = ("key_hash",), value: str = "value_hash", bits: int = BITS) -> DataFrame:
    """Digest of every node that has rows."""
    return _prints(side, on, value, bits).groupBy("node").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")
    )


def _against(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes whose digests differ, with the rows of both sides, and the rows of all nodes.

    Both frames have the columns of a digest; there may be many rows for a node.
    """
    signed = left.withColumn("both", F.col("rows")).unionByName(
        right.select("node", F.col("rows").alias("both"), *[(-F.col(c)).alias(c) for c in _SUMS], "x", "y")
    )
    nodes = signed.groupBy("node").agg(
        F.sum("both").alias("both"), *[F.sum(c).alias(c) for c in _SUMS],
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
    )
    apart = F.greatest(*[F.col(c) != 0 for c in (*_SUMS, "x", "y")])
    return nodes.select("node", F.col("both").alias("rows"), apart.alias("apart"))


def rows_in(side: DataFrame, nodes: DataFrame, on: Sequence[str], bits: int) -> DataFrame:
    """The rows of a side that lie in the nodes, filtered before anything is shuffled."""
    return side.withColumn("__node", node(on, bits)).join(
        nodes.select(F.col("node").alias("__node")), "__node", "left_semi"
    ).drop("__node")


def differing_nodes(
    left: DataFrame, right: DataFrame, on: Sequence[str] = ("key_hash",), value: str = "value_hash"
) -> tuple[DataFrame, int]:
    """Nodes that differ, as a settled table, and the bits that name them.

    Each level looks at the rows of the differing nodes of the level before.
    """
    bits, sides = BITS, (left, right)
    while True:
        level = settled(_against(*[_prints(side, on, value, bits) for side in sides]), "digests")
        seen = level.agg(
            F.coalesce(F.sum(F.when(F.col("apart"), F.col("rows"))), F.lit(0)).alias("rows"),
            F.count_if("apart").alias("nodes"),
        ).first()
        found = level.where("apart").select("node", "rows")
        crowd = seen["rows"] / max(seen["nodes"], 1) / ROWS_PER_NODE
        more = min(BITS, math.ceil(math.log2(crowd))) if crowd > 1 else 0
        if more < 1 or bits + more > 62:
            return found, bits
        sides = [rows_in(side, found, on, bits) for side in (left, right)]
        bits += more


def _cancelled(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Class of every key with records that have no equal on the other side."""
    nets = both_sides(*[side.select(*on, "value_hash") for side in (left, right)]).groupBy(
        *on, "value_hash"
    ).agg((F.sum("l") - F.sum("r")).alias("net"))
    return left_over(nets, on)


def differences(left: DataFrame, right: DataFrame, on: Sequence[str] = ("key_hash",)) -> DataFrame:
    """Class of every key whose hash records differ, with the records left on each side.

    The same rows as a reconciliation of both sides. Levels are compared when called.
    """
    nodes, bits = differing_nodes(left, right, on)
    return _cancelled(*[rows_in(side, nodes, on, bits) for side in (left, right)], on)


def store(hashed: DataFrame, path: str, on: Sequence[str] = ("key_hash",)) -> None:
    """Hash records of a run in folders by node, and the digest of every node."""
    records = hashed.select(*on, "value_hash").withColumn("node", node(on, FOLDER_BITS))
    # A node's rows are spread over as many tasks as there are, so a hot key is no task's own.
    records.write.partitionBy("node").parquet(f"{path}/records")
    kept = hashed.sparkSession.read.parquet(f"{path}/records")
    digests(kept, on, bits=FOLDER_BITS).write.parquet(f"{path}/digests")


def stored_differences(
    spark: SparkSession, left: str, right: str, on: Sequence[str] = ("key_hash",)
) -> DataFrame:
    """``differences`` of two stored runs: folders of equal nodes are not read."""
    level = _against(*[spark.read.parquet(f"{path}/digests") for path in (left, right)])
    # At most two to the power of FOLDER_BITS nodes.
    apart = [r["node"] for r in level.where("apart").select("node").collect()]
    sides = [
        spark.read.parquet(f"{path}/records").where(F.col("node").isin(apart)).select(*on, "value_hash")
        for path in (left, right)
    ]
    return _cancelled(*sides, on)
