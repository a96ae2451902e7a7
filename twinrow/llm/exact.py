"""Exact deduplication by progressive refinement.

Groups of possibly equal texts are narrowed three times: by length in bytes, by
the hash of a prefix, and by the hash of the whole text. Lengths and prefix
hashes come from one narrow pass; the whole text is hashed only for rows whose
length and prefix occur more than once. Groups are only ever counted, with
partial aggregation before the shuffle, so a group of any size is one row a task.

A null text counts as empty. Of equal texts the row with the largest id stays; a
null id is smaller than any other. Rows that repeat both id and text are one
document: all have the same answer, and ``deduplicated`` returns one of them. It
keeps columns of any name, and hashes whole texts only where length and prefix repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinrow.llm.common import bounded, settled, unused, whole

PREFIX = 64
KEY = ["n_bytes", "prefix"]


def _length(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def _prefix(text: Column) -> Column:
    """64 bits over the first characters."""
    return F.xxhash64(F.substring(text, 1, PREFIX))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(text_col)
    return docs.select(
        F.col(f"`{id_col}`").alias("id"), text.alias("t"),
        _length(text).alias("n_bytes"), _prefix(text).alias("prefix"),
    )


def crowded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs of length and prefix hash that more than one row has, as a settled table."""
    narrow = settled(_rows(docs, id_col, text_col).select(*KEY), "lengths-and-prefixes")
    lengths = narrow.groupBy("n_bytes").count().where("count > 1").select("n_bytes")
    lengths = bounded(settled(lengths, "lengths"))
    found = (
        narrow.join(lengths, "n_bytes", "left_semi")
        .groupBy(*KEY).count().where("count > 1").select(*KEY)
    )
    return settled(found, "crowded-prefixes")


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shared: DataFrame | None = None
) -> DataFrame:
    """Digest, id that stays and rows of every text that occurs more than once.

    ``twins`` is how many of the rows bear the id that stays. ``shared`` is
    ``crowded`` of the same rows, if it is there already.
    """
    shared = crowded(docs, id_col, text_col) if shared is None else shared
    # The digest stands above the join, so only rows that survive it pay for it.
    survivors = _rows(docs, id_col, text_col).join(bounded(shared), KEY, "left_semi")
    counted = (
        survivors.select("id", F.sha2(F.col("t").cast("binary"), 256).alias("digest"))
        .groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"))
    )
    found = (
        counted.groupBy("digest")
        .agg(
            F.max(F.struct("id", "n")).alias("top"),
            F.sum("n").alias("group_size"),
        )
        .where("group_size > 1")
        .select(
            F.unhex("digest").alias("digest"), F.col("top.id").alias("keep_id"),
            "group_size", F.col("top.n").alias("twins"),
        )
    )
    return settled(found, "equal-texts")


def _answer(id_: Column) -> list[Column]:
    own = F.col("group_size").isNull()
    return [
        F.when(own, id_).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(own, F.lit(1)).otherwise(F.col("group_size")).cast("bigint").alias("group_size"),
        (own | id_.eqNullSafe(F.col("keep_id"))).alias("kept"),
    ]


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: id, id that stays, rows of its group, whether it stays, digest."""
    found = groups(docs, id_col, text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.unhex(F.sha2(whole(text_col).cast("binary"), 256)).alias("digest"),
    )
    joined = rows.join(bounded(found), "digest", "left")
    return joined.select(
        F.col("id").alias(id_col), *_answer(F.col("id")),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Only rows whose length and prefix repeat are hashed whole. The others get a key
    that no digest equals, so a join by shuffle spreads them too.
    """
    shared = crowded(docs, id_col, text_col)
    found = groups(docs, id_col, text_col, shared)
    n_bytes, prefix, repeats, key, digest, keep_id, twins = unused(
        docs.columns, "n_bytes", "prefix", "repeats", "key", "digest", "keep_id", "twins"
    )
    text, id_ = whole(text_col), F.col(f"`{id_col}`")
    shared = shared.select(
        F.col("n_bytes").alias(n_bytes), F.col("prefix").alias(prefix), F.lit(True).alias(repeats)
    )
    found = found.select(
        F.col("digest").alias(digest), F.col("keep_id").alias(keep_id), F.col("twins").alias(twins)
    )
    hashed = F.when(F.col(repeats), F.unhex(F.sha2(text.cast("binary"), 256)))
    kept = (
        docs.withColumns({n_bytes: _length(text), prefix: _prefix(text)})
        .join(bounded(shared), [n_bytes, prefix], "left")
        .withColumn(key, F.coalesce(hashed, F.unhex(F.hex(prefix))))
        .join(bounded(found), F.col(key) == F.col(digest), "left")
        .where(F.col(digest).isNull() | id_.eqNullSafe(F.col(keep_id)))
    )
    if not found.where(F.col(twins) > 1).isEmpty():
        alone = F.coalesce(F.col(twins), F.lit(1)) == 1
        kept = kept.where(alone).unionByName(kept.where(~alone).dropDuplicates([key]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
