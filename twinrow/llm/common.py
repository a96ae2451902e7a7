"""Helpers the operators share: tables, bounded broadcasts, words in numpy."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from twinrow.session import settled

__all__ = [
    "BROADCAST_ROWS", "Words", "bounded", "by_bytes", "in_batches", "settled", "slices", "table", "text_bytes",
    "thinned", "unused", "whole", "words_of",
]

#: Bytes of rows sent to a Python worker at a time.
BATCH_BYTES = 4_000_000
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows of a few fixed-width columns that may be broadcast; about 16 MB.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The whole text; a missing one is empty."""
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A settled table of fixed-width rows, marked for broadcast if it is small.

    Beyond the bound Spark chooses, and shuffles if it must.
    """
    return F.broadcast(df) if df.count() <= rows else df


def thinned(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows, those whose hashed key lies in the lowest share of hashes.

    Where there are no more, all. So a following ``limit`` has little to compare.
    """
    share = min(1.0, rows / max(df.count(), 1))
    low = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << 40))
    return df.where(low < int(share * (1 << 40))) if share < 1 else df


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins; nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    if len(texts) == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(buffers[2], np.uint8)[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """The words of many texts, A-Z in lower case.

    ``data`` holds each text's words joined by single spaces, word ``i`` lies at
    ``start[i]`` to ``end[i]``, and text ``d`` has the words ``first[d]`` to
    ``first[d + 1]``.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def array(self) -> pa.Array:
        """The words as an Arrow array of bytes."""
        size = self.end - self.start
        data = self.data[self.data != 32]
        at = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        return pa.Array.from_buffers(
            pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(data)]
        )


def words_of(texts: pa.Array) -> Words:
    """Words between the white space characters space and U+0009 to U+000D."""
    raw, at = text_bytes(texts)
    n = len(raw)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(raw, none, none, np.zeros(len(at), np.int64))
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = np.zeros(n + 1, bool)
    begins[at] = True
    begins = begins[:n]
    open_ = ~blank
    open_[1:] &= blank[:-1] | begins[1:]
    starts = np.flatnonzero(open_)
    first = np.searchsorted(starts, at)
    # Of a run of white space, the character right after a word stays.
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1] & ~begins[1:]
    place = np.cumsum(keep) - 1
    data = raw[keep]
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    data[blank[keep]] = 32
    closed = ~blank
    closed[:-1] &= blank[1:] | begins[1:]
    return Words(data, place[starts], place[np.flatnonzero(closed)] + 1, first)


def in_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_BYTES``, however long the rows are.

    Spark has only a setting of the session for this. It bounds what both sides of
    the exchange hold and changes no result; a smaller one of the user stays.
    """
    conf = df.sparkSession.conf
    now = re.fullmatch(r"(-?\d+)([kmg]?)b?", conf.get(_BATCH, "64m").lower())
    held = int(now[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[now[2]] if now else -1
    if not 0 < held <= BATCH_BYTES:
        conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def by_bytes(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 1_000_000
) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about a megabyte of text, which bounds what is held.

    A row is never cut; one of more bytes is a piece of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, which bounds what is held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
