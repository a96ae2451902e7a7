"""Keeping the rows of a key set, most others dropped before the shuffle.

The key set becomes an array of bits, of a size that follows from its count: each key
sets ``PROBES`` of them, by hashes of its own. It is built by aggregation and reaches
the scan as a constant, as a scalar subquery. A row whose bits are not all set cannot
be of the set and is dropped where it is read; about one in a hundred of the others
passes by chance, and the exact semi-join that follows takes these out. Beyond
``MOST_KEYS`` the array would be too large for every task, and the semi-join works alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinrow.operators.hashing import with_key_hash
from twinrow.session import settled

#: Keys of the largest filter, whose array is 16 MB.
MOST_KEYS = 8_000_000
BITS_A_KEY = 10
PROBES = 5


def _words(keys: int) -> int:
    """Words of 64 bits for so many keys, a power of two."""
    return 1 << max(0, (keys * BITS_A_KEY // 64).bit_length())


def _places(key: str, words: int) -> list[tuple[Column, Column]]:
    """Word and bit of each probe."""
    found = []
    for probe in range(PROBES):
        spot = F.xxhash64(F.lit(probe), key)
        word = F.shiftrightunsigned(spot, 6).bitwiseAND(F.lit(words - 1)).cast("int")
        found.append((word, spot.bitwiseAND(F.lit(63)).cast("int")))
    return found


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def key_bits(keys: DataFrame, key: str = "key_hash", words: int | None = None) -> DataFrame:
    """One row, ``bits``: the bit array of a key set."""
    words = words or _words(keys.count())
    probes = F.explode(F.array(*[F.struct(w.alias("word"), _one(b).alias("bit")) for w, b in _places(key, words)]))
    filled = keys.select(probes.alias("p")).groupBy("p.word").agg(F.bit_or("p.bit").alias("bits"))
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("word"))
    dense = every.join(filled, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return dense.agg(F.transform(in_order, lambda s: s["bits"]).alias("bits"))


def may_hold(bits: Column, key: str, words: int) -> Column:
    """Whether all bits of a key are set."""
    return reduce(
        lambda a, b: a & b,
        [F.get(bits, word).bitwiseAND(_one(bit)) != 0 for word, bit in _places(key, words)],
    )


def keep_keys_filtered(df: DataFrame, keys: DataFrame, key_fields: Sequence[str]) -> DataFrame:
    """The rows whose key hash is in ``keys.key_hash``, as ``keep_keys`` gives them.

    The keys are written and counted when called.
    """
    hashed = df if "key_hash" in df.columns else with_key_hash(df, key_fields)
    wanted = settled(keys.select("key_hash").distinct(), "kept-keys")
    n = wanted.count()
    if n <= MOST_KEYS:
        words = _words(n)
        bits = settled(key_bits(wanted, words=words), "key-bits")
        hashed = hashed.where(may_hold(bits.scalar(), "key_hash", words))
    return hashed.join(wanted, "key_hash", "left_semi")
