"""Alignment of two tokenizers over the same texts, each distinct text handled once.

**Distinct texts.** Rows are shuffled by their full text and become one row a text
with its number of documents; copies collapse before the shuffle. Only these texts
are tokenised, by a byte-level BPE (A) over a space and the text, and by a
SentencePiece model (B) over the text, to which it adds the space itself.

**Alignment.** Every token covers bytes. Offsets at which a token of either side ends
cut both into groups. All pairs of an A and a B token in a group are links; a text
keeps each distinct pair of ids with the number of its links. Pairs are formed in
blocks of ``LINKS``; a group of more goes through distinct ids.

**Counts.** A pair's count is the number of documents that hold it: distinct texts
weighted by their number of documents, added up within a task before the shuffle.
Up to ``PAIRS`` distinct pairs the counts are sent to all tasks, which look their
pairs up; beyond that the same numbers come from a join by shuffle. The measures
of a text go back to its documents by the digest of the text.

Null and empty texts have no tokens, and neither has a text whose tokens do not
spell it (such as one with U+2581): zeros, and an empty ``groups_sha256``. A null id
takes part, repeated rows count as documents each.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.llm import pieces
from twinrow.llm.common import bounded, by_bytes, in_batches, settled, text_bytes, whole

#: Distinct pairs whose counts are sent to all tasks; twelve bytes each.
PAIRS = 2_000_000
#: Links formed at a time.
LINKS = 1_000_000
#: Distinct pairs a task adds up before it gives them on.
HELD = 500_000
#: A pair of ids in one number: the A id times this plus the B id.
WIDE = 1 << 16

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@dataclass
class Tokens:
    """Bytes of all token ids of one tokenizer, one after another."""

    data: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(surfaces: list[bytes]) -> Tokens:
        at = np.zeros(len(surfaces) + 1, np.int64)
        np.cumsum([len(s) for s in surfaces], out=at[1:])
        return Tokens(np.frombuffer(b"".join(surfaces), np.uint8), at)

    def spelt(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids in order, and how many each has."""
        begin = self.at[ids]
        size = self.at[ids + 1] - begin
        return pieces._gather(self.data, begin, size), size


class Tokenizers:
    """Both tokenizers, built once a task."""

    def __init__(self, ranks_path: str, model: pieces.Model):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            pairs = [line.split() for line in lines]
        ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        # The vocabulary as ranks gives the same ids, and whole texts in linear time.
        self.bytes_bpe = tiktoken.Encoding(
            "byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        surfaces = [b""] * (max(ranks.values()) + 1)
        for surface, i in ranks.items():
            surfaces[i] = surface
        self.a = Tokens.of(surfaces)
        self.encoder = pieces.Encoder(model)
        self.b = Tokens(model.surface, model.surface_at)

    def encode(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of all texts, flat, and how many each has, for A and for B."""
        own = [self.bytes_bpe.encode_ordinary(" " + t) for t in texts.to_pylist()]
        size = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter((i for ids in own for i in ids), np.int64, int(size.sum()))
        b_flat, b_size = self.encoder.encode(texts)
        return [(flat, size), (b_flat.astype(np.int64), b_size)]


def _spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each with a space before it, and how many each has."""
    raw, at = text_bytes(texts)
    n = len(at) - 1
    out = np.full(len(raw) + n, 32, np.uint8)
    keep = np.ones(len(out), bool)
    keep[at[:-1] + np.arange(n)] = False
    out[keep] = raw
    return out, np.diff(at) + 1


def _part(ids: np.ndarray, size: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[np.repeat(keep, size)], size[keep]


def _agree(data: np.ndarray, size: np.ndarray, own: np.ndarray, own_size: np.ndarray) -> np.ndarray:
    """Which texts have exactly these bytes."""
    same = size == own_size
    both = (data[np.repeat(same, size)], own[np.repeat(same, own_size)])
    at = np.cumsum(size[same])
    wrong = np.searchsorted(at, np.flatnonzero(both[0] != both[1]), side="right")
    same[np.flatnonzero(same)[wrong]] = False
    return same


@dataclass
class Aligned:
    """Texts with their tokens and groups; groups are numbered through all texts."""

    ids: list[np.ndarray]  # Of A and B, flat.
    group: list[np.ndarray]  # Group of every token.
    size: list[np.ndarray]  # Tokens of every text.
    text: np.ndarray  # Text of every group.


def aligned(data_size: np.ndarray, sides: list, widths: list[np.ndarray]) -> Aligned:
    """Groups of texts whose tokens spell them."""
    ends = [np.cumsum(w) for w in widths]
    total = int(data_size.sum())
    marks = [np.zeros(total + 1, bool) for _ in ends]
    for mark, end in zip(marks, ends):
        mark[end] = True
    common = marks[0] & marks[1]
    # The group of a token that ends at e: the common ends before e.
    before = np.cumsum(common) - common
    group = [before[end] for end in ends]
    text_end = np.cumsum(data_size)
    text = np.searchsorted(text_end, np.flatnonzero(common), side="left")
    return Aligned([ids for ids, _ in sides], group, [size for _, size in sides], text)


def _blocks(found: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, pair of ids and links of that pair, in blocks; pairs may repeat."""
    groups = len(found.text)
    n = [np.bincount(g, minlength=groups) for g in found.group]
    start = [np.cumsum(c) - c for c in n]
    links = n[0] * n[1]
    for g in np.flatnonzero(links > LINKS):
        # Equal ids of a long group have the same links, so distinct ones are paired.
        (a, ca), (b, cb) = (
            np.unique(ids[s[g] : s[g] + c[g]], return_counts=True)
            for ids, s, c in zip(found.ids, start, n)
        )
        step = max(1, LINKS // len(b))
        for lo in range(0, len(a), step):
            part, times = a[lo : lo + step], ca[lo : lo + step]
            pair = (part[:, None] * WIDE + b[None, :]).ravel()
            yield np.full(len(pair), found.text[g]), pair, (times[:, None] * cb[None, :]).ravel()
    links = np.where(links > LINKS, 0, links)
    reach = np.cumsum(links)
    lo = 0
    while lo < groups:
        base = reach[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(reach, base + LINKS, side="right")))
        own = np.repeat(np.arange(lo, hi), np.where(links[lo:hi] > 0, n[0][lo:hi], 0))
        a_at = _ranges(start[0][lo:hi], np.where(links[lo:hi] > 0, n[0][lo:hi], 0))
        times = n[1][own]
        b_at = _ranges(start[1][own], times)
        pair = np.repeat(found.ids[0][a_at], times) * WIDE + found.ids[1][b_at]
        yield np.repeat(found.text[own], times), pair, np.ones(len(pair), np.int64)
        lo = hi


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each size, one after another."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def pairs_of(found: Aligned, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of every text in order of text: where they begin, pairs, links."""
    parts = [(t, p, k) for t, p, k in _blocks(found) if len(p)]
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(texts + 1, np.int64), none, none
    text, pair, links = map(np.concatenate, zip(*[_summed(*part) for part in parts]))
    if len(parts) > 1:
        text, pair, links = _summed(text, pair, links)
    return np.searchsorted(text, np.arange(texts + 1)), pair, links


def _summed(text: np.ndarray, pair: np.ndarray, links: np.ndarray):
    """Each pair of a text once, its links added up."""
    order = np.lexsort((pair, text))
    text, pair, links = text[order], pair[order], links[order]
    first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])])
    return text[first], pair[first], np.add.reduceat(links, first)


_DIGITS = Tokens.of([b"%d," % i for i in range(WIDE)])


def group_digests(found: Aligned, texts: int) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` of every text; empty without tokens."""
    ids = np.concatenate(found.ids)
    group = np.concatenate(found.group)
    side = np.repeat([0, 1], [len(i) for i in found.ids])
    # Both sides are in order, so a stable sort by group keeps A before B and each in order.
    order = np.argsort(group, kind="stable")
    ids, group, side = ids[order], group[order], side[order]
    data, size = _DIGITS.spelt(ids)
    data = data.copy()
    ends = np.cumsum(size)
    if len(ids):
        new = group[1:] != group[:-1]
        turn = ~new & (side[1:] != side[:-1])
        data[ends[:-1][new] - 1] = ord(";")
        data[ends[:-1][turn] - 1] = ord("|")
    tokens = found.size[0] + found.size[1]
    last = np.cumsum(tokens)
    at = np.r_[0, ends][np.r_[0, last]]
    raw = memoryview(np.ascontiguousarray(data))
    return [
        hashlib.sha256(raw[a : b - 1]).hexdigest() if n else ""
        for a, b, n in zip(at.tolist(), at[1:].tolist(), tokens.tolist())
    ]


def texts_aligned(tokenizers: Tokenizers, texts: pa.Array) -> dict[str, pa.Array]:
    """Measures, digest of the groups, pairs and links of each pair, of every text."""
    data, data_size = _spaced(texts)
    sides = tokenizers.encode(texts)
    good = data_size > 1
    for (ids, size), tokens in zip(sides, (tokenizers.a, tokenizers.b)):
        own, width = tokens.spelt(ids)
        text = np.repeat(np.arange(len(size)), size)
        own_size = np.bincount(text, weights=width, minlength=len(size)).astype(np.int64)
        good &= _agree(data, data_size, own, own_size)
    kept = [_part(ids, size, good) for ids, size in sides]
    widths = [t.spelt(ids)[1] for (ids, _), t in zip(kept, (tokenizers.a, tokenizers.b))]
    found = aligned(data_size[good], kept, widths)
    n = int(good.sum())
    groups = np.bincount(found.text, minlength=n)
    at, pair, links = pairs_of(found, n)
    total = np.diff(np.r_[0, np.cumsum(links)][at])

    def spread(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(good), np.int64)
        out[good] = values
        return out

    digests = np.full(len(good), "", object)
    digests[good] = group_digests(found, n)
    offsets = np.r_[0, np.cumsum(spread(np.diff(at)))].astype(np.int32)
    return {
        "n_a": pa.array(spread(kept[0][1])), "n_b": pa.array(spread(kept[1][1])),
        "n_groups": pa.array(spread(groups)), "n_links": pa.array(spread(total)),
        "groups_sha256": pa.array(digests, pa.string()),
        "pairs": pa.ListArray.from_arrays(pa.array(offsets), pa.array(pair, pa.int64())),
        "links": pa.ListArray.from_arrays(pa.array(offsets), pa.array(links, pa.int32())),
    }


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of every pair, added up within the task."""

    def given(pair, n):
        return pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    fresh = 0
    for batch in batches:
        # Pairs of a text are distinct, so each counts once for each of its documents.
        lists = batch.column("pairs")
        pair = lists.flatten().to_numpy()
        size = np.diff(lists.offsets.to_numpy())
        waiting.append((pair, np.repeat(batch.column("copies").to_numpy(), size)))
        fresh += len(pair)
        if fresh > 2 * HELD:
            held, waiting, fresh = _added([held, *waiting]), [], 0
            if len(held[0]) > HELD:
                yield given(*held)
                held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield given(*_added([held, *waiting]))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pair, n = (np.concatenate(x) for x in zip(*parts))
    if not len(pair):
        return pair, n
    order = np.argsort(pair, kind="stable")
    pair, n = pair[order], n[order]
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    return pair[first], np.add.reduceat(n, first)


def _measured_by_lookup(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """Links that are the best of their A id, and the sum of counts, by lookup."""
    table = counts.toArrow()
    pair, n = table["pair"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    a = pair // WIDE
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    most = np.repeat(np.maximum.reduceat(n, first), np.diff(np.r_[first, len(a)])) if len(a) else n
    shared = texts.sparkSession.sparkContext.broadcast((pair, n, n == most))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            at = lists.offsets.to_numpy().astype(np.int64)
            links = batch.column("links").flatten().to_numpy().astype(np.int64)
            spot = np.searchsorted(known, lists.flatten().to_numpy())
            sums = [np.diff(np.r_[0, np.cumsum(x)][at - at[0]]) for x in (links * best[spot], links * count[spot])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), *[pa.array(s, pa.int64()) for s in sums]],
                ["digest", "n_best", "count_sum"],
            )

    some = texts.where(F.size("pairs") > 0).select("digest", "pairs", "links")
    return in_batches(some, look, "digest binary, n_best bigint, count_sum bigint")


def _measured_by_join(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join of every text's pairs with the counts."""
    a = F.floor(F.col("pair") / WIDE)
    most = settled(counts.groupBy(a.alias("a")).agg(F.max("n").alias("most")), "pair-most")
    rated = settled(
        counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")),
        "pair-rated",
    )
    each = texts.select("digest", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select(
        "digest", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links")
    )
    return each.join(rated, "pair").groupBy("digest").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("n")).alias("count_sum"),
    )


def distinct_aligned(docs: DataFrame, ranks_path: str, model_path: str, text_col: str = "text") -> DataFrame:
    """Every distinct text that is not empty: digest, number of documents, measures that
    need no counts, digest of its groups, pairs and their links, as a settled table."""
    text = whole(text_col)
    distinct = (
        docs.select(text.alias("text")).where("text <> ''")
        .groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
        .select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "copies", "text")
    )
    shared = docs.sparkSession.sparkContext.broadcast(pieces.Model.load(model_path))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(ranks_path, shared.value)
        for batch in by_bytes(batches):
            found = texts_aligned(tokenizers, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("copies"), *found.values()],
                ["digest", "copies", *found],
            )

    schema = (
        "digest binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, pairs array<bigint>, links array<int>"
    )
    return settled(in_batches(distinct, align, schema), "aligned-texts")


def pair_counts(texts: DataFrame) -> DataFrame:
    """Documents corpus-wide of every pair of ids, as a settled table."""
    seen = texts.where(F.size("pairs") > 0).select("copies", "pairs")
    counts = in_batches(seen, _counted, "pair bigint, n bigint")
    return settled(counts.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")


def alignment(
    docs: DataFrame, ranks_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens, groups, links and their counts of every row."""
    texts = distinct_aligned(docs, ranks_path, model_path, text_col)
    counts = pair_counts(texts)
    by = _measured_by_lookup if counts.count() <= PAIRS else _measured_by_join
    rated = settled(by(texts, counts), "text-measures")
    measures = texts.drop("pairs", "links", "copies").join(rated, "digest", "left").select(
        "digest", *[F.coalesce(m, F.lit(0)).cast("bigint").alias(m) for m in MEASURES], "groups_sha256"
    )
    measures = settled(measures, "texts-measured")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.unhex(F.sha2(whole(text_col).cast("binary"), 256)).alias("digest"),
    )
    return rows.join(bounded(measures), "digest", "left").select(
        F.col("id").alias(id_col), *[F.coalesce(m, F.lit(0)).cast("bigint").alias(m) for m in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
