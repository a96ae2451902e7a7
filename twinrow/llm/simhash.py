"""Near-duplicates by SimHash, linked through bit counts of segments.

**Fingerprint.** Texts are lower-cased (A-Z) and cut into words at white space.
Every run of four words, repeats included, is hashed by XXH64 (seed 42); a bit of
the fingerprint is set if it is set in over half of the hashes. A text of fewer
words is one run, and a text without words, or a null one, has fingerprint zero.

**Embedding.** A fingerprint becomes the counts of set bits in 32 segments of two
bits. The Manhattan distance of two such vectors is never above the Hamming
distance, so vectors further apart than the threshold need no look at the bits.

**Grid join.** The segments are cut into ``slabs``. Two vectors within distance d
differ in at most d slabs, so they agree in all of some choice of ``slabs - d``
of them; each choice is a grid, its cell the counts in those slabs. Vectors that
share a cell are compared by Manhattan distance, then by exact bits. The more
fingerprints there are, the more slabs are used, which keeps the cells small; the
links are the same for any number of slabs.

**Whole results without all pairs.** Equal fingerprints are one node from the
start. A crowded cell is dealt as pairs of blocks, and every block, run and batch
returns a spanning forest of its links instead of the links. Components over
these forests are exact. No cell, block or component passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.llm.common import bounded, by_bytes, in_batches, settled, slices, unused, whole, words_of
from twinrow.llm.components import components
from twinrow.llm.xxh64 import xxh64

WORDS = 4
DISTANCE = 4
SEED = 42
#: Fingerprints of a cell that are compared in one go; larger cells are dealt in blocks.
BLOCK = 1024
#: Runs up to this many fingerprints are compared by shifting, larger ones in a matrix.
SHORT = 64

_EVEN = np.uint64(0x5555555555555555)
_ONE = np.uint64(1)
_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.float64)


def fingerprints_of(texts: pa.Array) -> np.ndarray:
    """Fingerprint of each text."""
    words = words_of(texts)
    count = np.diff(words.first)
    runs = np.where(count == 0, 0, np.maximum(count - WORDS + 1, 1))
    at = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=at[1:])
    own = np.repeat(np.arange(len(runs)), runs)
    first = words.first[:-1][own] + np.arange(at[-1]) - at[:-1][own]
    last = np.minimum(first + WORDS, words.first[1:][own]) - 1
    begin, end = words.start[first], words.end[last]
    hashes = xxh64(words.data, begin, end - begin, SEED)
    out = np.zeros(len(runs), np.uint64)
    step = 128
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    for d in range(0, len(runs), step):
        lo, hi = at[d], at[min(d + step, len(runs))]
        n = min(step, len(runs) - d)
        slot = ((own[lo:hi] - d)[:, None] * 8 + np.arange(8)) * 256 + octets[lo:hi]
        seen = np.bincount(slot.ravel(), minlength=n * 2048).reshape(n, 8, 256)
        votes = (seen @ _BITS).reshape(n, 64)
        set_ = 2 * votes > runs[d : d + n, None]
        out[d : d + n] = np.packbits(set_, axis=1).view(">u8").ravel()
    return out


def embedded(fp: np.ndarray) -> np.ndarray:
    """Counts of the 2-bit segments, in unary: 0 is 00, 1 is 01 and 2 is 11.

    In unary, differing bits are the Manhattan distance of the counts.
    """
    high = fp >> _ONE
    return ((fp | high) & _EVEN) | ((fp & high & _EVEN) << _ONE)


def _slab_masks(slabs: int) -> list[int]:
    edges = [round(i * 32 / slabs) for i in range(slabs + 1)]
    return [((1 << (2 * hi)) - (1 << (2 * lo))) for lo, hi in zip(edges, edges[1:])]


def grids(slabs: int, distance: int = DISTANCE) -> list[int]:
    """Bit masks of the unary counts that make up the cells of each grid."""
    masks = _slab_masks(slabs)
    return [sum(c) for c in combinations(masks, slabs - distance)]


def slabs_for(fingerprints: int, distance: int = DISTANCE) -> int:
    """The fewest slabs under which unrelated fingerprints rarely share a cell.

    Two random counts of a 2-bit segment agree with probability 3/8.
    """
    slabs = distance + 2
    while slabs < 16:
        least = min(bin(mask).count("1") // 2 for mask in grids(slabs, distance))
        if fingerprints * (3 / 8) ** least <= 16:
            break
        slabs += 1
    return slabs


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links: each node with the least one it reaches."""
    if len(a) == 0:
        return a, b
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y, label[x], label[y]):
            np.minimum.at(new, side, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    apart = label != np.arange(len(nodes))
    return nodes[apart], nodes[label[apart]]


def _near(fp: np.ndarray, el: np.ndarray, i, j, distance: int) -> np.ndarray:
    """Manhattan distance first; exact bits for what it leaves."""
    near = np.bitwise_count(el[i] ^ el[j]) <= distance
    return near & (np.bitwise_count(fp[i] ^ fp[j]) <= distance)


def _cell_forest(fp: np.ndarray, node: np.ndarray, distance: int):
    """Forest of the links within one crowded cell, in bounded blocks."""
    el = embedded(fp)
    a, b = [], []
    for i in range(0, len(fp), BLOCK):
        for j in range(i, len(fp), BLOCK):
            rows = np.arange(i, min(i + BLOCK, len(fp)))[:, None]
            cols = np.arange(j, min(j + BLOCK, len(fp)))[None, :]
            r, c = np.nonzero(_near(fp, el, rows, cols, distance))
            r, c = _roots(node[r + i], node[c + j])
            a.append(r)
            b.append(c)
    return _roots(np.concatenate(a), np.concatenate(b))


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Forests of the links in cells, which arrive sorted and whole in a partition."""

    def forest(cell, fp, node):
        edge = np.flatnonzero(np.diff(cell)) + 1
        start = np.concatenate([[0], edge])
        size = np.diff(np.concatenate([start, [len(cell)]]))
        end = np.repeat(start + size, size)
        el = embedded(fp)
        a, b = [], []
        short = np.repeat(size <= SHORT, size)
        i = np.flatnonzero(short & (end - np.arange(len(cell)) > 1))
        shift = 1
        while len(i):
            hit = i[_near(fp, el, i, i + shift, distance)]
            a.append(node[hit])
            b.append(node[hit + shift])
            shift += 1
            i = i[i + shift < end[i]]
        for s, n in zip(start[size > SHORT], size[size > SHORT]):
            r, c = _cell_forest(fp[s : s + n], node[s : s + n], distance)
            a.append(r)
            b.append(c)
        return _roots(np.concatenate(a or [node[:0]]), np.concatenate(b or [node[:0]]))

    def given(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        new = [batch.column(k).to_numpy() for k in ("cell", "fp", "node")]
        if held is not None:
            new = [np.concatenate(x) for x in zip(held, new)]
        cell = new[0]
        if len(cell) == 0:
            continue
        # The last cell may go on in the next batch.
        cut = int(np.searchsorted(cell, cell[-1]))
        held = [x[cut:] for x in new]
        if cut:
            yield given(*forest(cell[:cut], new[1][:cut].view(np.uint64), new[2][:cut]))
    if held is not None and len(held[0]):
        yield given(*forest(held[0], held[1].view(np.uint64), held[2]))


def linked(nodes: DataFrame, distance: int = DISTANCE, slabs: int | None = None) -> DataFrame:
    """Links (a, b) between fingerprints at most ``distance`` bits apart, as forests.

    ``nodes`` is a settled table of distinct longs ``fp`` with an id ``node`` each.
    """
    slabs = slabs or slabs_for(nodes.count(), distance)
    masks = np.array(grids(slabs, distance), np.uint64)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, 8192):
                fp, node = (batch.column(k).to_numpy() for k in ("fp", "node"))
                el = embedded(fp.view(np.uint64))
                for k, mask in enumerate(masks):
                    # Mixed by an odd factor and a shift, which cannot collide.
                    cell = ((el & mask) ^ np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
                    cell ^= cell >> np.uint64(29)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell.view(np.int64)), pa.array(fp), pa.array(node)],
                        ["cell", "fp", "node"],
                    )

    dealt = in_batches(nodes, cells, "cell bigint, fp bigint, node bigint")
    sizes = dealt.groupBy("cell").count().where(F.col("count") > BLOCK)
    crowded = settled(
        sizes.select("cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")),
        "crowded-cells",
    )
    if not crowded.isEmpty():
        # A crowded cell becomes one cell for each pair of its blocks.
        own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
        other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1)))
                          .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
        paired = (
            dealt.join(bounded(crowded), "cell", "left")
            .withColumn("own", own).withColumn("other", other)
        )
        dealt = paired.select(
            F.when(F.col("other") < 0, F.col("cell"))
            .otherwise(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")))
            .alias("cell"), "fp", "node",
        )
    at_home = dealt.repartition("cell").sortWithinPartitions("cell")
    return in_batches(at_home, lambda batches: _links(batches, distance), "a bigint, b bigint")


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``print``, a hash of the text, and ``fp``, the fingerprint as a signed
    long, of every row."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            fp = fingerprints_of(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("print"), pa.array(fp.view(np.int64))],
                ["id", "print", "fp"],
            )

    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.xxhash64(whole(text_col)).alias("print"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    return in_batches(rows, prints, "id bigint, print bigint, fp bigint")


def _placed(docs: DataFrame, id_col: str, text_col: str, distance: int) -> DataFrame:
    """``id``, ``print``, ``fp`` and ``component_id`` of every row."""
    prints = settled(fingerprinted(docs, id_col, text_col), "fingerprints")
    # A fingerprint that only rows without an id have gets a node below all ids.
    nodes = settled(
        prints.groupBy("fp").agg(F.min("id").alias("least"))
        .select("fp", "least", F.coalesce("least", F.xxhash64("fp") % (2**40) - 2**62).alias("node")),
        "fingerprint-nodes",
    )
    found = settled(linked(nodes.select("fp", "node"), distance), "fingerprint-links")
    roots = settled(components(found), "fingerprint-roots")
    ids = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The root may be a node without an id, so the least id is taken anew.
    least = settled(ids.groupBy("root").agg(F.min("least").alias("component_id")), "least-ids")
    placed = settled(ids.select("fp", "root").join(least, "root"), "fingerprint-components")
    return prints.join(placed.select("fp", "component_id"), "fp")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE
) -> DataFrame:
    """Id, fingerprint (16 hex digits) and component of every row.

    The component is the smallest id reachable over links, a row's own included.
    Rows without an id take part; where nothing else is reached it is null.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return _placed(docs, id_col, text_col, distance).select(
        F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id"
    )


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE
) -> DataFrame:
    """The rows with all columns of one document a component, that of the smallest id.

    Rows of that id that are linked to each other are one document and all stay;
    so do rows without an id in a component without any. Columns may have any name.
    """
    found = _placed(docs, id_col, text_col, distance)
    gone_id, gone_print = unused(docs.columns, "gone_id", "gone_print")
    gone = settled(
        found.where(~F.col("id").eqNullSafe(F.col("component_id")))
        .select(F.col("id").alias(gone_id), F.col("print").alias(gone_print)).distinct(),
        "near-duplicates",
    )
    same = F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(gone_id)) & (
        F.xxhash64(whole(text_col)) == F.col(gone_print)
    )
    return docs.join(bounded(gone), same, "left_anti")
