"""Spelling variants: words one edit apart, found in k-d trees over letter counts.

**Words.** Maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower
case. A run whose checksum with its document's id says so loses one code point. The
checksum of id and run is put together from those of both (a CRC is linear), so each
distinct run is summed once a piece. Words of ``LEAST`` code points and ``OFTEN``
occurrences over all documents are compared.

**Vectors.** The letters of a word are counted in 32 places, one a letter from a to z
and six for all others, a count above two as two. One edit moves this vector by a
Manhattan distance of two at most, by one if it changes the length. In unary code a
vector is 64 bits, its distance from another the differing bits, and its distance
from a box the bits that the box's corners force.

**Trees.** Words of each length are cut by a k-d tree, whose planes come from a sample
of ``SAMPLE`` words; cells of more than twice ``CELL`` words are cut again by samples
of their own, until none is left that can be cut. Every word goes to its cell, and
as a query to the cells of its length and of the next whose box, the true bounds of
the words there, is in reach. Pairs within a length are looked for once, in the later
of both cells. A cell's words make a k-d tree of their own, in which boxes prune the
search. Words that share one vector cannot be cut; more than ``CELL`` of them are
dealt in blocks. Letter order is verified for what is left. Per word only a count and
the best neighbour leave a task, never the pairs.

**Forms.** A word's form is its near word of most occurrences (the smallest in code
point order among equals), if that has at least twice as many as the word. Roots
follow forms to the last, by doubling steps; occurrences double with each, so there
are few rounds.

Null texts have no words, a null id counts as empty text in the checksum, and
repeated rows count as rows. No documents give no words. Words may be of any length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.llm.common import by_bytes, in_batches, settled, slices, text_bytes, thinned

LEAST = 5
OFTEN = 3
#: A run of an even multiple of this checksum loses a code point.
EVERY = 97
#: Words of a cell, and words that planes are taken from at a time.
CELL = 16_384
SAMPLE = 65_536
#: Words of a leaf within a cell's own tree, queries searched at a time.
LEAF = 24
QUERIES_AT_ONCE = 8_192
#: Bytes compared at a time.
COMPARED = 8_000_000
#: Runs up to this many bytes have their checksum put together.
SHORT = 64

_BITS = np.arange(64, dtype=np.uint64)
_ONE = np.uint64(1)
_ALL = np.uint64(2**64 - 1)
_DIMENSION = np.full(256, 26, np.int64)
_DIMENSION[97:123] = np.arange(26)
_DIMENSION[128:] = 26 + np.arange(128) % 6

# ------------------------------------------------------------------ words


def _crc_steps() -> np.ndarray:
    """What one zero byte does to each low byte of a CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


def shifted(crc: np.ndarray, most: int = SHORT) -> np.ndarray:
    """Row k is what each checksum turns into by k zero bytes, without their own part."""
    steps = _crc_steps()
    out = np.empty((most + 1, len(crc)), np.uint32)
    out[0] = crc
    for k in range(most):
        out[k + 1] = steps[out[k] & 0xFF] ^ (out[k] >> 8)
    return out


def _runs(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All runs, A-Z in lower case, as a dictionary of bytes, and the text of each."""
    raw, at = text_bytes(texts)
    n = len(raw)
    if n == 0:
        return pa.array([], pa.large_binary()).dictionary_encode(), np.zeros(0, np.int64)
    low = raw | 32
    # In UTF-8 the byte C3 and the next are U+00C0 to U+00FF.
    letter = ((low >= 97) & (low <= 122)) | (raw == 0xC3)
    letter[1:] |= raw[:-1] == 0xC3
    begins = np.zeros(n + 1, bool)
    begins[at] = True
    open_ = letter.copy()
    open_[1:] &= ~letter[:-1] | begins[1:n]
    start = np.flatnonzero(open_)
    data = np.where((raw >= 65) & (raw <= 90), low, raw)[letter]
    ends = np.r_[np.cumsum(letter)[start] - 1, len(data)].astype(np.int64)
    array = pa.Array.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return array.dictionary_encode(), np.searchsorted(at, start, side="right") - 1


def words_of(ids: list[str | None], texts: pa.Array) -> dict[str, int]:
    """Words of the texts, changed where the checksum says so, with their occurrences."""
    runs, text = _runs(texts)
    if not len(runs):
        return {}
    known = runs.dictionary.to_pylist()
    index = runs.indices.to_numpy().astype(np.int64)
    size = np.fromiter(map(len, known), np.int64, len(known))
    points = np.fromiter((len(w) - w.count(0xC3) for w in known), np.int64, len(known))
    own = np.fromiter(map(zlib.crc32, known), np.uint32, len(known))
    prefix = np.fromiter(
        (zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids), np.uint32, len(ids)
    )
    length = size[index]
    check = shifted(prefix)[np.minimum(length, SHORT), text] ^ own[index]
    for k in np.flatnonzero(length > SHORT).tolist():
        check[k] = zlib.crc32(known[index[k]], int(prefix[text[k]]))
    hit = check % EVERY == 0
    count = np.bincount(index[~hit], minlength=len(known))
    found = {
        known[k].decode(): int(count[k]) for k in np.flatnonzero((count > 0) & (points >= LEAST)).tolist()
    }
    at = check[hit] % points[index[hit]]
    changed, times = np.unique(np.stack([index[hit], at.astype(np.int64)]), axis=1, return_counts=True)
    for (k, place), n in zip(changed.T.tolist(), times.tolist()):
        if points[k] > LEAST:
            word = known[k].decode()
            word = word[:place] + word[place + 1 :]
            found[word] = found.get(word, 0) + n
    return found


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of the words that are compared."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=4_000_000):
            found = words_of(batch.column("id").to_pylist(), batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"]
            )

    rows = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    each = in_batches(rows, count, "word string, n bigint")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)


# ---------------------------------------------------------------- vectors


def latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one byte each, and where each word begins."""
    raw, at = text_bytes(words)
    lead = raw == 0xC3
    after = np.r_[False, lead[:-1]] if len(raw) else lead
    data = np.where(after, raw | 0xC0, raw)[~lead]
    return data, at - np.r_[0, np.cumsum(lead)][at]


def coded(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Unary code of the letter counts of every word."""
    n = len(at) - 1
    word = np.repeat(np.arange(n), np.diff(at))
    count = np.bincount(word * 32 + _DIMENSION[data], minlength=n * 32).reshape(n, 32)
    both = np.stack([count >= 1, count >= 2], axis=2).reshape(n, 64)
    return np.packbits(both, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _with_codes(words: DataFrame) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "word"):
            data, at = latin(batch.column("word"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(np.diff(at).astype(np.int32)),
                 pa.array(coded(data, at).view(np.int64))],
                ["word", "n", "length", "code"],
            )

    return in_batches(words, code, "word string, n bigint, length int, code bigint")


# ------------------------------------------------------------------ trees


@dataclass
class Tree:
    """A k-d tree over codes, or several with a root each.

    ``bit`` is a node's plane, ``low`` its child without that bit and ``high`` the
    one with it; leaves have a number in ``leaf``. ``least`` and ``most`` are the
    corners of the box around what lies there.
    """

    bit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    leaf: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @staticmethod
    def frozen(nodes: list[list[int]]) -> Tree:
        bit, low, high, leaf, least, most = zip(*nodes) if nodes else [()] * 6
        return Tree(*[np.array(x, np.int64) for x in (bit, low, high, leaf)],
                    np.array(least, np.uint64), np.array(most, np.uint64))

    def home(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The leaf of each code, from its root."""
        node = node.copy()
        go = np.flatnonzero(self.leaf[node] < 0)
        while len(go):
            here = node[go]
            has = (code[go] >> self.bit[here].astype(np.uint64)) & _ONE
            node[go] = np.where(has == _ONE, self.high[here], self.low[here])
            go = go[self.leaf[node[go]] < 0]
        return self.leaf[node]

    def reached(self, node: np.ndarray, code: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a code's place and a leaf whose box is within reach of it."""
        place = np.arange(len(code))
        out = []
        while len(place):
            own = code[place]
            apart = np.bitwise_count(self.least[node] & ~own) + np.bitwise_count(own & ~self.most[node])
            near = apart <= reach
            place, node = place[near], node[near]
            at_leaf = self.leaf[node] >= 0
            out.append((place[at_leaf], self.leaf[node[at_leaf]]))
            place, node = place[~at_leaf], node[~at_leaf]
            place, node = np.concatenate([place, place]), np.concatenate([self.low[node], self.high[node]])
        if not out:
            return place, place
        return tuple(np.concatenate(x) for x in zip(*out))


def grow(nodes: list[list[int]], root: int, code: np.ndarray, limit: int, leaves: int) -> list[np.ndarray]:
    """Cuts the leaf ``root`` until no leaf has more than ``limit`` of the codes, or codes
    that differ; leaves are numbered from ``leaves``. Returns the codes' places by leaf."""
    found = []
    todo = [(root, np.arange(len(code)))]
    while todo:
        node, place = todo.pop()
        own = code[place]
        least = np.bitwise_and.reduce(own) if len(own) else _ALL
        most = np.bitwise_or.reduce(own) if len(own) else np.uint64(0)
        nodes[node][4:] = int(least), int(most)
        if len(own) <= limit or least == most:
            nodes[node][3] = leaves + len(found)
            found.append(place)
            continue
        bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bit = int(np.argmin(np.abs(bits.sum(0, dtype=np.int64) * 2 - len(own))))
        has = bits[:, bit] == 1
        nodes[node][:4] = bit, len(nodes), len(nodes) + 1, -1
        for part in (place[~has], place[has]):
            todo.append((len(nodes), part))
            nodes.append([0, -1, -1, -1, 0, 0])
    return found


@dataclass
class Forest:
    """A tree for every length that has been cut; other lengths are one cell each."""

    nodes: list[list[int]] = field(default_factory=list)
    roots: dict[int, int] = field(default_factory=dict)
    leaves: int = 0

    def cut(self, length: int, leaf: int, code: np.ndarray, limit: int, differ: int) -> None:
        """Cuts a cell by planes from some of its codes, or if these are all the same,
        by a bit in which its words are known to differ."""
        if leaf < 0:
            self.roots[length] = len(self.nodes)
            self.nodes.append([0, -1, -1, -1, 0, 0])
            node = self.roots[length]
        else:
            node = next(i for i, n in enumerate(self.nodes) if n[3] == leaf)
        if len(code) > limit and (code != code[0]).any():
            self.leaves += len(grow(self.nodes, node, code, limit, self.leaves))
            return
        at = len(self.nodes)
        self.nodes[node][:4] = differ.bit_length() - 1, at, at + 1, -1
        self.nodes += [[0, -1, -1, self.leaves + k, 0, 0] for k in (0, 1)]
        self.leaves += 2

    def bounded_by(self, cells: list[tuple[int, int, int, int, int]]) -> None:
        """Sets boxes to the true bounds of the cells (length, leaf, words, least, most), and
        gives lengths that were not cut a root."""
        for length, leaf, *_ in cells:
            if leaf < 0:
                self.roots[length] = len(self.nodes)
                self.nodes.append([0, -1, -1, self.leaves, 0, 0])
                self.leaves += 1
        by_leaf = {
            self.nodes[self.roots[length]][3] if leaf < 0 else leaf: (least, most)
            for length, leaf, _, least, most in cells
        }
        # Children come after their parents. An empty cell is out of reach.
        for node in reversed(self.nodes):
            if node[3] >= 0:
                node[4:] = by_leaf.get(node[3], (int(_ALL), 0))
            else:
                a, b = self.nodes[node[1]], self.nodes[node[2]]
                node[4:] = a[4] & b[4], a[5] | b[5]

    def root_table(self) -> np.ndarray:
        """Root of every length up to the one after the longest, or -1."""
        table = np.full(max(self.roots, default=0) + 3, -1, np.int64)
        table[list(self.roots)] = list(self.roots.values())
        return table


def _homes(tree: Tree, roots: np.ndarray, length: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Cell of every word, -1 where its length has no tree."""
    root = roots[np.minimum(length, len(roots) - 1)]
    leaf = np.full(len(length), -1, np.int64)
    has = root >= 0
    leaf[has] = tree.home(root[has], code[has])
    return leaf


def planted(words: DataFrame) -> tuple[Forest, dict[int, int]]:
    """Trees whose cells are bounded, and the blocks of cells that cannot be cut."""
    forest = Forest()
    unsigned = (1 << 64) - 1
    while True:
        tree, roots = Tree.frozen(forest.nodes), forest.root_table()

        def place(batches: Iterator[pa.RecordBatch], tree=tree, roots=roots) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                length, code = (batch.column(c).to_numpy() for c in ("length", "code"))
                leaf = _homes(tree, roots, length, code.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word"), batch.column("length"), batch.column("code"), pa.array(leaf)],
                    ["word", "length", "code", "leaf"],
                )

        at_home = in_batches(
            words.select("word", "length", "code"), place, "word string, length int, code bigint, leaf bigint"
        )
        # One line a cell.
        cells = [
            (r["length"], r["leaf"], r["words"], r["least"] & unsigned, r["most"] & unsigned)
            for r in at_home.groupBy("length", "leaf").agg(
                F.count(F.lit(1)).alias("words"), F.bit_and("code").alias("least"), F.bit_or("code").alias("most")
            ).collect()
        ]
        crowded = {(c[0], c[1]): (c[2], c[3] ^ c[4]) for c in cells if c[2] > 2 * CELL and c[3] != c[4]}
        if not crowded:
            break
        wanted = words.sparkSession.createDataFrame(list(crowded), "length int, leaf bigint")
        some = settled(at_home.join(F.broadcast(wanted), ["length", "leaf"]), "crowded-words")
        sample = thinned(some, F.col("word"), SAMPLE).orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
        taken = sample.select("length", "leaf", "code").toArrow()
        length, leaf = taken["length"].to_numpy(), taken["leaf"].to_numpy()
        code = taken["code"].to_numpy().view(np.uint64)
        for (own_length, own_leaf), (n, differ) in sorted(crowded.items()):
            own = code[(length == own_length) & (leaf == own_leaf)]
            forest.cut(own_length, own_leaf, own, max(1, CELL * len(own) // n), differ)
    forest.bounded_by(cells)
    blocks = {
        (forest.nodes[forest.roots[length]][3] if leaf < 0 else leaf): -(-n // CELL)
        for length, leaf, n, least, most in cells if n > 2 * CELL
    }
    return forest, blocks


# ----------------------------------------------------------------- search


def _dealt(words: DataFrame, forest: Forest, blocks: dict[int, int]) -> DataFrame:
    """Every word at its cell, ``asks`` 0, and as a query at the cells in reach, ``asks`` 1."""
    tree, roots = Tree.frozen(forest.nodes), forest.root_table()
    many = np.ones(max(forest.leaves, 1), np.int64)
    many[list(blocks)] = list(blocks.values())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, QUERIES_AT_ONCE):
            length, code = batch.column("length").to_numpy(), batch.column("code").to_numpy().view(np.uint64)
            home = _homes(tree, roots, length, code)
            block = np.zeros(len(home), np.int64)
            for k in np.flatnonzero(many[home] > 1).tolist():
                block[k] = zlib.crc32(batch.column("word")[k].as_py().encode()) % many[home[k]]
            place, leaf = tree.reached(roots[length], code, 2)
            later = leaf >= home[place]
            parts = [(place[later], leaf[later])]
            longer = np.flatnonzero(roots[np.minimum(length + 1, len(roots) - 1)] >= 0)
            place, leaf = tree.reached(roots[length[longer] + 1], code[longer], 1)
            parts.append((longer[place], leaf))
            place, leaf = (np.concatenate(x) for x in zip(*parts))
            times = many[leaf]
            place, leaf = np.repeat(place, times), np.repeat(leaf, times)
            to = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
            asks = (leaf != home[place]) | (to > block[place])
            place, leaf, to = place[asks], leaf[asks], to[asks]
            rows = np.r_[np.arange(len(home)), place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[home, leaf].astype(np.int32)), pa.array(np.r_[block, to].astype(np.int32)),
                 pa.array(np.repeat([0, 1], [len(home), len(place)]).astype(np.int32)),
                 *[batch.column(c).take(pa.array(rows)) for c in ("word", "n", "code")]],
                ["leaf", "block", "asks", "word", "n", "code"],
            )

    return in_batches(words, deal, "leaf int, block int, asks int, word string, n bigint, code bigint")


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows differ by one replaced or, if their lengths do, one inserted code point."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    front = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= short.shape[1]


@dataclass
class Group:
    """Words of one length with their letters in a matrix, and their order."""

    words: pa.Array
    n: np.ndarray
    code: np.ndarray
    letters: np.ndarray
    rank: np.ndarray

    @staticmethod
    def of(words: pa.Array, n: np.ndarray, code: np.ndarray) -> list[Group]:
        """A group for each length."""
        data, at = latin(words)
        size = np.diff(at)
        found = []
        for length in np.unique(size).tolist():
            own = np.flatnonzero(size == length)
            letters = data[at[own][:, None] + np.arange(length)]
            rank = np.empty(len(own), np.int64)
            rank[np.argsort(letters.view(f"S{length}").ravel())] = np.arange(len(own))
            found.append(Group(words.take(pa.array(own)), n[own], code[own], letters, rank))
        return found


class Cell:
    """The words of a cell in a k-d tree of their own."""

    def __init__(self, words: pa.Array, n: np.ndarray, code: np.ndarray):
        (self.own,) = Group.of(words, n, code)
        nodes: list[list[int]] = [[0, -1, -1, -1, 0, 0]]
        leaves = grow(nodes, 0, self.own.code, LEAF, 0)
        self.tree = Tree.frozen(nodes)
        self.order = np.concatenate(leaves)
        self.size = np.array([len(x) for x in leaves])
        self.start = np.cumsum(self.size) - self.size

    def pairs(self, asked: Group, itself: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the asked words and of the near words here; each pair once if it asks itself."""
        length = self.own.letters.shape[1]
        reach = 2 if asked.letters.shape[1] == length else 1
        for lo in range(0, len(asked.code), QUERIES_AT_ONCE):
            code = asked.code[lo : lo + QUERIES_AT_ONCE]
            place, leaf = self.tree.reached(np.zeros(len(code), np.int64), code, reach)
            # Few candidates at a time, whatever the length of the words.
            reached = np.cumsum(self.size[leaf])
            at = 0
            while at < len(leaf):
                base = reached[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(reached, base + COMPARED // length, side="right")))
                size = self.size[leaf[at:to]]
                a = np.repeat(place[at:to], size)
                first = np.repeat(self.start[leaf[at:to]] - (np.cumsum(size) - size), size)
                b = self.order[first + np.arange(len(a))]
                near = np.bitwise_count(code[a] ^ self.own.code[b]) <= reach
                a, b = a[near] + lo, b[near]
                if itself:
                    a, b = a[a < b], b[a < b]
                near = one_edit(asked.letters[a], self.own.letters[b])
                yield a[near], b[near]
                at = to


def _told(asked: Group, other: Group, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """How many partners each asked word has here, and the best of them."""
    order = np.lexsort((other.rank[b], -other.n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else a
    count = np.diff(np.r_[first, len(a)])
    best = pa.array(b[first])
    return pa.RecordBatch.from_arrays(
        [asked.words.take(pa.array(a[first])), pa.array(count, pa.int64()),
         pa.array(other.n[b[first]], pa.int64()), other.words.take(best)],
        ["word", "near", "best_n", "best"],
    )


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partners of all words in cells, which arrive sorted and whole in a partition."""
    key: tuple[int, int] | None = None
    held: list[pa.RecordBatch] = []
    cell: Cell | None = None

    def both(asked: Group, itself: bool) -> Iterator[pa.RecordBatch]:
        for a, b in cell.pairs(asked, itself):
            if len(a):
                yield _told(asked, cell.own, a, b)
                yield _told(cell.own, asked, b, a)

    def columns(parts: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(parts).combine_chunks()
        word, n, code = (table.column(c).combine_chunks() for c in ("word", "n", "code"))
        return word, n.to_numpy(), code.to_numpy().view(np.uint64)

    def built() -> Iterator[pa.RecordBatch]:
        nonlocal cell
        cell = Cell(*columns(held))
        held.clear()
        yield from both(cell.own, True)

    for batch in batches:
        parts = [batch.column(c).to_numpy() for c in ("leaf", "block", "asks")]
        edges = np.flatnonzero(np.any([np.diff(p) != 0 for p in parts], axis=0)) + 1
        for lo, hi in zip(np.r_[0, edges].tolist(), np.r_[edges, batch.num_rows].tolist()):
            if lo == hi:
                continue
            own = (int(parts[0][lo]), int(parts[1][lo]))
            if own != key:
                if held:
                    yield from built()
                key, cell = own, None
            if not parts[2][lo]:
                held.append(batch.slice(lo, hi - lo))
                continue
            if held:
                yield from built()
            if cell is not None:
                for asked in Group.of(*columns([batch.slice(lo, hi - lo)])):
                    yield from both(asked, False)
    if held:
        yield from built()


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and its ``best`` near word with ``best_n``, for all that have any.

    ``words`` is a settled table of distinct words with ``n``, ``length`` and ``code``.
    """
    dealt = _dealt(words, *planted(words))
    cells = dealt.repartition("leaf", "block").sortWithinPartitions("leaf", "block", "asks")
    told = in_batches(cells, _searched, "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return told.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of all words with a form, steps doubled each round."""
    steps = settled(forms.select("word", F.col("form").alias("to")), "spelling-steps")
    while True:
        further = settled(
            steps.alias("a").join(steps.alias("b"), F.expr("a.to = b.word"), "left").select(
                "a.word", F.coalesce("b.to", "a.to").alias("to"), F.col("b.to").isNotNull().alias("moved")
            ),
            "spelling-steps",
        )
        steps = further.drop("moved")
        if further.where("moved").isEmpty():
            return steps.select("word", F.col("to").alias("root"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every word with its form, root, occurrences, number of near words, and its form's occurrences."""
    words = settled(_with_codes(counted(docs, id_col, text_col)), "spelling-words")
    near = neighbours(words)
    taken = F.col("best_n") >= 2 * F.col("n")
    found = settled(
        words.select("word", "n").join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(taken, F.col("best")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
