"""SentencePiece (BPE) encoding and decoding in vectorised merge rounds.

The words of a batch, each once, lie in flat arrays of symbols. In every round
each word finds its least pair rank (best score) and the leftmost place that has
it, all words merge there at the same time, and the arrays are compacted; words
without a pair left leave the arrays. One merge a word and round is the order in
which the library merges, so the ids are the same. Only words of more than
``LONG`` characters, whose rounds would be too many, run through a heap in the
same order of merges.

Text is cut before runs of white space marks and around line feeds, which no piece
spans; a model whose pieces do is refused, and so is one that changes text before
it encodes it. Characters without a piece become their UTF-8 bytes.

Null texts count as empty and have no ids. Decoding joins the pieces, turns
byte ids into bytes, replaces every invalid byte by U+FFFD, drops control ids and
the one space that encoding puts in front.
"""

from __future__ import annotations

import codecs
import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.llm.common import by_bytes, in_batches, text_bytes

SPACE = "▁"
#: Words of more characters are merged by a heap.
LONG = 512
#: Words merged at a time.
AT_ONCE = 32_768
#: Chunks whose ids are remembered within a task, and the bytes of chunks and ids.
REMEMBERED = 100_000
REMEMBERED_BYTES = 8_000_000
#: Bytes of text that are encoded at a time.
PIECE_BYTES = 1_000_000

_NONE = np.int64(2**62)
_RAW = 1 << 24  # Symbol of a character that is in no piece: this plus its code point.


def _slot(key: np.ndarray, slots: int) -> np.ndarray:
    """Where a pair is looked for first in a table of a power of two slots."""
    mixed = key * np.int64(-7046029254386353131)
    return (mixed >> np.int64(32)) & np.int64(slots - 1)


@dataclass
class Model:
    """A model's tables: symbols of characters, ranked pairs, bytes of pieces."""

    chars: dict[int, int]
    pairs: np.ndarray  # Open addressing: a key, its rank and what it makes, or -1.
    rank: np.ndarray
    merged: np.ndarray
    pieces: int
    byte_id: np.ndarray
    extra: dict[int, int]
    surface: np.ndarray
    surface_at: np.ndarray
    unknown: int

    @cached_property
    def by_key(self) -> dict[int, int]:
        """Rank and what it makes, in one number, of every pair."""
        used = np.flatnonzero(self.pairs >= 0)
        both = self.rank[used] << 32 | self.merged[used]
        return dict(zip(self.pairs[used].tolist(), both.tolist()))

    @staticmethod
    def load(path: str) -> Model:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        for text in ("a b", "  a", "a  b ", "ﬁ ½", "▁"):
            if sp.decode(sp.encode(text)) != text.replace(SPACE, " "):
                raise ValueError("the model changes text before it encodes it")
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        own = {p: i for i, p in enumerate(names) if not special[i]}
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in own):
            raise ValueError("a piece spans words or lines")
        byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if not all(sp.is_byte(int(i)) for i in byte_id):
            raise ValueError("models without byte fallback are not supported")
        # Characters inside of pieces that are no pieces themselves.
        part = dict(own)
        extra = {}
        for c in sorted({c for p in own for c in p} - own.keys()):
            part[c] = n + len(extra)
            extra[part[c]] = ord(c)
        scores = {i: sp.get_score(i) for i in own.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        found = {}
        for p, i in own.items():
            for cut in range(1, len(p)):
                a, b = part.get(p[:cut]), part.get(p[cut:])
                if a is not None and b is not None:
                    found[a << 32 | b] = (order[scores[i]], i)
        slots = 1 << (max(len(found), 1) * 3).bit_length()
        table = np.full((3, slots), -1, np.int64)
        for key, (order_of, made) in found.items():
            at = int(_slot(np.array([key]), slots)[0])
            while table[0, at] >= 0:
                at = (at + 1) % slots
            table[:, at] = key, order_of, made
        surface = []
        for i, p in enumerate(names):
            if sp.is_byte(i):
                surface.append(bytes([int(p[3:5], 16)]))
            elif sp.is_unknown(i):
                surface.append(" ⁇ ".encode())
            else:
                surface.append(b"" if special[i] else p.replace(SPACE, " ").encode())
        at = np.zeros(n + 1, np.int64)
        np.cumsum([len(s) for s in surface], out=at[1:])
        return Model(
            chars={ord(c): i for c, i in part.items() if len(c) == 1},
            pairs=table[0], rank=table[1], merged=table[2], pieces=n, byte_id=byte_id,
            extra=extra, surface=np.frombuffer(b"".join(surface), np.uint8), surface_at=at,
            unknown=sp.unk_id(),
        )

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and the piece it makes."""
        key = left << 32 | right
        at = _slot(key, len(self.pairs))
        seen = self.pairs[at]
        look = np.flatnonzero((seen != key) & (seen >= 0))
        while len(look):
            at[look] = (at[look] + 1) % len(self.pairs)
            seen[look] = self.pairs[at[look]]
            look = look[(seen[look] != key[look]) & (seen[look] >= 0)]
        return np.where(seen == key, self.rank[at], _NONE), self.merged[at]

    def symbols(self, text: str) -> np.ndarray:
        points, where = np.unique(
            np.frombuffer(text.encode("utf-32-le"), np.uint32), return_inverse=True
        )
        own = [self.chars.get(p, _RAW + p) for p in points.tolist()]
        return np.array(own, np.int64)[where]


def _by_heap(model: Model, sym: np.ndarray) -> np.ndarray:
    """The same merges for one long word: least rank first, then leftmost.

    A heap entry is a rank and a place in one number. It holds as long as the pair
    that now begins there has that rank.
    """
    n = len(sym)
    table = model.by_key
    sym = array("q", sym.tobytes())
    after = array("q", range(1, n + 1))
    before = array("q", range(-1, n - 1))
    after[n - 1] = -1
    ranks, _ = model.ranked(*(np.frombuffer(sym, np.int64)[k : n - 1 + k] for k in (0, 1)))
    at = np.flatnonzero(ranks != _NONE)
    heap = (ranks[at] << 32 | at).tolist()
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (hit := table.get(sym[i] << 32 | sym[j])) is not None:
            heapq.heappush(heap, hit >> 32 << 32 | i)

    while heap:
        entry = heapq.heappop(heap)
        i = entry & 0xFFFFFFFF
        j = after[i]
        if sym[i] < 0 or j < 0:
            continue
        hit = table.get(sym[i] << 32 | sym[j])
        if hit is None or hit >> 32 != entry >> 32:
            continue
        sym[i], sym[j] = hit & 0xFFFFFFFF, -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    left = np.frombuffer(sym, np.int64)
    return left[left >= 0]


def _rounds(model: Model, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols left of every word, flat, and how many each has."""
    words = len(size)
    word = np.repeat(np.arange(words), size)
    rank = np.full(len(sym), _NONE)
    made = np.zeros(len(sym), np.int64)
    inner = np.flatnonzero(word[:-1] == word[1:])
    rank[inner], made[inner] = model.ranked(sym[inner], sym[inner + 1])
    done_sym, done_word = [], []
    while len(sym):
        start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        least = np.minimum.reduceat(rank, start)
        count = np.diff(np.r_[start, len(sym)])
        live = np.repeat(least != _NONE, count)
        if not live.all():
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            sym, word, rank, made = sym[live], word[live], rank[live], made[live]
            least, count = least[least != _NONE], count[least != _NONE]
            if not len(sym):
                break
        hits = np.flatnonzero(rank == np.repeat(least, count))
        place = hits[np.r_[True, word[hits][1:] != word[hits][:-1]]]  # leftmost of each word
        sym[place] = made[place]
        keep = np.ones(len(sym), bool)
        keep[place + 1] = False
        # A merged symbol has the pairs with its new neighbours, if it has those.
        new = np.cumsum(keep)[place] - 1
        sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
        rank[new] = _NONE
        near = np.concatenate([new, new[new > 0] - 1])
        near = near[near + 1 < len(sym)]
        near = near[word[near] == word[near + 1]]
        rank[near], made[near] = model.ranked(sym[near], sym[near + 1])
    if not done_sym:
        return np.zeros(0, np.int64), np.zeros(words, np.int64)
    flat, own = np.concatenate(done_sym), np.concatenate(done_word)
    return flat[np.argsort(own, kind="stable")], np.bincount(own, minlength=words)


def encode_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, flat, and how many each has."""
    flats, sizes = [], []
    for at in range(0, len(words), AT_ONCE):
        part = words[at : at + AT_ONCE]
        size = np.fromiter(map(len, part), np.int64, len(part))
        long = np.flatnonzero(size > LONG)
        sym = model.symbols("".join(part))
        if len(long):
            begin = np.cumsum(size) - size
            alone = {int(w): _by_heap(model, sym[begin[w] : begin[w] + size[w]]) for w in long}
            short = np.repeat(size <= LONG, size)
            rest_size = np.where(size <= LONG, size, 0)
            rest, left = _rounds(model, sym[short], rest_size)
            cuts = np.split(rest, np.cumsum(left)[:-1])
            cuts = [alone.get(w, c) for w, c in enumerate(cuts)]
            sym, size = np.concatenate(cuts), np.array([len(c) for c in cuts])
        else:
            sym, size = _rounds(model, sym, size)
        flats.append(_with_bytes(model, sym, size))
        sizes.append(size)
    if not flats:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(flats), np.concatenate(sizes)


def _with_bytes(model: Model, sym: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Symbols as ids; characters without a piece become bytes. Changes ``size``."""
    odd = np.flatnonzero(sym >= model.pieces)
    if not len(odd):
        return sym.astype(np.int32)
    word = np.repeat(np.arange(len(size)), size)
    octets = [
        chr(model.extra[s] if s in model.extra else s - _RAW).encode("utf-8", "surrogatepass")
        for s in sym[odd].tolist()
    ]
    n = np.ones(len(sym), np.int64)
    n[odd] = [len(o) for o in octets]
    out = np.repeat(sym, n)
    raw = np.frombuffer(b"".join(octets), np.uint8)
    out[np.repeat(sym >= model.pieces, n)] = model.byte_id[raw]
    size[:] = np.bincount(word, weights=n, minlength=len(size)).astype(np.int64)
    return out.astype(np.int32)


def _gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` one after another."""
    shift = begin - (np.cumsum(size) - size)
    return flat[np.repeat(shift, size) + np.arange(int(size.sum()))]


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts as bytes, and where those of each text begin."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pc.replace_substring(texts, SPACE, " ")
    front = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ")
    data, at = text_bytes(pc.binary_join_element_wise(front.cast(pa.large_string()), texts, pa.scalar("", pa.large_string())))
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(at), np.int64)
    space, line = data == 32, data == 10
    begins = line.copy()
    begins[1:] |= (space[1:] & ~space[:-1]) | line[:-1]
    begins[at[:-1][at[:-1] < len(data)]] = True
    start = np.flatnonzero(begins)
    ends = np.r_[start, len(data)].astype(np.int64)
    chunks = pa.Array.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)]
    )
    return chunks, np.searchsorted(start, at)


class Encoder:
    """Encodes texts, remembering chunks of a task up to ``REMEMBERED_BYTES``."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.held = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each has."""
        chunks, first = _chunks(texts)
        unique = chunks.dictionary_encode()
        own = unique.dictionary.to_pylist()
        # What this piece may add is known before it is added.
        full = len(self.index) + len(own) > REMEMBERED
        if full or self.held + unique.dictionary.nbytes > REMEMBERED_BYTES:
            self._forget()
        index = self.index
        new = [w for w in own if w not in index]
        if new:
            words = [w.decode().replace(" ", SPACE) for w in new]
            flat, size = encode_words(self.model, words)
            begin = np.cumsum(size) - size + len(self.flat)
            self.flat = np.concatenate([self.flat, flat])
            self.begin = np.concatenate([self.begin, begin])
            self.size = np.concatenate([self.size, size])
            index.update(zip(new, range(len(index), len(index) + len(new))))
            self.held += sum(map(len, new)) + flat.nbytes
        place = np.fromiter(map(index.__getitem__, own), np.int64, len(own))
        word = place[unique.indices.to_numpy()]
        size = self.size[word]
        ids = _gather(self.flat, self.begin[word], size)
        if self.held > REMEMBERED_BYTES:
            self._forget()
        return ids, np.diff(np.r_[0, np.cumsum(size)][first])


def _one_by_one(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def decode_flat(model: Model, ids: np.ndarray, size: np.ndarray) -> list[str]:
    """Text of every run of ids."""
    codecs.register_error("byte-by-byte", _one_by_one)
    begin = model.surface_at[ids]
    width = model.surface_at[ids + 1] - begin
    data = _gather(model.surface, begin, width).tobytes()
    ends = np.r_[0, np.cumsum(width)][np.r_[0, np.cumsum(size)]]
    texts = [data[a:b].decode("utf-8", "byte-by-byte") for a, b in zip(ends, ends[1:])]
    # The mark of an unknown piece has a space of its own.
    at = np.cumsum(size) - size
    own = [n > 0 and ids[a] == model.unknown for a, n in zip(at, size)]
    return [t[1:] if t[:1] == " " and not o else t for t, o in zip(texts, own)]


def _lists(ids: np.ndarray, size: np.ndarray) -> pa.Array:
    at = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(ids, pa.int32()))


def encoded(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, ``ids`` (array of int) and ``decoded``, the text those ids give, of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Model.load(model_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        encoder = Encoder(model)
        for batch in by_bytes(batches, "text", PIECE_BYTES):
            ids, size = encoder.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), _lists(ids, size), pa.array(decode_flat(model, ids, size))],
                ["id", "ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    out = in_batches(rows, encode, f"id {kind}, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")


def decoded(df: DataFrame, model_path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the text of their ids; null ids give the empty text."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(Model.load(model_path))

    @F.pandas_udf("string")
    def text_of(lists):
        size = np.array([0 if x is None else len(x) for x in lists], np.int64)
        filled = [np.asarray(x, np.int64) for x in lists if x is not None]
        flat = np.concatenate(filled) if filled else np.zeros(0, np.int64)
        return type(lists)(decode_flat(shared.value, flat, size), index=lists.index)

    return df.withColumn(to, text_of(F.col(f"`{ids_col}`").cast("array<bigint>")))


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of ids, and digests of the ids in decimal and of the decoded text."""
    return df.select(
        id_col, F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
