"""A hashed maximum-entropy language model.

Tokens are the words of a text, A-Z in lower case, and one end. The probability of
a token is that of its class times that of the token within its class. Classes
are scored by a softmax over hashed features of the two tokens before it: the last
one (bigram), both (trigram) and the one before the last (skip). Frequent words
share classes of ``WIDTH``, within which a second softmax has features of bigram
and skip; the further words of the vocabulary lie in bands by frequency with
unigram probabilities; all other tokens are one open class, whose members have
their smoothed unigram probability from the full table of counts.

**Corpus.** Tokens of all training documents are counted, and every training
document is seen once by the gradient updates. Each task updates a copy of the
weights over its documents (AdaGrad); the moves of all tasks are averaged, each
row of weights by how often a task used it, in ``ROUNDS`` rounds over disjoint
halves of the documents. The sums run over the cluster in two steps.

**Bounds.** The vocabulary has the end and at most ``VOCABULARY`` tokens of at most ``LONGEST``
bytes and the weight tables have fixed sizes; only these are broadcast. Counts of
all other tokens stay in a table and are joined.

A null text is empty and has its end only. Every row has its own score, so rows
may repeat. Without training documents every token is in the open class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinrow.llm.common import by_bytes, settled, words_of

VOCABULARY = 131_072
#: Bytes of text that are worked on at a time.
PIECE_BYTES = 4_000_000
LONGEST = 64
#: Classes of frequent words, words in each, bands of further words, the open class.
CLOSED, WIDTH, BANDS = 16, 64, 15
CLASSES = CLOSED + BANDS + 1
OPEN = CLASSES - 1
#: Rows of the hashed weight tables, as powers of two.
CLASS_BITS, WORD_BITS = 14, 13
ROUNDS = 2
BATCH = 8192
RATE = 0.15
#: Pieces in which weights are summed over the tasks.
PIECES, SALTS = 16, 8

_NEVER = np.float32(-1e9)
END = b""


def is_held_out(id_: Column) -> Column:
    """Documents whose id, as text, has crc32 with remainder 1 by 5; null is empty."""
    text = F.coalesce(id_.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(5)) == 1


def token_counts(docs: DataFrame) -> DataFrame:
    """``token`` (bytes, the end being empty) and ``c`` over the column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, limit=PIECE_BYTES):
            seen = pc.value_counts(words_of(batch.column("text")).array())
            tokens = pa.concat_arrays([seen.field(0).cast(pa.binary()), pa.array([END], pa.binary())])
            counts = pa.concat_arrays([seen.field(1), pa.array([batch.num_rows], pa.int64())])
            yield pa.RecordBatch.from_arrays([tokens, counts], ["token", "n"])

    parts = docs.select("text").mapInArrow(count, "token binary, n bigint")
    return parts.groupBy("token").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """Frequent tokens, the most frequent first, with class and place of each.

    The end is always among them, with count zero if nothing was counted. Token number ``size`` stands for all others, ``size + 1`` for none.
    """

    tokens: list[bytes]
    cls: np.ndarray
    place: np.ndarray
    inside: np.ndarray  # Log probability within a band; zero elsewhere.
    log_count: np.ndarray  # log10(c + 0.5); zero for the others.
    known: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray
    end: int

    @property
    def size(self) -> int:
        return len(self.tokens)

    @staticmethod
    def of(tokens: list[bytes], counts: np.ndarray, open_mass: float) -> Vocabulary:
        if END not in tokens:
            tokens, counts = [*tokens, END], np.r_[counts, 0]
        order = sorted(range(len(tokens)), key=lambda i: (-counts[i], tokens[i]))
        tokens = [tokens[i] for i in order]
        counts = counts[order].astype(np.float64)
        n = len(tokens)
        rank = np.arange(n)
        front = CLOSED * WIDTH
        edges = np.unique(np.geomspace(front, max(VOCABULARY, front + 2), BANDS + 1)[1:-1].astype(int))
        band = np.minimum(CLOSED + np.searchsorted(edges, rank, side="right"), OPEN - 1)
        cls = np.r_[np.where(rank < front, rank // WIDTH, band), OPEN, OPEN]
        place = np.where(np.arange(n + 2) < front, np.arange(n + 2) % WIDTH, 0)
        mass = np.bincount(cls[:n], counts + 0.5, minlength=CLASSES)
        mass[OPEN] = open_mass
        with np.errstate(divide="ignore"):
            bias = np.where(mass > 0, np.log(mass), _NEVER).astype(np.float32)
        inside = np.zeros(n + 2)
        inside[:n] = np.where(rank < front, 0, np.log(counts + 0.5) - np.log(np.maximum(mass[cls[:n]], 0.5)))
        words = np.full((CLOSED, WIDTH), _NEVER, np.float32)
        few = min(n, front)
        words[cls[:few], place[:few]] = np.log(counts[:few] + 0.5)
        return Vocabulary(
            tokens, cls.astype(np.int64), place.astype(np.int64), inside,
            np.r_[np.log10(counts + 0.5), 0, 0], np.r_[counts > 0, False, False], bias, words,
            tokens.index(END),
        )


@dataclass
class Weights:
    """Rows of class scores and of word scores, by hashed feature."""

    classes: np.ndarray
    words: np.ndarray

    @staticmethod
    def zero() -> Weights:
        return Weights(
            np.zeros((1 << CLASS_BITS, CLASSES), np.float32),
            np.zeros((1 << WORD_BITS, WIDTH), np.float32),
        )


def _hash(a: np.ndarray, b: np.ndarray | int, bits: int) -> np.ndarray:
    """Feature rows from two numbers."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    other = np.full(1, b) if isinstance(b, int) else b
    x ^= other.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Sequence:
    """Numbers of all tokens of some texts, with the two before each."""

    token: np.ndarray
    before: np.ndarray
    skipped: np.ndarray
    first: np.ndarray  # Where each text's tokens begin; one more at the end.
    open_text: np.ndarray  # Text and token of every token outside the vocabulary.
    open_token: pa.Array


def sequence(texts: pa.Array, index: dict[bytes, int], end: int) -> Sequence:
    size = len(index)
    words = words_of(texts)
    array = words.array()
    coded = array.dictionary_encode()
    own = coded.dictionary.to_pylist()
    number = np.fromiter((index.get(w, size) for w in own), np.int64, len(own))
    flat = number[coded.indices.to_numpy()] if len(own) else np.zeros(0, np.int64)
    count = np.diff(words.first)
    first = words.first + np.arange(len(words.first))
    text = np.repeat(np.arange(len(texts)), count)
    token = np.full(len(flat) + len(texts), end, np.int64)
    token[np.arange(len(flat)) + text] = flat
    begins = np.zeros(len(token) + 1, bool)
    begins[first] = True
    begins = begins[:-1]
    none = size + 1
    before = np.r_[none, token[:-1]][: len(token)]
    before[begins] = none
    skipped = np.r_[none, none, token[:-2]][: len(token)]
    skipped[begins] = none
    skipped[1:][begins[:-1]] = none
    other = np.flatnonzero(flat == size)
    return Sequence(token, before, skipped, first, text[other], array.take(pa.array(other)))


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


class Scorer:
    """Probabilities of tokens and, in training, moves of the weights."""

    def __init__(self, vocabulary: Vocabulary, weights: Weights):
        self.v = vocabulary
        self.w = Weights(weights.classes.copy(), weights.words.copy())
        self.index = {t: i for i, t in enumerate(vocabulary.tokens)}

    def _features(self, before, skipped, cls):
        classes = np.stack([
            _hash(before, 1, CLASS_BITS), _hash(before, skipped + 7, CLASS_BITS),
            _hash(skipped, 3, CLASS_BITS),
        ])
        words = np.stack([
            _hash(before, cls * 2 + 1_000_003, WORD_BITS), _hash(skipped, cls * 2 + 2_000_003, WORD_BITS),
        ])
        return classes, words

    def _scores(self, token, before, skipped):
        cls = self.v.cls[token]
        f, g = self._features(before, skipped, cls)
        c = self.w.classes
        p = _softmax(self.v.class_bias + c[f[0]] + c[f[1]] + c[f[2]])
        closed = np.flatnonzero(cls < CLOSED)
        g = g[:, closed]
        q = _softmax(self.v.word_bias[cls[closed]] + self.w.words[g[0]] + self.w.words[g[1]])
        return cls, f, p, closed, g, q

    def log_probability(self, s: Sequence) -> np.ndarray:
        """Natural logarithm for every token, without the share within the open class."""
        out = np.empty(len(s.token))
        for at in range(0, len(s.token), BATCH):
            part = slice(at, at + BATCH)
            token = s.token[part]
            cls, _, p, closed, _, q = self._scores(token, s.before[part], s.skipped[part])
            own = np.log(np.maximum(p[np.arange(len(token)), cls], 1e-30)) + self.v.inside[token]
            place = self.v.place[token[closed]]
            own[closed] += np.log(np.maximum(q[np.arange(len(closed)), place], 1e-30))
            out[part] = own
        return out

    def start_training(self) -> None:
        self.begun = Weights(self.w.classes.copy(), self.w.words.copy())
        self.squares = Weights(np.full_like(self.w.classes, 1.0), np.full_like(self.w.words, 1.0))
        self.used = [np.zeros(len(self.w.classes), np.float32), np.zeros(len(self.w.words), np.float32)]

    def _move(self, rows: np.ndarray, gradient: np.ndarray, table: int) -> None:
        order = np.argsort(rows.ravel().astype(np.uint16), kind="stable")
        own = rows.ravel()[order]
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        total = np.add.reduceat(gradient[order % gradient.shape[0]], start, axis=0)
        at = own[start]
        w, squares = ((self.w.classes, self.squares.classes), (self.w.words, self.squares.words))[table]
        squares[at] += total * total
        w[at] += RATE * total / np.sqrt(squares[at])
        self.used[table][at] += np.diff(np.r_[start, len(own)])

    def learn(self, s: Sequence) -> None:
        """Gradient updates over all tokens, one batch after the other."""
        for at in range(0, len(s.token), BATCH):
            part = slice(at, at + BATCH)
            token = s.token[part]
            cls, f, p, closed, g, q = self._scores(token, s.before[part], s.skipped[part])
            p = -p
            p[np.arange(len(token)), cls] += 1
            self._move(f, p, 0)
            if len(closed):
                q = -q
                q[np.arange(len(closed)), self.v.place[token[closed]]] += 1
                self._move(g, q, 1)

    def moves(self) -> np.ndarray:
        """Per row: how often it was used, and its move times that."""
        return np.concatenate([
            np.concatenate([used[:, None], (new - old) * used[:, None]], axis=1).ravel()
            for new, old, used in (
                (self.w.classes, self.begun.classes, self.used[0]),
                (self.w.words, self.begun.words, self.used[1]),
            )
        ]).astype(np.float32)


def _moved(weights: Weights, moves: np.ndarray) -> Weights:
    cut = weights.classes.shape[0] * (CLASSES + 1)
    out = []
    for old, flat in ((weights.classes, moves[:cut]), (weights.words, moves[cut:])):
        rows = flat.reshape(len(old), -1)
        out.append((old + rows[:, 1:] / np.maximum(rows[:, :1], 1)).astype(np.float32))
    return Weights(*out)


def _summed(moves: DataFrame) -> np.ndarray:
    """Sum of the moves of all tasks: pieces by salt first, then pieces alone."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, raw in zip(batch.column("piece").to_pylist(), batch.column("raw")):
                one = np.frombuffer(raw.as_buffer(), np.float32)
                total[piece] = total[piece] + one if piece in total else one.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([t.tobytes() for t in total.values()], pa.binary())], ["piece", "raw"],
        )

    schema = "piece int, raw binary"
    half = moves.repartition(PIECES * SALTS, "piece", "salt").mapInArrow(add, schema)
    rows = half.repartition(PIECES, "piece").mapInArrow(add, schema).collect()
    by_piece = {r["piece"]: np.frombuffer(r["raw"], np.float32) for r in rows}
    return np.concatenate([by_piece[i] for i in sorted(by_piece)]) if by_piece else np.zeros(0, np.float32)


def trained(docs: DataFrame, vocabulary: Vocabulary) -> Weights:
    """Weights after one pass over ``text`` of all rows; ``turn`` says in which round."""
    spark = docs.sparkSession
    weights = Weights.zero()
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vocabulary, weights))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(*shared.value)  # noqa: B023
            scorer.start_training()
            salt = 0
            for batch in by_bytes(batches, limit=PIECE_BYTES):
                scorer.learn(sequence(batch.column("text"), scorer.index, scorer.v.end))
                salt += batch.num_rows
            if salt:
                pieces = np.array_split(scorer.moves(), PIECES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(PIECES), pa.int32()), pa.array([salt % SALTS] * PIECES, pa.int32()),
                     pa.array([x.tobytes() for x in pieces], pa.binary())], ["piece", "salt", "raw"],
                )

        own = docs.where(F.col("turn") == turn).select("text")
        total = _summed(own.mapInArrow(learn, "piece int, salt int, raw binary"))
        if len(total):
            weights = _moved(weights, total)
        shared.unpersist()
    return weights


@dataclass
class Model:
    """Vocabulary, weights, totals of the training tokens, and all counts as a table."""

    vocabulary: Vocabulary
    weights: Weights
    tokens: int
    types: int
    open_tokens: int
    open_types: int
    rest: DataFrame


def fit(docs: DataFrame, vocabulary: int = VOCABULARY) -> Model:
    """A model of the column ``text`` of all rows."""
    counts = settled(token_counts(docs), "token-counts")
    # Sixteen steps to a power of two: few numbers say how many tokens are how frequent.
    step = F.floor(F.log2("c") * 16).cast("int")
    short = F.octet_length("token") <= LONGEST
    steps = counts.where(short).groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    least, held = 2**31 - 1, 0
    for row in steps:
        held += row["count"]
        if held > vocabulary:
            break
        least = row["step"]
    frequent = (short & (step >= least)) | (F.octet_length("token") == 0)
    rows = counts.where(frequent).toArrow()
    rest = counts.where(~frequent)
    all_of = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, types = all_of["n"] or 0, all_of["v"]
    own = rows["c"].to_numpy()
    open_tokens, open_types = tokens - int(own.sum()), types - len(own)
    words = Vocabulary.of(
        rows["token"].to_pylist(), own, open_tokens + 0.5 * (open_types + 1)
    )
    return Model(words, trained(docs, words), tokens, types, open_tokens, open_types, rest)


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row under a model of the rows that are not held out."""
    id_ = F.col(f"`{id_col}`")
    rows = docs.select(
        id_.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        is_held_out(id_).alias("held_out"),
    )
    training = rows.where(~F.col("held_out")).select(
        "text", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(ROUNDS)).cast("int").alias("turn")
    )
    model = fit(training)
    shared = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        v = scorer.v
        for batch in by_bytes(batches, limit=PIECE_BYTES):
            s = sequence(batch.column("text"), scorer.index, v.end)
            n = batch.num_rows
            log_p = np.add.reduceat(scorer.log_probability(s), s.first[:-1])
            base = np.add.reduceat(v.log_count[s.token], s.first[:-1])
            known = np.add.reduceat(v.known[s.token].astype(np.int64), s.first[:-1])
            # Copies of a token in a text are counted, so they travel once.
            coded = s.open_token.dictionary_encode()
            wide = max(len(coded.dictionary), 1)
            pair, copies = np.unique(s.open_text * np.int64(wide) + coded.indices.to_numpy(),
                                     return_counts=True)
            text, token = np.divmod(pair, wide)
            at = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
            opened = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(
                [coded.dictionary.take(pa.array(token)).cast(pa.binary()), pa.array(copies)],
                ["token", "n"],
            ))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "id", "held_out")]
                + [pa.array(x) for x in (np.diff(s.first), known, base, log_p / np.log(10))] + [opened],
                ["row", "id", "held_out", "n_tokens", "known", "base", "log_p", "opened"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    parts = settled(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            score,
            f"row bigint, id {kind}, held_out boolean, n_tokens bigint, known bigint, "
            "base double, log_p double, opened array<struct<token: binary, n: bigint>>",
        ),
        "scored-parts",
    )
    opened = parts.select("row", F.explode("opened").alias("o")).select("row", "o.token", "o.n")
    c = F.coalesce("c", F.lit(0))
    sums = (
        opened.join(settled(model.rest, "open-counts"), "token", "left")
        .groupBy("row").agg(
            F.sum("n").alias("open"),
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("open_known"),
            F.sum(F.col("n") * F.log10(c + 0.5)).alias("open_log"),
        )
    )
    base_of = float(np.log10(model.tokens + 0.5 * (model.types + 1)))
    open_of = float(np.log10(model.open_tokens + 0.5 * (model.open_types + 1)))
    none = F.lit(0)
    return parts.join(sums, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("open_known", none)).cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("open_log", none) - F.col("n_tokens") * base_of).alias("base_score"),
        (F.col("log_p") + F.coalesce("open_log", none) - F.coalesce("open", none) * open_of).alias("score"),
    )
