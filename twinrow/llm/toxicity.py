"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another. Each has a logistic model over words
and word beginnings; later models also see the probabilities of the earlier
categories. For training these come from models that did not see the document
(out of fold), as at scoring time no document has been seen.

**Labels.** ``CATEGORIES`` names the categories in order, each with the label
expression that marks it. A document with several label rows has a category if
any of them says so; a null label leaves the document out of that category.

**Bounded sample.** At most ``LABELLED`` labelled documents train the chain, those
of lowest hashed id. Features are counted on the executors; the ``FEATURES`` that
say most about each category (chi-square) come to the driver, and so do only these
features of the sampled documents.

**Scoring** covers all documents and whole texts, in numpy batches. A null text
counts as empty. Without labels of both kinds a category has the smoothed share
of its labels as probability everywhere, and without any labels zero.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.llm.common import by_bytes, in_batches, settled, thinned, words_of

#: Category and the condition on a label row that marks it.
CATEGORIES = (("junk", "quality = 0"), ("toxic", "toxic = 1"))
#: Category whose documents are rejected, and from which probability on.
REJECT = "toxic"
THRESHOLD = 0.5
#: Labelled documents to train on, features a category, folds.
LABELLED = 20_000
FEATURES = 3_000
FOLDS = 4
#: Features below this chi-square are left out; by chance one in 16,000 reaches it.
APART = 16.0
#: A feature occurs in so many documents at least; a longer word stands as its digest.
LEAST = 4
LONGEST = 40

_EDGES = b".,;:!?\"'()[]{}|#$%&*<>-"


def _features(word: bytes) -> list[str]:
    """A word without punctuation around it, and its beginnings."""
    word = word.strip(_EDGES)
    if not word:
        return []
    text = word.decode("utf-8", "replace")
    own = text if len(word) <= LONGEST else hashlib.blake2b(word, digest_size=16).hexdigest()
    return [own, *[f"{text[:n]}-" for n in (4, 5) if len(text) > n]]


def _present(texts: pa.Array, known: dict[str, int] | None) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Pairs of text and feature, each once, and the features' names.

    With ``known`` only its features count, and their numbers are its values.
    """
    words = words_of(texts)
    coded = words.array().dictionary_encode()
    names: dict[str, int] = {} if known is None else known
    own, number = [], []
    for i, word in enumerate(coded.dictionary.to_pylist()):
        for f in _features(word):
            n = names.setdefault(f, len(names)) if known is None else names.get(f)
            if n is not None:
                own.append(i)
                number.append(n)
    count = np.bincount(own, minlength=len(coded.dictionary)) if own else \
        np.zeros(len(coded.dictionary), np.int64)
    begin = np.cumsum(count) - count
    flat = np.array(number, np.int64)
    code = coded.indices.to_numpy()
    text = np.repeat(np.arange(len(texts)), np.diff(words.first))
    hit = count[code] > 0
    code, text = code[hit], text[hit]
    pairs = np.unique(text * np.int64(max(len(coded.dictionary), 1)) + code)
    text, code = np.divmod(pairs, max(len(coded.dictionary), 1))
    size = count[code]
    shift = begin[code] - (np.cumsum(size) - size)
    feature = flat[np.repeat(shift, size) + np.arange(int(size.sum()))] if len(flat) else flat
    text = np.repeat(text, size)
    both = np.unique(text * np.int64(max(len(names), 1)) + feature)
    text, feature = np.divmod(both, max(len(names), 1))
    return text, feature, list(names) if known is None else []


@dataclass
class Chain:
    """Features, and per category a bias, their weights and those of earlier categories."""

    names: list[str]
    features: dict[str, int]
    bias: list[float] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    earlier: list[np.ndarray] = field(default_factory=list)

    def probabilities(self, rows: int, row: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """Probability of every category for every row."""
        out = np.zeros((rows, len(self.names)))
        for k in range(len(self.names)):
            z = self.bias[k] + np.bincount(row, self.weights[k][feature], minlength=rows)
            z = z + out[:, :k] @ self.earlier[k]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        return out


def _fit(rows, row, feature, more, label, features, rounds=150, penalty=0.03):
    """Logistic regression by gradient steps scaled per weight, with a ridge penalty."""
    w = np.zeros(features)
    v = np.zeros(more.shape[1])
    share = (label.sum() + 0.5) / (rows + 1)
    b = float(np.log(share / (1 - share)))
    if label.all() or not label.any():
        return b, w, v
    slope = np.zeros(1 + features + len(v))
    mean = np.zeros_like(slope)
    for step in range(1, rounds + 1):
        z = b + np.bincount(row, w[feature], minlength=rows) + more @ v
        r = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - label
        g = np.concatenate([
            [r.sum()], np.bincount(feature, r[row], minlength=features) + penalty * w,
            more.T @ r + penalty * v,
        ])
        mean = 0.8 * mean + 0.2 * g
        slope = 0.95 * slope + 0.05 * g * g
        move = 0.15 * (mean / (1 - 0.8**step)) / (np.sqrt(slope / (1 - 0.95**step)) + 1e-6)
        b, w, v = b - move[0], w - move[1 : 1 + features], v - move[1 + features :]
    return float(b), w, v


def fitted(
    names: Sequence[str], features: dict[str, int], rows: int, row: np.ndarray,
    feature: np.ndarray, labels: np.ndarray, fold: np.ndarray,
) -> Chain:
    """The chain for sampled rows; ``labels`` is rows by categories, NaN where unknown."""
    chain = Chain(list(names), features)
    out_of_fold = np.zeros((rows, len(names)))

    def part(of: np.ndarray, k: int):
        """Fit category k on the rows marked in ``of`` whose label is known."""
        use = of & ~np.isnan(labels[:, k])
        to = np.cumsum(use) - 1
        inside = use[row]
        return _fit(int(use.sum()), to[row[inside]], feature[inside], out_of_fold[use, :k],
                    labels[use, k], len(features))

    for k in range(len(names)):
        if np.isnan(labels[:, k]).all():
            b, w, v = -60.0, np.zeros(len(features)), np.zeros(k)
        else:
            for f in range(FOLDS):
                b, w, v = part(fold != f, k)
                own = fold == f
                z = b + np.bincount(row, w[feature], minlength=rows) + out_of_fold[:, :k] @ v
                out_of_fold[own, k] = 1 / (1 + np.exp(-np.clip(z[own], -60, 60)))
            b, w, v = part(np.ones(rows, bool), k)
        chain.bias.append(b)
        chain.weights.append(w)
        chain.earlier.append(v)
    return chain


def train(
    docs: DataFrame, labels: DataFrame, categories: Sequence[tuple[str, str]] = CATEGORIES,
    sample: int = LABELLED, features: int = FEATURES, id_col: str = "doc_id", text_col: str = "text",
) -> Chain:
    """A chain trained on a bounded sample of the labelled documents."""
    names = [name for name, _ in categories]
    marks = [F.max(F.expr(says).cast("int")).alias(f"y{k}") for k, (_, says) in enumerate(categories)]
    y = [f"y{k}" for k in range(len(names))]
    known = labels.where(F.col(f"`{id_col}`").isNotNull())
    chosen = (
        thinned(known, F.col(f"`{id_col}`"), 2 * sample)
        .groupBy(F.col(f"`{id_col}`").alias("id")).agg(*marks)
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    # At most ``sample`` rows of a few numbers, so the broadcasts are bounded.
    keyed = rows.withColumn("print", F.xxhash64("text")).join(F.broadcast(chosen), "id")
    keys = keyed.select("id", "print").distinct()
    firsts = keys.groupBy("id").agg(F.min("print").alias("first"))
    # Every id has one text before any has a second, so an id of many rows takes no other's place.
    kept_keys = (
        keys.join(F.broadcast(firsts), "id")
        .orderBy(F.col("print") != F.col("first"), F.xxhash64("id", "print"), "id", "print").limit(sample)
        .select("id", "print")
    )
    labelled = settled(
        keyed.join(F.broadcast(kept_keys), ["id", "print"]).dropDuplicates(["id", "print"]).select(
            "text", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"), *y
        ),
        "labelled",
    )
    counts = [f"n{k}_{v}" for k in range(len(names)) for v in (0, 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            text, feature, found = _present(batch.column("text"), None)
            columns = [pa.array(found, pa.string())]
            for k in range(len(names)):
                own = batch.column(f"y{k}").to_numpy(zero_copy_only=False).astype(float)[text]
                for v in (0, 1):
                    n = np.bincount(feature[own == v], minlength=len(found))
                    columns.append(pa.array(n, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["feature", *counts])

    seen = in_batches(labelled, count, "feature string, " + ", ".join(f"{c} bigint" for c in counts))
    summed = seen.groupBy("feature").agg(*[F.sum(c).alias(c) for c in counts])
    totals = labelled.agg(
        *[F.count_if(F.col(f"y{k}") == v).alias(f"n{k}_{v}") for k in range(len(names)) for v in (0, 1)]
    ).first()
    index: dict[str, int] = {}
    for k in range(len(names)):
        no, yes = float(totals[f"n{k}_0"]), float(totals[f"n{k}_1"])
        if not no or not yes:
            continue
        a, b = F.col(f"n{k}_1"), F.col(f"n{k}_0")
        apart = a * (no - b) - b * (yes - a)
        scale = (no + yes) / (no * yes)
        chi = apart * apart * scale / ((a + b) * (no + yes - a - b + 1))
        best = (
            summed.where(a + b >= LEAST).withColumn("chi", chi).where(F.col("chi") >= APART)
            .orderBy(F.desc("chi"), "feature").limit(features)
        )
        for r in best.select("feature").collect():
            index.setdefault(r["feature"], len(index))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            text, feature, _ = _present(batch.column("text"), index)
            cut = np.split(feature, np.searchsorted(text, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cut, pa.list_(pa.int64())), *[batch.column(c) for c in ("fold", *y)]],
                ["has", "fold", *y],
            )

    kept = in_batches(
        labelled, pick, "has array<bigint>, fold int, " + ", ".join(f"{c} int" for c in y)
    ).toArrow()
    has = kept["has"].combine_chunks()
    size = np.diff(has.offsets.to_numpy()) if len(has) else np.zeros(0, np.int64)
    numbers = np.stack(
        [kept[c].to_numpy().astype(float) for c in y], axis=1
    ) if len(has) else np.zeros((0, len(names)))
    return fitted(
        names, index, len(has), np.repeat(np.arange(len(has)), size),
        has.flatten().to_numpy() if len(has) else np.zeros(0, np.int64),
        numbers, kept["fold"].to_numpy() if len(has) else np.zeros(0, np.int64),
    )


def scored(
    docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Id and probability ``p_<category>`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    columns = [f"p_{name}" for name in chain.names]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in by_bytes(batches):
            text, feature, _ = _present(batch.column("text"), own.features)
            p = own.probabilities(batch.num_rows, text, feature)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(p[:, k]) for k in range(p.shape[1])]], ["id", *columns]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return in_batches(
        rows, score, f"id {kind}, " + ", ".join(f"{c} double" for c in columns)
    ).withColumnRenamed("id", id_col)


def judged(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Id, probabilities of all categories and ``rejected`` of every row."""
    chain = train(docs, labels, **options)
    columns = {k: v for k, v in options.items() if k in ("id_col", "text_col")}
    return scored(docs, chain, **columns).withColumn(
        "rejected", F.col(f"p_{REJECT}") >= THRESHOLD
    )


def accepted(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows that are not rejected, with all their columns.

    The verdict is taken from each row's own text, so rows that share an id or
    have none are told apart.
    """
    chain = train(docs, labels, text_col=text_col, **options)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    reject = chain.names.index(REJECT)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in by_bytes(batches, text_col):
            text, feature, _ = _present(batch.column(text_col), own.features)
            p = own.probabilities(batch.num_rows, text, feature)
            yield batch.filter(pa.array(p[:, reject] < THRESHOLD))

    return in_batches(docs, keep, docs.schema)
