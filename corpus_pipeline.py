"""The corpus pipeline: five stages from raw documents to token ids.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written and
read again as the next one's docs. All but the last return the columns of
``documents``. Each stage is judged on its own input: what an earlier stage
dropped takes no part in it.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from twinrow.llm import exact, leaks, pieces, simhash, toxicity  # noqa: E402
from twinrow.llm.common import settled, table  # noqa: E402


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain does not reject."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked fingerprints the document with the smallest id."""
    return simhash.representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(pieces.encoded(docs, model))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", keep_civil),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", tokenize),
]

# Training, fingerprints and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
