"""Tables fed to a stream in parts: files of bounded size, whatever the table and its keys."""

import datetime
import glob
import os
import random

import pytest
from conftest import rows

from twinrow.operators import profile
from twinrow.plans import queries, tables

PIECES = 12


def words(pick, n):
    return "".join(chr(pick.randrange(97, 123)) for _ in range(n))


def keys(shape, n):
    return {"distinct": range(n), "null": [None] * n, "one": [7] * n}[shape]


@pytest.fixture
def at(monkeypatch, folder):
    """Runs leave their files here; takes the bytes of a file."""
    monkeypatch.setattr(queries, "run_folder", lambda spark, name: f"{folder}/{name}")

    def bounded(source):
        size = os.path.getsize(glob.glob(f"{source}/part-*")[0])
        monkeypatch.setattr(queries, "FILE_BYTES", size // PIECES, raising=False)
        return size

    return bounded


def fed(run):
    """Sizes of the files, and number of batches."""
    sizes = [os.path.getsize(f) for f in glob.glob(f"{run}/in/part-*")]
    return sizes, len(glob.glob(f"{run}/checkpoint/commits/[0-9]*"))


@pytest.mark.parametrize("shape", ["distinct", "null", "one"])
def test_documents_come_in_small_files(spark, folder, at, shape):
    pick = random.Random(1)
    made = [
        (k, words(pick, 600) if i % 5 else " ", "en" if i % 3 else None, "web", 601)
        for i, k in enumerate(keys(shape, 600))
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(made, schema).coalesce(1).write.parquet(f"{folder}/t/documents.parquet")
    labels = spark.createDataFrame([(7, 1, 0)], "doc_id long, quality long, toxic long")
    labels.write.parquet(f"{folder}/t/labels.parquet")
    size = at(f"{folder}/t/documents.parquet")
    got = queries.stream_blank_counts(spark, f"{folder}/t")
    documents = tables.labelled_documents(spark, f"{folder}/t")
    assert rows(got) == rows(profile.blank_profile(documents, queries.DOC_COLUMNS, "trim"))
    sizes, batches = fed(f"{folder}/stream-blank-counts")
    assert max(sizes) < size / 5
    assert batches == 3
    read = spark.read.schema(documents.schema).parquet(f"{folder}/stream-blank-counts/in")
    assert rows(read) == rows(documents)


@pytest.mark.parametrize("shape", ["distinct", "null", "one"])
def test_events_come_in_small_files(spark, folder, at, shape):
    pick = random.Random(2)
    start = datetime.datetime(2024, 1, 1)
    made = [
        (k, start + datetime.timedelta(minutes=i), i % 9, pick.choice(["click", "view"]), i % 50 / 4,
         '{"k":"%s"}' % words(pick, 200))
        for i, k in enumerate(keys(shape, 600))
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(made, schema).coalesce(1).write.parquet(f"{folder}/t/events.parquet")
    size = at(f"{folder}/t/events.parquet")
    got = queries.stream_reconcile_bounded(spark, f"{folder}/t")
    assert rows(got) == rows(queries.stream_reconcile(spark, f"{folder}/t"))
    sizes, batches = fed(f"{folder}/stream-reconcile-bounded")
    assert max(sizes) < size / 5
    assert batches == 4
    events = tables.table(spark, f"{folder}/t", "events")
    read = spark.read.schema(events.schema).parquet(f"{folder}/stream-reconcile-bounded/in")
    assert rows(read) == rows(events)
