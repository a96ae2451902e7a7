"""Bounded reconciliation and window reports: equal to the batch forms across restarts,
merges and failures, with every record accounted for."""

import datetime
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from twinrow.functions.render import parse_record
from twinrow.operators import reconcile as batch_form
from twinrow.operators import windows
from twinrow.operators.hashing import hash_both
from twinrow.session import exists
from twinrow.streaming import bounded, running
from twinrow.streaming.ledger import Ledger

START = datetime.datetime(2024, 1, 1)
RECORD = "value string, ts timestamp"
ONE_FILE = {"availableNow": True}


class Feed:
    """A folder of files; each call adds one, which the stream takes as a batch of its own."""

    def __init__(self, spark, path):
        self.spark, self.path, self.all = spark, path, []
        self.add([])

    def add(self, items):
        self.all += items
        made = [(v, None if s is None else START + datetime.timedelta(seconds=s)) for v, s in items]
        frame = self.spark.createDataFrame(made, RECORD)
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        df = self.spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(self.path)
        return df.withColumn("v", parse_record("value"))

    def batch(self):
        return self.spark.read.schema(RECORD).parquet(self.path).withColumn("v", parse_record("value"))


@pytest.fixture
def feeds(spark, folder):
    return Feed(spark, f"{folder}/left"), Feed(spark, f"{folder}/right")


def some(seed, n, keys=6, values="xyz", late=0):
    pick = random.Random(seed)
    return [
        ('{"id":%d,"a":"%s"}' % (pick.randrange(keys), pick.choice(values)), pick.randrange(seed * 40, seed * 40 + 60) - (pick.random() < 0.2) * late)
        for _ in range(n)
    ]


# ------------------------------------------------------------------ ledger

SUMS = StructType().add("k", "string").add("n", "long").add("m", "long")


def test_ledger_adds_up_and_forgets_what_cancels(spark, folder):
    pick = random.Random(1)
    total = Counter()
    for batch in range(15):
        ledger = Ledger(spark, folder, SUMS, ["k"], fan_in=3)  # as after a restart
        assert not ledger.has(batch)
        items = [(pick.choice("abcdef"), pick.choice([-1, 1]), 0) for _ in range(3)]
        if batch % 7 == 6:
            items = [(k, -n, 0) for k, n in total.items()]
        total.update({k: 0 for k, *_ in items})
        for k, n, _ in items:
            total[k] += n
        spark.createDataFrame(items, SUMS).write.parquet(f"{folder}/b{batch}")
        ledger.add(batch, f"b{batch}", len(items), {"seen": batch})
        ledger.compact()
        assert ledger.has(batch) and len(ledger.state.runs) <= 2 * 4
        assert {r.k: r.n for r in ledger.records().collect()} == {k: n for k, n in total.items() if n}
    assert ledger.state.marks == {"seen": 14}
    assert not exists(spark, f"{folder}/b0") and ledger.held_bytes() > 0
    assert ledger.held_rows() <= 6 * len(ledger.state.runs)
    with pytest.raises(ValueError):
        Ledger(spark, folder, SUMS, ["k"], fan_in=1)


def test_a_merge_that_failed_is_repeated(spark, folder, monkeypatch):
    ledger = Ledger(spark, folder, SUMS, ["k"], fan_in=2)
    for batch in range(2):
        spark.createDataFrame([("a", 1, 0), ("b", 1 - 2 * batch, 0)], SUMS).write.parquet(f"{folder}/b{batch}")
        ledger.add(batch, f"b{batch}", 2)
    monkeypatch.setattr(Ledger, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ledger.compact()
    monkeypatch.undo()
    again = Ledger(spark, folder, SUMS, ["k"], fan_in=2)
    assert rows(again.records()) == [("a", 2, 0)]
    assert again.compact() == 1 and rows(again.records()) == [("a", 2, 0)]
    assert [r[1:] for r in again.state.runs] == [(1, 1)]


# ---------------------------------------------------------- reconciliation


def hashed(feeds, form):
    return hash_both(*(getattr(f, form)() for f in feeds), ["id", "a"], ["id"], case_id=1, run_id=2)


def test_bounded_reconcile_equals_batch_across_merges_and_restarts(spark, feeds, folder):
    path, checkpoint = f"{folder}/out", f"{folder}/check"
    for step in range(5):
        feeds[0].add(some(step + 1, 12))
        feeds[1].add(some(step + 2, 12))
        bounded.start_bounded_reconcile(
            hashed(feeds, "stream"), path, checkpoint, fan_in=2, availableNow=True
        ).awaitTermination()
        want = batch_form.outstanding(batch_form.reconcile(hashed(feeds, "batch")))
        got = bounded.outstanding_records(spark, path)
        assert rows(got.select(want.columns)) == rows(want)
    ledger = bounded.reconcile_ledger(spark, path)
    assert ledger.state.batch >= 5 and len(ledger.state.runs) <= 5
    assert max(r[1] for r in ledger.state.runs) >= 2


def test_cancelled_records_leave(spark, feeds, folder):
    items = [('{"id":%d,"a":"x"}' % i, 0) for i in range(500)]
    for lo in range(0, 500, 125):
        feeds[0].add(items[lo : lo + 125])
    for lo in range(0, 500, 125):
        feeds[1].add(items[lo : lo + 125])
    bounded.start_bounded_reconcile(
        hashed(feeds, "stream"), f"{folder}/out", f"{folder}/check", fan_in=2, availableNow=True
    ).awaitTermination()
    ledger = bounded.reconcile_ledger(spark, f"{folder}/out")
    assert ledger.records().isEmpty()
    assert ledger.held_rows() < 500


def test_a_batch_is_applied_once(spark, feeds, folder, monkeypatch):
    feeds[0].add(some(1, 20))
    path, checkpoint = f"{folder}/out", f"{folder}/check"
    lost = Ledger.compact

    def fails(self, keep=None):
        lost(self, keep)
        raise OSError("lost after the commit of the ledger, before that of the stream")

    monkeypatch.setattr(Ledger, "compact", fails)
    for _ in range(2):
        with pytest.raises(Exception):
            bounded.start_bounded_reconcile(hashed(feeds, "stream"), path, checkpoint, availableNow=True).awaitTermination()
    monkeypatch.undo()
    bounded.start_bounded_reconcile(hashed(feeds, "stream"), path, checkpoint, availableNow=True).awaitTermination()
    want = batch_form.outstanding(batch_form.reconcile(hashed(feeds, "batch")))
    assert rows(bounded.outstanding_records(spark, path).select(want.columns)) == rows(want)


def test_empty_streams(spark, feeds, folder):
    path = f"{folder}/out"
    assert bounded.outstanding_records(spark, path).isEmpty()
    assert running.reconciled(spark, path).isEmpty() and running.window_report(spark, path).isEmpty()
    assert bounded.running_report(spark, path).isEmpty() and bounded.report_lines(spark, path).isEmpty()
    bounded.start_window_report(
        *(f.stream() for f in feeds), ["a"], ["id"], path, f"{folder}/check", availableNow=True
    ).awaitTermination()
    assert bounded.finish_window_report(spark, path, ["a"]).isEmpty()
    assert bounded.tally_of(spark, path) == {"closed": 0, "open": 0, "late": 0}


# ----------------------------------------------------------- window report


def report(feeds, folder, **options):
    bounded.start_window_report(
        *(f.stream() for f in feeds), ["a"], ["id"], f"{folder}/out", f"{folder}/check",
        delay="20 seconds", fan_in=2, availableNow=True, **options,
    ).awaitTermination()


def test_corrected_report_equals_batch_with_late_records(spark, feeds, folder):
    path = f"{folder}/out"
    for step in range(1, 6):
        for feed, more in zip(feeds, (0, 10)):
            feed.add(some(step + more * 0, 15, late=100) if step % 2 else some(step, 15))
        report(feeds, folder, text=True)
        seen = bounded.tally_of(spark, path)
        assert sum(seen.values()) == sum(len(f.all) for f in feeds)
        assert seen["late"] == bounded.late_count(spark, path)
        got = bounded.finish_window_report(spark, path, ["a"])
        want = windows.window_diff(*(f.batch() for f in feeds), ["a"], ["id"])
        assert rows(got.select(want.columns)) == rows(want)
    assert seen["late"] > 0 and seen["closed"] > 0
    ledger = bounded.window_ledger(spark, path)
    assert max(r[1] for r in ledger.state.runs) >= 1
    # The running report holds the closed windows as they were, and its lines say the same.
    running = bounded.running_report(spark, path)
    assert bounded.report_lines(spark, path).count() == running.count() > 0


def test_records_without_a_time_are_late(spark, feeds, folder):
    feeds[0].add([('{"id":1,"a":"x"}', None), ('{"id":1,"a":"x"}', 5)])
    feeds[1].add([('{"id":1,"a":"y"}', None), ('{"id":1,"a":"y"}', 6)])
    report(feeds, folder)
    assert bounded.tally_of(spark, f"{folder}/out") == {"closed": 0, "open": 2, "late": 2}
    got = bounded.finish_window_report(spark, f"{folder}/out", ["a"])
    assert rows(got) == rows(windows.window_diff(*(f.batch() for f in feeds), ["a"], ["id"]).select(got.columns))


def test_a_failed_batch_leaves_no_double_line(spark, feeds, folder, monkeypatch):
    path = f"{folder}/out"
    feeds[0].add(some(1, 10))
    feeds[1].add(some(1, 10, values="pq"))
    feeds[0].add([('{"id":1,"a":"end"}', 900)])
    feeds[1].add([('{"id":1,"a":"end"}', 900)])
    add = Ledger.add
    failed = []

    def fails(self, batch, *rest):
        if self.state.marks.get("watermark") is None and rest[2].get("watermark") and not failed:
            failed.append(batch)
            raise OSError("lost before the manifest")
        add(self, batch, *rest)

    monkeypatch.setattr(Ledger, "add", fails)
    with pytest.raises(Exception):
        while True:
            report(feeds, folder, text=True)
    report(feeds, folder, text=True)
    assert failed
    lines = [r.value for r in bounded.report_lines(spark, path).collect()]
    want = windows.window_diff(*(f.batch() for f in feeds), ["a"], ["id"]).where(F.col("window_start") < F.lit(START + datetime.timedelta(seconds=800)))
    assert len(lines) == want.count() == len(set(lines))


def test_windows_of_arrival_stay_the_same_after_a_failure(spark, feeds, folder, monkeypatch):
    feeds[0].add([('{"id":1,"a":"x"}', 1)])
    feeds[1].add([('{"id":1,"a":"y"}', 999)])
    path = f"{folder}/out"

    def start():
        bounded.start_window_report(
            *(f.stream() for f in feeds), ["a"], ["id"], path, f"{folder}/check", ts=None, availableNow=True
        ).awaitTermination()

    add, stamps = Ledger.add, []

    def fails(self, *rest):
        stamps.append(self.state.marks["stamp"])
        raise OSError("lost")

    monkeypatch.setattr(Ledger, "add", fails)
    with pytest.raises(Exception):
        start()
    monkeypatch.setattr(Ledger, "add", lambda self, *rest: (stamps.append(self.state.marks["stamp"]), add(self, *rest)))
    start()
    assert len(stamps) >= 2 and stamps[0] == stamps[1]
    met = rows(bounded.finish_window_report(spark, path, ["a"]).select("left_value", "right_value"))
    assert met == [('"x"', None), (None, '"y"')]


def test_clean_rows_of_a_stream_equal_the_batch(spark, folder, monkeypatch):
    items = [("a", "b"), (" ", "c"), (None, ""), ("d", "e"), ("f", "\t")]
    schema = StructType().add("x", "string").add("y", "string")
    path, checkpoint = f"{folder}/out", f"{folder}/check"
    assert bounded.clean_rows(spark, path, schema).isEmpty()
    add, failed = Ledger.add, []

    def fails(self, batch, *rest, **more):
        add(self, batch, *rest, **more)
        if batch == 1 and not failed:
            failed.append(batch)
            raise OSError("lost after the manifest")

    monkeypatch.setattr(Ledger, "add", fails)
    for step in range(3):
        spark.createDataFrame(items[step:], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        for _ in range(2):
            try:
                bounded.start_clean(stream, ["x", "y"], path, checkpoint, availableNow=True).awaitTermination()
                break
            except Exception:
                assert failed
    every = [i for step in range(3) for i in items[step:]]
    blank = [[v is None or not v.strip() for v in i] for i in every]
    assert failed and bounded.clean_counts(spark, path) == {
        "kept": sum(not any(b) for b in blank), "blanks": {"x": sum(b[0] for b in blank), "y": sum(b[1] for b in blank)},
    }
    assert rows(bounded.clean_rows(spark, path, schema)) == sorted((i for i, b in zip(every, blank) if not any(b)), key=repr)
