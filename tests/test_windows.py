import datetime
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from twinrow.functions.render import parse_record
from twinrow.operators import diff, reconcile, windows
from twinrow.operators.hashing import hash_both, hash_rows
from twinrow.sources.sinks import stream_text
from twinrow.streaming import running

START = datetime.datetime(2024, 1, 1)
RECORD = "value string, ts timestamp"


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def frame(spark, items):
    df = spark.createDataFrame([(v, at(s)) for v, s in items], RECORD)
    return df.withColumn("v", parse_record("value"))


LEFT = [('{"id":1,"a":"x"}', 1), ('{"id":2,"a":"x"}', 29), ('{"id":3,"a":"x"}', 31), ('{"id":1,"a":"y"}', 5)]
RIGHT = [('{"id":1,"a":"y"}', 20), ('{"id":2,"a":"y"}', 30), ('{"id":3,"a":"z"}', 59), ('{"id":1,"a":"y"}', 6)]


def test_halves_meet_only_inside_a_window(spark):
    left, right = frame(spark, LEFT), frame(spark, RIGHT)
    pairs = windows.window_join(left, right, ["id"])
    assert pairs.columns == ["window_start", "key_hash", "left", "right"]
    expected = Counter(
        (lv, rv) for lv, ls in LEFT for rv, rs in RIGHT
        if lv[:7] == rv[:7] and ls // 30 == rs // 30
    )
    assert Counter((r.left.value, r.right.value) for r in pairs.collect()) == expected
    salted = windows.window_join(left, right, ["id"], salts=5)
    assert rows(salted) == rows(pairs)


def test_matches_are_the_join_before_multiplying_out(spark):
    left, right = frame(spark, LEFT), frame(spark, RIGHT)
    matches = windows.window_matches(left, right, ["id"])
    one, two = '{"id":1,"a":"x"}', '{"id":1,"a":"y"}'
    got = matches.select("side", "record.value", "left_rows", "right_rows")
    assert rows(got) == sorted([
        ("LEFT", one, 2, 2), ("LEFT", two, 2, 2), ("LEFT", '{"id":3,"a":"x"}', 1, 1),
        ("RIGHT", two, 2, 2), ("RIGHT", two, 2, 2), ("RIGHT", '{"id":3,"a":"z"}', 1, 1),
    ], key=repr)
    got = windows.window_pairs(matches).select("left.value", "right.value", "left_rows", "right_rows")
    assert rows(got) == sorted([
        (one, None, 1, 2), (two, None, 1, 2), (None, two, 2, 1), (None, two, 2, 1),
        ('{"id":3,"a":"x"}', None, 1, 1), (None, '{"id":3,"a":"z"}', 1, 1),
    ], key=repr)


def test_window_diff(spark):
    got = windows.window_diff(frame(spark, LEFT), frame(spark, RIGHT), ["a"], ["id"])
    assert rows(got) == [
        (at(0), "1", "1", "a", '"x"', "a", None, 1, 2),
        (at(0), "1", "1", "a", None, "a", '"y"', 1, 2),
        (at(30), "3", "3", "a", '"x"', "a", None, 1, 1),
        (at(30), "3", "3", "a", None, "a", '"z"', 1, 1),
    ]


# ---------------------------------------------------------------- streams


class Feed:
    """A folder of parquet files that a stream reads, one more per call."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def add(self, items):
        frame(self.spark, items).drop("v").coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        df = self.spark.readStream.schema(RECORD).parquet(self.path)
        return df.withColumn("v", parse_record("value"))


@pytest.fixture
def feeds(spark, folder):
    made = Feed(spark, f"{folder}/left"), Feed(spark, f"{folder}/right")
    for feed in made:
        feed.add([])
    return made


def run(query):
    query.awaitTermination()


def test_stream_join_needs_a_delay(feeds):
    left, right = (f.stream() for f in feeds)
    with pytest.raises(ValueError):
        windows.window_join(left, right, ["id"])


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_join_equals_batch(spark, feeds, folder, salts):
    for feed, items in zip(feeds, (LEFT, RIGHT)):
        feed.add(items)
    pairs = windows.window_join(*(f.stream() for f in feeds), ["id"], delay="1 minute", salts=salts)
    run(running.append_to_table(pairs, f"{folder}/out", f"{folder}/check", availableNow=True))
    batch = windows.window_join(frame(spark, LEFT), frame(spark, RIGHT), ["id"])
    assert rows(spark.read.schema(batch.schema).parquet(f"{folder}/out")) == rows(batch)


def test_late_records_find_no_partner(spark, feeds, folder):
    """A record behind the watermark is dropped; the watermark is the slower side's."""
    left, right = feeds

    def join():
        pairs = windows.window_join(left.stream(), right.stream(), ["id"], delay="10 seconds")
        run(running.append_to_table(pairs, f"{folder}/out", f"{folder}/check", availableNow=True))

    left.add([('{"id":1,"a":"x"}', 1), ('{"id":9}', 300)])
    right.add([('{"id":8}', 300)])
    join()
    right.add([('{"id":1,"a":"late"}', 2), ('{"id":9,"a":"in time"}', 301)])
    join()
    got = spark.read.parquet(f"{folder}/out").select("right.value")
    assert rows(got) == [('{"id":9,"a":"in time"}',)]


def test_reconcile_over_a_restart(spark, feeds, folder):
    """Left records in one run, right ones after a restart from the checkpoint."""
    lefts = [(f'{{"id":{i},"a":"x"}}', i) for i in range(20)]
    rights = [(f'{{"id":{i},"a":"{"x" if i % 3 else "y"}"}}', i) for i in range(2, 22)]
    args = (["id", "a"], ["id"])

    def go():
        hashed = hash_both(*(f.stream() for f in feeds), *args)
        run(running.start_reconcile(hashed, f"{folder}/nets", f"{folder}/check", availableNow=True))

    feeds[0].add(lefts)
    go()
    assert running.reconciled(spark, f"{folder}/nets").where("net = 1").count() == 20
    feeds[1].add(rights[:5])
    go()
    feeds[1].add(rights[5:])
    go()
    batch = reconcile.reconcile(hash_both(frame(spark, lefts), frame(spark, rights), *args))
    streamed = running.reconciled(spark, f"{folder}/nets")
    columns = ["case_id", "run_id", "key_hash", "status"]
    assert rows(reconcile.outstanding_status(streamed).select(columns)) == rows(
        reconcile.outstanding_status(batch).select(columns)
    )
    assert rows(streamed) == rows(batch.select(streamed.columns))


def test_window_diff_over_a_restart(spark, feeds, folder):
    """Windows are reported once closed, open ones after the restart."""
    ends = [('{"id":"end"}', 500)]

    def go():
        run(running.start_window_diff(
            *(f.stream() for f in feeds), ["a"], ["id"], f"{folder}/out", f"{folder}/check",
            delay="5 seconds", availableNow=True,
        ))

    for feed, items in zip(feeds, (LEFT, RIGHT)):
        feed.add(items)
    go()
    early = running.window_report(spark, f"{folder}/out").count()
    for feed in feeds:
        feed.add(ends)
    go()
    got = running.window_report(spark, f"{folder}/out")
    batch = windows.window_diff(frame(spark, LEFT), frame(spark, RIGHT), ["a"], ["id"])
    assert early < got.count()
    assert rows(got.select(batch.columns)) == rows(batch)


def test_stream_and_batch_agree_on_one_row_against_equal_ones(spark, feeds, folder):
    left, right = [('{"id":1,"a":"x"}', 1)], [('{"id":1,"a":"y"}', s) for s in (2, 3, 4)]
    for feed, items in zip(feeds, (left, right)):
        feed.add(items + [('{"id":"end"}', 500)])
    run(running.start_window_diff(
        *(f.stream() for f in feeds), ["a"], ["id"], f"{folder}/out", f"{folder}/check",
        delay="5 seconds", availableNow=True,
    ))
    batch = windows.window_diff(frame(spark, left), frame(spark, right), ["a"], ["id"])
    assert [r[-2:] for r in rows(batch)] == [(1, 3), (1, 3)]
    assert rows(running.window_report(spark, f"{folder}/out").select(batch.columns)) == rows(batch)


def test_open_windows_are_reported_at_the_end(spark, feeds, folder):
    for feed, items in zip(feeds, (LEFT, RIGHT)):
        feed.add(items)
        feed.add([('{"id":"end"}', 45)])

    def go():
        query = running.start_window_diff(
            *(f.stream() for f in feeds), ["a"], ["id"], f"{folder}/out", f"{folder}/check",
            delay="5 seconds", availableNow=True,
        )
        run(query)
        return query

    assert running.late_rows(go()) == 0
    feeds[0].add([('{"id":7,"a":"too late"}', 2)])
    assert running.late_rows(go()) == 1
    early = running.window_report(spark, f"{folder}/out").count()
    running.finish_window_diff(spark, f"{folder}/out", f"{folder}/check", ["a"])
    got = running.window_report(spark, f"{folder}/out")
    batch = windows.window_diff(frame(spark, LEFT), frame(spark, RIGHT), ["a"], ["id"])
    assert early < got.count()
    assert rows(got.select(batch.columns)) == rows(batch)


def test_stream_matches_equal_batch(spark, feeds, folder):
    for feed, items in zip(feeds, (LEFT, RIGHT)):
        feed.add(items + items[:1])
    run(running.start_window_matches(
        *(f.stream() for f in feeds), ["id"], f"{folder}/out", f"{folder}/check", availableNow=True,
    ))
    running.finish_window_matches(spark, f"{folder}/out", f"{folder}/check")
    sides = [frame(spark, items + items[:1]) for items in (LEFT, RIGHT)]
    batch = windows.window_matches(*sides, ["id"])
    assert rows(running.stream_matches(spark, f"{folder}/out").select(batch.columns)) == rows(batch)


def test_hashing_a_stream_to_text(spark, feeds, folder):
    feeds[0].add(LEFT)
    hashed = hash_rows(feeds[0].stream(), ["id", "a"], ["id"])
    run(stream_text(hashed, f"{folder}/out", f"{folder}/check", availableNow=True))
    batch = hash_rows(frame(spark, LEFT), ["id", "a"], ["id"])
    expected = [(f"({r.keys},{r.key_hash},{r.value_hash})",) for r in batch.select(
        F.col("keys"), "key_hash", "value_hash").collect()]
    assert rows(spark.read.text(f"{folder}/out")) == sorted(expected, key=repr)


def test_report_columns():
    assert diff.REPORT[:6] == [
        "left_key", "right_key", "left_field", "left_value", "right_field", "right_value",
    ]
