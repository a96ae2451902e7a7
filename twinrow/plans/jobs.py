"""The jobs of a user: from sources through operators to sinks.

Batch jobs write whole results to their output path. Without one they print the
first rows as a preview, with the number of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinrow.operators.agreement import mismatch_ids, mismatch_pairs
from twinrow.operators.diff import diff_report
from twinrow.operators.hashing import hash_both, hash_rows
from twinrow.operators.profile import drop_blank
from twinrow.operators.windows import WIDTH
from twinrow.operators.words import word_count
from twinrow.sources import sinks, topics
from twinrow.sources.files import read_csv_rows, read_lines
from twinrow.streaming.bounded import (
    finish_window_report, start_bounded_reconcile, start_window_report,
)
from twinrow.streaming.running import start_reconcile, start_window_diff

# The columns of a CSV row, the labels it is rendered with, the
# columns of a triple, and the default fields and key of a JSON record.
ROW = ["id", "name", "val"]
LABELS = {"Id": "id", "Name": "name", "Val": "val"}
TRIPLE = ["f0", "f1", "f2"]
FIELDS = ["id", "name", "val"]
KEY_FIELDS = ["id"]


def _emit(df: DataFrame, output: str | None, write=sinks.write_text, **options: str) -> None:
    if output:
        write(df, output, **options)
    else:
        sinks.preview(df)


def compare_csv(
    spark: SparkSession, left: str, right: str, output: str | None = None,
    count_pairs: bool = False,
) -> DataFrame:
    """Ids held by two CSV files with different rows: one line per id.

    With ``count_pairs`` the line also tells how many pairs of rows differ, for
    files whose ids repeat.
    """
    sides = [read_csv_rows(spark, path, ROW) for path in (left, right)]
    if count_pairs:
        found = mismatch_pairs(*sides, "id", LABELS)
    else:
        found = mismatch_ids(*sides, "id", LABELS).select("id")
    _emit(found, output)
    return found


def report_csv(
    spark: SparkSession, left: str, right: str, output: str | None = None,
    fields: Sequence[str] = ("name", "val"), key_fields: Sequence[str] = KEY_FIELDS,
) -> DataFrame:
    """Differing fields of two CSV files, in two phases: one line per differing value."""
    found = diff_report(*[read_csv_rows(spark, path, ROW) for path in (left, right)], fields, key_fields)
    _emit(found, output)
    return found


def _clean(
    rows: DataFrame, columns: Sequence[str], rule: str, output: str | None, write
) -> dict[str, object]:
    blanks, kept = Observation("blanks"), Observation("kept")
    clean = drop_blank(rows, columns, rule, blanks).observe(kept, F.count(F.lit(1)).alias("n"))
    if output:
        write(clean, output)
    else:
        # Showing rows stops early, and the counts must cover all of them.
        clean.write.format("noop").mode("overwrite").save()
        sinks.preview(drop_blank(rows, columns, rule))
    return {"kept": kept.get["n"], "blanks": [blanks.get[c] for c in columns]}


def clean_rows(spark: SparkSession, path: str, output: str | None = None) -> dict[str, object]:
    """Write the CSV rows without a blank field; count them and all blanks."""
    return _clean(read_csv_rows(spark, path, ROW), ROW, "unicode", output, sinks.write_text)


def clean_triples(
    spark: SparkSession, source: str | DataFrame, output: str | None = None
) -> dict[str, object]:
    """The same for triples separated by semicolons, or a frame of triples."""
    rows = source if isinstance(source, DataFrame) else read_csv_rows(spark, source, TRIPLE, ";")
    return _clean(rows, TRIPLE, "trim", output, sinks.write_csv)


def count_words(
    spark: SparkSession, inputs: str | Sequence[str], output: str | None = None
) -> DataFrame:
    """Word histogram of one or more text files, written as ``word n`` lines."""
    paths = [inputs] if isinstance(inputs, str) else list(inputs)
    counts = word_count(read_lines(spark, *paths))
    _emit(counts, output, sinks.write_csv, sep=" ")
    return counts


def hash_topic(
    spark: SparkSession, servers: str, topic: str, out_topic: str, checkpoint: str,
    mode: str = "json", fields: Sequence[str] = FIELDS, key_fields: Sequence[str] = KEY_FIELDS,
    envelope: bool = False, strict: bool = True,
) -> StreamingQuery:
    """Hash the records of a topic, in the ``json`` or the ``text`` rendering.

    With ``envelope`` a record is an object of the message key and value. Without
    ``strict`` malformed records are hashed by their whole text.
    """
    records = topics.read_json_topic(spark, servers, topic, envelope, strict)
    hashed = hash_rows(records, fields, key_fields, mode=mode)
    return topics.write_json_topic(topics.encode_hashes(hashed), servers, out_topic, checkpoint)


def reconcile_topics(
    spark: SparkSession, servers: str, left_topic: str, right_topic: str, out_topic: str,
    path: str, checkpoint: str, fields: Sequence[str] = FIELDS,
    key_fields: Sequence[str] = KEY_FIELDS, case_id: int = 1, run_id: int = 1,
    strict: bool = True, envelope: bool = False, bounded: bool = False,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Hash two topics, pass the hash records on and keep what is outstanding.

    Without ``strict`` malformed records take part by their whole text. With
    ``bounded`` records that cancelled out leave the state, and
    ``outstanding_records`` reads the rest.
    """
    left, right = (
        topics.read_json_topic(spark, servers, t, envelope, strict) for t in (left_topic, right_topic)
    )
    hashed = hash_both(left, right, fields, key_fields, case_id, run_id)
    passed = topics.write_json_topic(
        topics.encode_hashes(hashed), servers, out_topic, f"{checkpoint}/passed"
    )
    start = start_bounded_reconcile if bounded else start_reconcile
    return passed, start(hashed, path, f"{checkpoint}/reconcile")


def report_topics(
    spark: SparkSession, servers: str, left_topic: str, right_topic: str,
    path: str, checkpoint: str, left_fields: Sequence[str] = FIELDS,
    right_fields: Sequence[str] = FIELDS, key_fields: Sequence[str] = KEY_FIELDS,
    right_key_fields: Sequence[str] | None = None, width: str = WIDTH, delay: str = WIDTH,
    strict: bool = True, envelope: bool = False, keep_late: bool = False, text: bool = False,
) -> StreamingQuery:
    """Report the differing fields of two topics, window by window.

    Without ``strict`` malformed records take part by their whole text. With
    ``keep_late`` records behind the watermark are kept for ``finish_report``, and
    with ``text`` too the report is also written as lines.
    """
    left, right = (
        topics.read_json_topic(spark, servers, t, envelope, strict) for t in (left_topic, right_topic)
    )
    if text and not keep_late:
        raise ValueError("the report is written as lines only together with keep_late")
    start, more = (start_window_report, {"text": text}) if keep_late else (start_window_diff, {})
    return start(
        left, right, left_fields, key_fields, path, checkpoint, width=width, delay=delay,
        right_fields=right_fields, right_key_fields=right_key_fields, **more,
    )


def finish_report(
    spark: SparkSession, path: str, output: str | None = None,
    left_fields: Sequence[str] = FIELDS, right_fields: Sequence[str] | None = None,
) -> DataFrame:
    """The corrected report of a stopped ``report_topics`` with ``keep_late``: windows still
    open, and those that late records belong to, included."""
    found = finish_window_report(spark, path, left_fields, right_fields)
    _emit(found, output)
    return found
