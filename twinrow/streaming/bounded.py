"""Running comparisons whose state is a ledger of what is still needed.

**Reconciliation.** Equal records of opposite sides cancel, and cancelled ones leave
the ledger when runs are merged. What is held follows the outstanding records and
the latest batches, not the length of the history; there is no state store.

**Window report.** Records are counted by window, key and content. The report of a
window is written when the watermark passes its end: the lesser of both sides'
latest times, less the delay. Counted records of closed windows leave the ledger.
What comes behind the watermark is not lost: each batch is split by the watermark
of the batch before it, and late records go to a table of their own, which
``finish_window_report`` merges into a corrected report. Every record of the input is
in exactly one window or late, and the counts of both are exact.

**Blank counts.** Rows of a stream without a blank field are written batch by batch, and
the blanks of all rows are counted in the same pass and added up in the manifest.

All start from stateless streams, so whatever a batch writes is written before the
manifest names it, and a batch that failed is repeated with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, LongType, StringType, StructField, StructType, TimestampType,
)

from twinrow.operators.agreement import both_sides
from twinrow.operators.diff import check_fields, diff_rendered, keyed, rendered
from twinrow.operators.profile import drop_blank
from twinrow.operators.reconcile import RECORD, reconcile
from twinrow.operators.windows import WIDTH
from twinrow.sources.sinks import text_lines
from twinrow.streaming.ledger import FAN_IN, Ledger

_LONG, _TEXT, _TIME = LongType(), StringType(), TimestampType()


def _schema(*columns: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns])


NETS = _schema(("case_id", _LONG), ("run_id", _LONG), ("key_hash", _TEXT), ("value_hash", _TEXT), ("net", _LONG))

CONTENT = ["window_start", "window_end", "keys", "key", "texts"]
COUNTED = _schema(
    ("window_start", _TIME), ("window_end", _TIME), ("keys", _TEXT), ("key", _TEXT), ("texts", ArrayType(_TEXT)),
    ("l", _LONG), ("r", _LONG),
)
REPORT = _schema(
    ("window_start", _TIME),
    *[(c, _TEXT) for c in ("left_key", "right_key", "left_field", "left_value", "right_field", "right_value")],
    ("left_rows", _LONG), ("right_rows", _LONG),
)


def _and(schema: StructType, *columns: tuple[str, DataType]) -> StructType:
    return StructType([*schema.fields, *_schema(*columns).fields])


def _started(stream: DataFrame, write, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


# ---------------------------------------------------------- reconciliation


def reconcile_ledger(spark: SparkSession, path: str, fan_in: int = FAN_IN) -> Ledger:
    return Ledger(spark, path, NETS, RECORD, fan_in)


def start_bounded_reconcile(
    hashed: DataFrame, path: str, checkpoint: str, fan_in: int = FAN_IN, **trigger: object
) -> StreamingQuery:
    """Reconcile a stream of tagged hash records without end.

    A batch adds the nets of its own records. ``outstanding_records`` reads what is left.
    """
    ledger = reconcile_ledger(hashed.sparkSession, path, fan_in)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not ledger.has(batch_id):
            folder = f"batches/batch_id={batch_id}"
            nets = reconcile(batch).where("net <> 0").select(*NETS.names)
            nets.write.mode("overwrite").parquet(f"{ledger.path}/{folder}")
            rows = ledger.spark.read.schema(NETS).parquet(f"{ledger.path}/{folder}").count()
            ledger.add(batch_id, folder, rows)
        ledger.compact()

    return _started(hashed, write, checkpoint, trigger)


def outstanding_records(spark: SparkSession, path: str) -> DataFrame:
    """Records without an equal on the other side so far, with their net count."""
    return reconcile_ledger(spark, path).records()


# ----------------------------------------------------------- window report


def window_ledger(spark: SparkSession, path: str, fan_in: int = FAN_IN) -> Ledger:
    return Ledger(spark, path, COUNTED, CONTENT, fan_in)


def _micros(time: Column) -> Column:
    return F.unix_micros(time)


def _report(records: DataFrame, left_fields: Sequence[str], right_fields: Sequence[str]) -> DataFrame:
    """Report over counted records of whole windows."""
    content = ["window_start", "keys", "key", "texts"]
    sides = [records.where(f"{n} > 0").select(*content, F.col(n).alias("n")) for n in ("l", "r")]
    return diff_rendered(
        *sides, left_fields, right_fields, on=["window_start", "keys"], keep=["window_start"]
    ).select(*REPORT.names)


def _written(df: DataFrame, schema: StructType, folder: str) -> DataFrame:
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder)


def start_window_report(
    left: DataFrame, right: DataFrame, left_fields: Sequence[str], key_fields: Sequence[str],
    path: str, checkpoint: str, ts: str | None = "ts", width: str = WIDTH, delay: str = WIDTH,
    right_fields: Sequence[str] | None = None, right_key_fields: Sequence[str] | None = None,
    fan_in: int = FAN_IN, text: bool = False, **trigger: object,
) -> StreamingQuery:
    """Report differing fields of each window once the watermark has passed its end.

    With ``text`` the report is also written as lines, to the folder ``lines``, each
    batch once. A record without a time belongs to no window and is late. Without
    ``ts`` windows are of the time of arrival: a batch is stamped before it is first
    worked on, and keeps its stamp when it is repeated, so windows stay the same.
    """
    right_fields = list(right_fields or left_fields)
    check_fields(left_fields, right_fields)
    ledger = window_ledger(left.sparkSession, path, fan_in)
    spark, root = ledger.spark, ledger.path
    time = [] if ts is None else [F.col(f"`{ts}`").cast("timestamp").alias("at")]
    sides = [
        rendered(
            keyed(side, fields, keys, keep=time),
            fields, keys, on=[*(["at"] if time else []), "keys"],
        )
        for side, fields, keys in (
            (left, left_fields, key_fields), (right, right_fields, right_key_fields or key_fields),
        )
    ]
    arrivals = both_sides(*sides, n="n").drop("n")
    wait = spark.range(1).select(
        F.expr(f"unix_micros(timestamp_micros(0) + interval '{delay}')")
    ).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        if not ledger.has(batch_id):
            marks = dict(ledger.state.marks)
            passed = marks.get("watermark")
            if ts is None:
                marks["stamp"] = [batch_id, ledger.stamp(batch_id)]
                batch = batch.withColumn("at", F.timestamp_micros(F.lit(marks["stamp"][1])))
            # A record without a time would be dropped by the window, so it stands at
            # another while windows are made.
            window = F.window(F.coalesce("at", F.timestamp_micros(F.lit(0))), width)
            batch = batch.withColumn("w", window).withColumns(
                {f"window_{e}": F.when(F.col("at").isNotNull(), F.col(f"w.{e}")) for e in ("start", "end")}
            )
            late = F.lit(False) if passed is None else _micros(F.col("window_end")) <= passed
            late |= F.col("window_end").isNull()
            latest = [
                F.max(F.when(F.col(n) > 0, _micros(F.col("at")))).alias(f"last_{n}") for n in ("l", "r")
            ]
            counted = (
                batch.groupBy(*CONTENT, F.coalesce(late, F.lit(True)).alias("late"))
                .agg(F.sum("l").alias("l"), F.sum("r").alias("r"), *latest)
            )
            # One write of the batch, parted into what is on time and what is late.
            folder = f"arrived/batch_id={batch_id}"
            counted.write.mode("overwrite").partitionBy("late").parquet(f"{root}/{folder}")
            schema = _and(COUNTED, ("last_l", _LONG), ("last_r", _LONG), ("late", BooleanType()))
            seen = spark.read.schema(schema).parquet(f"{root}/{folder}").agg(
                F.max("last_l").alias("l"), F.max("last_r").alias("r"),
                F.count_if(~F.col("late")).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("late"), F.col("l") + F.col("r"))), F.lit(0)).alias("late"),
            ).first()
            for side in ("l", "r"):
                marks[side] = max((m for m in (marks.get(side), seen[side]) if m is not None), default=None)
            if marks["l"] is not None and marks["r"] is not None:
                marks["watermark"] = max(min(marks["l"], marks["r"]) - wait, passed if passed is not None else -(2**62))
            marks["late"] = marks.get("late", 0) + seen["late"]
            run = f"{folder}/late=false" if seen["rows"] else None
            now = marks.get("watermark")
            if now is not None and now != passed:
                ended = _micros(F.col("window_end")) <= now
                if passed is not None:
                    ended &= _micros(F.col("window_end")) > passed
                rows = ledger.summed(ledger.read(*([run] if run else [])).where(ended))
                if _close(ledger, rows, batch_id, left_fields, right_fields, text):
                    marks["closed"] = True
            ledger.add(batch_id, run, seen["rows"], marks)
        passed = ledger.state.marks.get("watermark")
        ledger.compact(None if passed is None else _micros(F.col("window_end")) > passed)

    return _started(arrivals, write, checkpoint, trigger)


def _close(
    ledger: Ledger, rows: DataFrame, batch_id: int, left_fields: Sequence[str],
    right_fields: Sequence[str], text: bool,
) -> bool:
    """Writes the records and the report of windows that have ended; whether there are any."""
    closed = _written(rows, COUNTED, f"{ledger.path}/closed/batch_id={batch_id}")
    if closed.isEmpty():
        return False
    found = _written(
        _report(closed, left_fields, right_fields), REPORT, f"{ledger.path}/report/batch_id={batch_id}"
    )
    if text:
        text_lines(found).write.mode("overwrite").text(f"{ledger.path}/lines/batch_id={batch_id}")
    return True


def _committed(ledger: Ledger, what: str, schema: StructType) -> DataFrame:
    """What batches in the manifest wrote; an empty frame if none did."""
    if not ledger.state.marks.get("closed"):
        return ledger.spark.createDataFrame([], schema)
    with_batch = _and(schema, ("batch_id", _LONG))
    read = ledger.spark.read
    folder = f"{ledger.path}/{what}"
    rows = read.text(folder) if what == "lines" else read.schema(with_batch).parquet(folder)
    return rows.where(F.col("batch_id") <= ledger.state.batch).select(*schema.names)


def running_report(spark: SparkSession, path: str) -> DataFrame:
    """Report rows of all windows closed so far, late records left out."""
    return _committed(window_ledger(spark, path), "report", REPORT)


def report_lines(spark: SparkSession, path: str) -> DataFrame:
    """The report as lines of text, of a stream started with ``text``."""
    return _committed(window_ledger(spark, path), "lines", _schema(("value", _TEXT)))


def late_records(spark: SparkSession, path: str) -> DataFrame:
    """Counted records that came behind the watermark."""
    ledger = window_ledger(spark, path)
    if not ledger.state.marks.get("late"):
        return spark.createDataFrame([], COUNTED)
    parted = _and(COUNTED, ("batch_id", _LONG), ("late", BooleanType()))
    rows = spark.read.schema(parted).parquet(f"{ledger.path}/arrived")
    return rows.where(F.col("late") & (F.col("batch_id") <= ledger.state.batch)).select(*COUNTED.names)


def late_count(spark: SparkSession, path: str) -> int:
    """Records of both sides that came behind the watermark, over all batches."""
    return window_ledger(spark, path).state.marks.get("late", 0)


def finish_window_report(
    spark: SparkSession, path: str, left_fields: Sequence[str],
    right_fields: Sequence[str] | None = None,
) -> DataFrame:
    """The corrected report at the end of the input: windows still open are reported
    too, and windows that late records belong to anew, with those records.

    It is written to the folder ``corrected`` and returned. The stream's own tables stay
    as they are, so a stream that gets more input may go on, and finish again.
    """
    right_fields = list(right_fields or left_fields)
    ledger = window_ledger(spark, path)
    late = ledger.summed(late_records(spark, path))
    windows = _written(
        late.select("window_start").distinct(), _schema(("window_start", _TIME)),
        f"{ledger.path}/corrected/windows",
    )
    passed = ledger.state.marks.get("watermark")
    open_ = ledger.records()
    if passed is not None:
        open_ = open_.where(_micros(F.col("window_end")) > passed)
    closed = _committed(ledger, "closed", COUNTED)
    anew = ledger.summed(
        open_.unionByName(closed.join(windows, "window_start", "left_semi")).unionByName(late)
    )
    anew = _written(anew, COUNTED, f"{ledger.path}/corrected/records")
    kept = _committed(ledger, "report", REPORT).join(windows, "window_start", "left_anti")
    corrected = kept.select(*REPORT.names).unionByName(_report(anew, left_fields, right_fields))
    return _written(corrected, REPORT, f"{ledger.path}/corrected/report")


def tally_of(spark: SparkSession, path: str) -> dict[str, int]:
    """How many records are in closed windows, in open ones, and late."""
    ledger = window_ledger(spark, path)
    passed = ledger.state.marks.get("watermark")
    open_ = ledger.records()
    if passed is not None:
        open_ = open_.where(_micros(F.col("window_end")) > passed)
    both = F.coalesce(F.sum(F.col("l") + F.col("r")), F.lit(0))
    return {
        "closed": _committed(ledger, "closed", COUNTED).agg(both).first()[0],
        "open": open_.agg(both).first()[0],
        "late": late_records(spark, path).agg(both).first()[0],
    }


# ----------------------------------------------------------- blank counts


def _clean_ledger(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, path, _schema(("row", _TEXT), ("n", _LONG)), ["row"])


def start_clean(
    rows: DataFrame, columns: Sequence[str], path: str, checkpoint: str, rule: str = "trim", **trigger: object
) -> StreamingQuery:
    """Write the rows of a stream without a blank field, and count blanks and kept rows.

    Each batch counts once, also when it is repeated.
    """
    ledger = _clean_ledger(rows.sparkSession, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        if ledger.has(batch_id):
            return
        blanks, kept = Observation("blanks"), Observation("kept")
        clean = drop_blank(batch, columns, rule, blanks).observe(kept, F.count(F.lit(1)).alias("n"))
        clean.write.mode("overwrite").parquet(f"{ledger.path}/clean/batch_id={batch_id}")
        counts = ledger.state.marks.get("blanks", {})
        ledger.add(batch_id, None, marks={
            "closed": True, "kept": ledger.state.marks.get("kept", 0) + (kept.get["n"] or 0),
            "blanks": {c: counts.get(c, 0) + (blanks.get[c] or 0) for c in columns},
        })

    return _started(rows, write, checkpoint, trigger)


def clean_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows kept so far."""
    return _committed(_clean_ledger(spark, path), "clean", schema)


def clean_counts(spark: SparkSession, path: str) -> dict[str, object]:
    """Rows kept so far, and blanks of every column over all rows."""
    marks = _clean_ledger(spark, path).state.marks
    return {"kept": marks.get("kept", 0), "blanks": marks.get("blanks", {})}
