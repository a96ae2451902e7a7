"""Start the comparisons as streams that write to tables.

The transformations are those of the batch operators. A checkpoint folder is
always required. Tables written batch by batch hold one folder per batch, which
a repeated batch overwrites, so a restart leaves no doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from twinrow.operators.agreement import both_sides
from twinrow.operators.diff import check_fields, diff_rendered, keyed, rendered
from twinrow.operators.hashing import with_key_hash
from twinrow.operators.reconcile import latest, reconcile
from twinrow.operators.windows import WIDTH, record
from twinrow.session import exists, settled
from twinrow.streaming.bounded import NETS, REPORT


def append_to_table(
    df: DataFrame, path: str, checkpoint: str, **trigger: object
) -> StreamingQuery:
    """Append a stream without updates, such as hash records, to parquet files."""
    writer = (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start(path)


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def start_reconcile(
    hashed: DataFrame, path: str, checkpoint: str, **trigger: object
) -> StreamingQuery:
    """Reconcile a stream of tagged hash records.

    Each batch writes the records whose net has changed. State is one row per
    distinct record, kept in the state store; no watermark applies, as a record
    may wait for its equal for any time.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(_batch_folder(path, batch_id))

    writer = (
        reconcile(hashed)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def reconciled(spark: SparkSession, path: str) -> DataFrame:
    """Current net of every record of a reconciliation; none before its first batch."""
    return latest(_written(spark, path, NETS))


def _written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What batches wrote so far, with their ``batch_id``."""
    schema = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _report_records(
    table: DataFrame, left_fields: Sequence[str], right_fields: Sequence[str]
) -> DataFrame:
    """Report over counted records of whole windows."""
    content = ["window_start", "keys", "key", "texts"]
    sides = [table.where(f"{n} > 0").select(*content, F.col(n).alias("n")) for n in ("l", "r")]
    return diff_rendered(
        *sides, left_fields, right_fields, on=["window_start", "keys"], keep=["window_start"]
    )


def start_window_diff(
    left: DataFrame,
    right: DataFrame,
    left_fields: Sequence[str],
    key_fields: Sequence[str],
    path: str,
    checkpoint: str,
    ts: str = "ts",
    width: str = WIDTH,
    delay: str = WIDTH,
    right_fields: Sequence[str] | None = None,
    right_key_fields: Sequence[str] | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Report differing fields of each window once the watermark has closed it.

    Records are counted by window, key and content, which needs no pairs in the
    state and spreads a hot key over all tasks. A closed window arrives complete
    in one batch, which then is a batch comparison. Windows still open when the
    stream stops are reported after a restart, or by ``finish_window_diff`` if no
    more input will come. ``late_rows`` tells what came too late to be counted.
    """
    right_fields = right_fields or left_fields
    right_key_fields = right_key_fields or key_fields
    check_fields(left_fields, right_fields)
    window = F.window(ts, width).alias("w")
    sides = [
        rendered(
            keyed(side.withWatermark(ts, delay), fields, keys, keep=[window]),
            fields, keys, on=["w", "keys"],
        )
        for side, fields, keys in (
            (left, left_fields, key_fields), (right, right_fields, right_key_fields),
        )
    ]
    counted = (
        both_sides(*sides, n="n")
        .groupBy("w", "keys", "key", "texts")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .select(F.col("w.start").alias("window_start"), "keys", "key", "texts", "l", "r")
    )

    def report(closed: DataFrame, batch_id: int) -> None:
        # The batch is read several times; computing it again would run the
        # stateful part again.
        records = _batch_folder(f"{path}/records", batch_id)
        closed.write.mode("overwrite").parquet(records)
        table = closed.sparkSession.read.schema(closed.schema).parquet(records)
        _report_records(table, left_fields, right_fields).write.mode("overwrite").parquet(
            _batch_folder(f"{path}/report", batch_id)
        )

    writer = (
        counted.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(report)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def _open_windows(
    spark: SparkSession, checkpoint: str, names: Sequence[str], records: str
) -> DataFrame:
    """Counted records of the windows in a stopped stream's state, as a table.

    The state is grouped by the window and by ``names``, in this order.
    """
    state = spark.read.format("statestore").load(checkpoint)
    window, *rest = [F.col("key")[name] for name in state.schema["key"].dataType.names]
    # Both sums have the same name in the state, so they are told by position.
    nets = F.col("value").cast("struct<l: bigint, r: bigint>")
    table = state.select(
        window["start"].alias("window_start"), *[c.alias(n) for c, n in zip(rest, names)],
        nets["l"].alias("l"), nets["r"].alias("r"),
    )
    table.write.mode("overwrite").parquet(records)
    return spark.read.schema(table.schema).parquet(records)


def finish_window_diff(
    spark: SparkSession, path: str, checkpoint: str, left_fields: Sequence[str],
    right_fields: Sequence[str] | None = None,
) -> None:
    """Report the windows that a stopped ``start_window_diff`` still holds open.

    They are read from its state. This is for the end of the input: a window that
    gets more records by a later restart would be reported again.
    """
    right_fields = right_fields or left_fields
    kept = _open_windows(spark, checkpoint, ["keys", "key", "texts"], f"{path}/open-records")
    _report_records(kept, left_fields, right_fields).write.mode("overwrite").parquet(
        f"{path}/report/batch_id=-1"
    )


def _matches(table: DataFrame) -> DataFrame:
    """Each record of whole windows that meets the other side, once."""
    on = ["window_start", "key_hash"]
    met = table.groupBy(*on).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    met = settled(met.where("left_rows > 0 and right_rows > 0"), "met-keys")
    copies = F.explode(F.array(
        F.struct(F.lit("LEFT").alias("side"), F.col("l").alias("n")),
        F.struct(F.lit("RIGHT").alias("side"), F.col("r").alias("n")),
    ))
    return (
        table.join(met, on).withColumn("own", copies).where("own.n > 0")
        .select(
            *on, "own.side", "record", "left_rows", "right_rows",
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("own.n"))).alias("copy"),
        )
        .drop("copy")
    )


def start_window_matches(
    left: DataFrame, right: DataFrame, key_fields: Sequence[str], path: str, checkpoint: str,
    ts: str = "ts", width: str = WIDTH, delay: str = WIDTH,
    right_key_fields: Sequence[str] | None = None, **trigger: object,
) -> StreamingQuery:
    """The stream form of ``window_matches``: records of closed windows, once each.

    State holds counted records, so nothing multiplies and a hot key spreads.
    """
    window = F.window(ts, width).alias("w")
    sides = [
        with_key_hash(side.withWatermark(ts, delay), keys).select(
            window, "key_hash", record(side).alias("record")
        )
        for side, keys in ((left, key_fields), (right, right_key_fields or key_fields))
    ]
    counted = (
        both_sides(*sides)
        .groupBy("w", "key_hash", "record")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .select(F.col("w.start").alias("window_start"), "key_hash", "record", "l", "r")
    )

    def write(closed: DataFrame, batch_id: int) -> None:
        records = _batch_folder(f"{path}/records", batch_id)
        closed.write.mode("overwrite").parquet(records)
        table = closed.sparkSession.read.schema(closed.schema).parquet(records)
        _matches(table).write.mode("overwrite").parquet(_batch_folder(f"{path}/matches", batch_id))

    writer = (
        counted.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def finish_window_matches(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Write the matches of the windows that a stopped stream still holds open."""
    table = _open_windows(spark, checkpoint, ["key_hash", "record"], f"{path}/open-records")
    _matches(table).write.mode("overwrite").parquet(f"{path}/matches/batch_id=-1")


def stream_matches(spark: SparkSession, path: str) -> DataFrame:
    """All matches written so far."""
    return spark.read.parquet(f"{path.rstrip('/')}/matches").drop("batch_id")


def late_rows(query: StreamingQuery) -> int:
    """Counted records that a query dropped as they came behind the watermark.

    Spark remembers the progress of the latest hundred batches, and so does this sum;
    ``bounded.late_count`` is over all batches, and keeps the records.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress for operator in progress["stateOperators"]
    )


def window_report(spark: SparkSession, path: str) -> DataFrame:
    """All report rows written so far."""
    return _written(spark, f"{path.rstrip('/')}/report", REPORT).drop("batch_id")
