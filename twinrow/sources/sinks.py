"""Text and CSV output, one record per line, nothing quoted or escaped."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinrow.functions.render import record_text


def text_lines(df: DataFrame) -> DataFrame:
    """A one-column frame as it is, any other as ``(a,b,c)`` lines."""
    if len(df.columns) == 1:
        return df.select(F.col(f"`{df.columns[0]}`").cast("string").alias("value"))
    return df.select(record_text([f"`{c}`" for c in df.columns]).alias("value"))


def write_text(df: DataFrame, path: str) -> None:
    text_lines(df).write.text(path)


def stream_text(df: DataFrame, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Append the rows of a stream to text files."""
    writer = text_lines(df).writeStream.format("text").option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Fields joined by the separator; null prints nothing."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.text(path)


def preview(df: DataFrame, rows: int = 20) -> None:
    """Print the first rows of a batch frame and how many there are in all.

    A look at a result, not an output: ``write_text`` and ``write_csv`` write all. The
    frame is computed once.
    """
    held = df.persist(StorageLevel.DISK_ONLY)
    try:
        total = held.count()
        held.show(rows, truncate=False)
    finally:
        held.unpersist()
    print(f"{min(rows, total)} of {total} rows")


def show_stream(df: DataFrame, rows: int = 20, mode: str = "append") -> StreamingQuery:
    """Print the first rows of each batch of a stream, and how many it has, as a preview."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        preview(batch, rows)

    return df.writeStream.outputMode(mode).foreachBatch(show).start()
