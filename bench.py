"""Time the headline queries, next to a plain DataFrame form of the same answer.

Prints one JSON line. ``queries`` are ours, ``plain`` the plain forms: direct
joins on raw columns, without digests, defined renderings or care for hot keys.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from twinrow.plans import tables  # noqa: E402
from twinrow.plans.queries import DOC_COLUMNS, QUERIES  # noqa: E402
from twinrow.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "mismatch_ids", "mismatch_pairs", "classify", "classify_counts", "mismatch_keys",
    "keep_keys", "field_diff", "diff_report", "diff_report_crowded",
    "reconcile_outstanding", "reconcile_status", "row_hashes_json", "row_hashes_text",
    "row_hashes_labelled", "row_hashes_table", "blank_profile_trim", "drop_blank_unicode",
    "word_count", "word_count_union", "window_join_pairs", "window_matches",
    "window_field_diff", "stream_reconcile", "stream_window_join", "stream_window_diff",
]


def _orders(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return (
        tables.orders(spark, FOLDER).alias("l"),
        tables.orders_copy(spark, FOLDER).alias("r"),
    )


def plain_mismatch_ids(spark: SparkSession) -> DataFrame:
    l, r = _orders(spark)
    return l.join(r, "id").where("l.name <> r.name or l.val <> r.val").select("id").distinct()


def plain_classify(spark: SparkSession) -> DataFrame:
    l, r = _orders(spark)
    status = F.expr(
        "case when r.id is null then 'LEFT_ONLY' when l.id is null then 'RIGHT_ONLY' "
        "when l.name = r.name and l.val = r.val then 'MATCH' else 'VALUE_MISMATCH' end"
    )
    return l.join(r, F.expr("l.id = r.id"), "full_outer").select(
        F.expr("coalesce(l.id, r.id)").alias("id"), status.alias("status")
    )


def plain_diff_report(spark: SparkSession) -> DataFrame:
    l, r = _orders(spark)
    fields = F.expr(
        "inline(array(struct('name' as f, l.name as lv, r.name as rv), "
        "struct('val' as f, l.val as lv, r.val as rv)))"
    )
    return l.join(r, "id").select("id", fields).where("lv <> rv")


def plain_reconcile_outstanding(spark: SparkSession) -> DataFrame:
    l, r = _orders(spark)
    return l.exceptAll(r).unionByName(r.exceptAll(l))


def plain_row_hashes_json(spark: SparkSession) -> DataFrame:
    events = tables.event_messages(tables.table(spark, FOLDER, "events"))
    text = events.select(F.col("value").cast("string").alias("value"))
    return text.select(
        F.md5(F.concat_ws("|", *[F.get_json_object("value", f"$.{f}") for f in tables.EVENT_FIELDS]))
    )


def plain_blank_profile_trim(spark: SparkSession) -> DataFrame:
    docs = tables.labelled_documents(spark, FOLDER)
    return docs.agg(
        *[F.sum(F.when(F.coalesce(F.trim(c), F.lit("")) == "", 1)) for c in DOC_COLUMNS]
    )


def plain_word_count(spark: SparkSession) -> DataFrame:
    docs = tables.table(spark, FOLDER, "documents")
    return docs.select(F.explode(F.split(F.lower("text"), r"\W+")).alias("w")).groupBy("w").count()


def plain_window_join_pairs(spark: SparkSession) -> DataFrame:
    events = tables.table(spark, FOLDER, "events").withColumn("w", F.date_trunc("hour", "ts"))
    l, r = (events.where(F.col("event_type") == t) for t in ("click", "view"))
    return l.alias("l").join(r.alias("r"), ["user_id", "w"])


PLAIN = {
    name.removeprefix("plain_"): run
    for name, run in list(globals().items()) if name.startswith("plain_")
}


def seconds(build) -> float:
    """Best of the timed runs, after one to warm up; every row is computed."""
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def main() -> None:
    spark = build_session(
        "twinrow-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ours = {name: seconds(lambda: QUERIES[name](spark, FOLDER)) for name in HEADLINE}
    plain = {name: seconds(lambda: run(spark)) for name, run in PLAIN.items()}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(ours.values()), 3),
        "unit": "sec",
        "queries": ours,
        "plain": plain,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
