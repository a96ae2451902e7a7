"""Plans stay what they should be at scale."""

import io
from contextlib import redirect_stdout

import pytest
from test_queries import FOLDER

from twinrow.plans.queries import QUERIES

LAZY = [n for n in QUERIES if not n.startswith(("stream_", "job_", "csv_", "text_"))]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


@pytest.mark.parametrize(
    "name", ["mismatch_ids", "mismatch_pairs", "classify", "classify_counts",
             "reconcile_outstanding", "word_count", "blank_profile_trim"],
)
def test_aggregations_hash_without_sorting(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "HashAggregate" in text
    assert "SortAggregate" not in text and "\nSort" not in text


def test_key_comparison_shuffles_once(spark):
    for name in ("mismatch_ids", "classify"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert text.count("+- Exchange (") == 1 and "Join" not in text


def test_columns_are_pruned(spark):
    text = plan(QUERIES["mismatch_ids"](spark, FOLDER))
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert len(schemas) == 2
    assert all("o_custkey" not in s and "o_orderdate" not in s for s in schemas)
    assert "lang" not in plan(QUERIES["word_count"](spark, FOLDER)).split("ReadSchema")[1][:60]


def test_filters_reach_the_scan(spark):
    from twinrow.plans import tables

    text = plan(tables.orders(spark, FOLDER).where("name = '1-URGENT'"))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text


def test_records_are_parsed_once_per_scan(spark):
    """No filter below a join renders the key a second time."""
    for name in ("window_matches", "window_join_pairs", "keep_keys"):
        text = plan(QUERIES[name](spark, FOLDER))
        filters = [x for x in text.splitlines() if x.startswith(("Condition", "PushedFilters"))]
        assert not any("parseJson" in x or "md5" in x for x in filters)
