"""Columns with the operators' own names, endless runs of characters, and growing texts."""

import random
import time

import pytest

import corpus_pipeline
from twinrow.llm import exact, leaked_keys, leaks, pii, simhash

NAMES = ["__id", "__of", "__digest", "__twins", "__print", "digest", "key", "prefix", "gone_id", "Gone_Print", "repeats"]
ROWS = [
    (1, "one two three four five six seven eight"), (2, "one two three four five six seven eight"),
    (2, "one two three four five six seven eight"), (3, None), (None, "a text of no id"), (4, ""),
]


@pytest.fixture
def clashing(spark):
    """Documents with columns of all these names, each holding its own name."""

    def make(items):
        schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES)
        return spark.createDataFrame([(*i, *NAMES) for i in items], schema)

    return make


@pytest.mark.parametrize("items", [ROWS, []])
def test_filters_keep_columns_of_any_name(spark, clashing, items):
    docs = clashing(items)
    benchmark = spark.createDataFrame([(1, "quite another text of six words")], "item_id long, text string")
    filters = {
        "exact": (exact.deduplicated, {2, 4, None}),
        "near": (simhash.representatives, {1, 3, None}),
        "leaks": (lambda d: leaks.clean(d, benchmark), {1, 2, 3, 4, None}),
    }
    for name, (run, ids) in filters.items():
        kept = run(docs)
        assert kept.columns == docs.columns, name
        got = kept.collect()
        assert {r.doc_id for r in got} == (ids if items else set()), name
        assert all(list(r)[2:] == NAMES for r in got), name


def test_stages_over_odd_tables(spark, clashing, monkeypatch):
    """Every stage with clashing columns, nulls, repeated rows and no rows at all."""
    folder = "/root/testdata/sf0.001"
    for items in (ROWS, []):
        docs = clashing(items)
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, folder)
            got = out.collect()
            if name != "sentencepiece":
                assert out.columns == docs.columns
            assert len(got) <= len(items) and bool(got) == bool(items), name


def test_whole_texts_are_hashed_only_where_length_and_prefix_repeat(clashing):
    plan = exact.deduplicated(clashing(ROWS))._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in plan
    assert all("CASE WHEN" in line.split("sha2")[0] for line in plan.splitlines() if "sha2" in line)


def test_endless_digits():
    for text in ("0" * 10_000 + ".1.2.3", "9" * 10_000 + ".1.2.3", "1." * 9000):
        spans = pii.base_spans(text)
        assert [s[0] for s in spans if s[0] == "ip"] == (["ip"] * (text[0] == "0") if len(text) > 9 and text[1] != "." else ["ip"] * 2250)


def test_free_spans_equal_plain_overlap():
    pick = random.Random(4)

    def some(n):
        return [("k", a, a + pick.randrange(1, 6)) for a in (pick.randrange(200) for _ in range(n))]

    for _ in range(50):
        own, base = some(20), some(12)
        want = [s for s in own if not any(s[1] < b[2] and b[1] < s[2] for b in base)]
        assert pii.free_of(own, base) == want
        assert all(leaked_keys._within([(b, b + 3) for b in range(0, 90, 5)], p) == (p % 5 < 3 and p < 88) for p in range(100))


def growth(run, small, large):
    """Time for the large input over that for the small one, the least of some tries."""

    def least(x):
        times = []
        for _ in range(4):
            begin = time.perf_counter()
            run(x)
            times.append(time.perf_counter() - begin)
        return min(times)

    return least(large) / max(least(small), 1e-4)


def test_work_grows_in_line_with_the_text():
    """Four times the size; quadratic work would take sixteen times as long."""
    begins = "-----BEGIN RSA PRIVATE KEY-----\n" + "QUJDRA" * 20 + "\n"
    blocks = [begins * n + "-----END RSA PRIVATE KEY-----" for n in (200, 800)]
    assert growth(leaked_keys.confirmed_spans, *blocks) < 9
    spans = [[("phone", i * 10, i * 10 + 8, 1.0) for i in range(n)] for n in (10_000, 40_000)]
    assert growth(pii.reconciled, *spans) < 9
    lists = [([s[:3] for s in x], [s[:3] for s in x]) for x in spans]
    assert growth(lambda x: pii.free_of(*x), *lists) < 9
