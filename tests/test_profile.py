import re

import pytest
from conftest import rows
from pyspark.sql import Observation

from twinrow.functions.blank import is_blank
from twinrow.operators import profile, words

TRIPLES = [
    ("oak", "7", "north field"),
    ("", "12", "south field"),
    ("elm", None, "\t"),
    ("ash", "3", "   "),
]
COLUMNS = ["f0", "f1", "f2"]


@pytest.fixture
def triples(spark):
    return spark.createDataFrame(TRIPLES, "f0 string, f1 string, f2 string")


@pytest.mark.parametrize("rule", ["trim", "unicode"])
def test_sample_triples(triples, rule):
    assert rows(profile.blank_profile(triples, COLUMNS, rule)) == [(1, 1, 2)]
    assert rows(profile.drop_blank(triples, COLUMNS, rule)) == [("oak", "7", "north field")]


def test_counts_in_the_same_pass_cover_dropped_rows(triples):
    seen = Observation("blanks")
    kept = profile.drop_blank(triples, COLUMNS, "trim", seen)
    assert len(kept.collect()) == 1
    assert seen.get == {"f0": 1, "f1": 1, "f2": 2}


def test_no_rows(triples):
    assert rows(profile.blank_profile(triples.where("false"), COLUMNS)) == [(0, 0, 0)]


# Text, blank by trimming, blank by Unicode white space.
CASES = [
    (None, True, True), ("", True, True), (" \t\n", True, True), ("a", False, False),
    (" a ", False, False), ("\u2003", False, True), ("\u0001", True, False),
    ("\u00a0", False, False), ("\u2007", False, False), ("\u202f", False, False),
    ("\u3000", False, True), ("\u2028", False, True), ("\u0085", False, False),
    ("\x1c", True, True), (" \u2029", False, True), ("\x7f", False, False),
]


def test_blank_rules(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, s string")
    got = df.select("i", is_blank("s", "trim"), is_blank("s", "unicode")).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [c[1:] for c in CASES]


def test_word_count(spark):
    lines = [
        "One fish, two fish;--red FISH:--", "café a_b A_B 12 12",
        "", "  ...  ", "didn't",
    ]
    expected = {}
    for line in lines:
        for word in re.split(r"[^a-zA-Z0-9_]+", line.lower()):
            if word:
                expected[word] = expected.get(word, 0) + 1
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert {r.word: r.n for r in words.word_count(df).collect()} == expected
    twice = words.word_count(words.union_lines(df, df))
    assert {r.word: r.n for r in twice.collect()} == {w: 2 * n for w, n in expected.items()}
