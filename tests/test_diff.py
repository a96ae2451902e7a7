import random
from collections import Counter

import pytest
from conftest import rows

from twinrow.operators import diff

ROW = "k string, a string, b string, c string"
FIELDS = ["a", "b", "c"]


def random_rows(seed, keys, n):
    pick = random.Random(seed)
    return [(f"k{pick.randrange(keys)}", *(pick.choice("xy") for _ in FIELDS)) for _ in range(n)]


def brute(left, right):
    """Every pair of every key, field by field."""
    return Counter(
        (a[0], f, a[i + 1], b[i + 1])
        for a in left for b in right if a[0] == b[0]
        for i, f in enumerate(FIELDS) if a[i + 1] != b[i + 1]
    )


def multiplied_out(report):
    """Pairs behind a report: its left and right values recombined."""
    pairs, lefts, rights = Counter(), {}, {}
    for r in report:
        assert (r.left_value is None) != (r.right_value is None)
        if r.right_value is None:
            lefts.setdefault((r.left_key, r.left_field), {})[r.left_value.strip('"')] = r.left_rows
        else:
            rights.setdefault((r.left_key, r.left_field), {})[r.right_value.strip('"')] = r.right_rows
    for group, values in lefts.items():
        for lv, n in values.items():
            for rv, m in rights[group].items():
                if lv != rv:
                    pairs[(*group, lv, rv)] += n * m
    return pairs


@pytest.mark.parametrize("seed, keys, n", [(1, 40, 30), (2, 8, 40), (3, 2, 50), (4, 1, 20)])
def test_report_equals_brute_force(spark, seed, keys, n):
    left, right = random_rows(seed, keys, n), random_rows(seed + 10, keys, n)
    frames = [spark.createDataFrame(side, ROW) for side in (left, right)]
    report = diff.diff_report(*frames, FIELDS, ["k"]).collect()
    assert multiplied_out(report) == brute(left, right)
    assert len(report) <= 2 * len(FIELDS) * (len(left) + len(right))


def test_pairs_of_renamed_fields_field_by_field(spark):
    pick = random.Random(11)
    names = [f"f{i}" for i in range(7)]
    left = [{"k": str(i), **{f: pick.choice("ab") for f in names}} for i in range(40)]
    right = [{"k": str(i), **{f"r{f}": pick.choice("ab") for f in names}} for i in range(40)]
    renamed = [f"r{f}" for f in names]
    report = diff.diff_pairs(
        spark.createDataFrame(left), spark.createDataFrame(right), names, ["k"], renamed
    )
    expected = [
        (l["k"], f, f'"{l[f]}"', f"r{f}", f'"{r[f"r{f}"]}"')
        for l, r in zip(left, right) for f in names if l[f] != r[f"r{f}"]
    ]
    assert rows(report.select("left_key", *diff.FIELDS)) == sorted(expected, key=repr)


def test_json_records(records):
    left = records(['{"id":1,"name":"a","val":1.0}', '{"id":2,"name":"b"}', '{"id":3}'])
    right = records(['{"id":1,"name":"a","val":1}', '{"id":2,"name":null}', '{"id":"3"}'])
    got = diff.diff_report(left, right, ["name", "val"], ["id"])
    assert rows(got) == [
        ("1", "1", "val", "1.0", "val", None, 1, 1), ("1", "1", "val", None, "val", "1", 1, 1),
        ("2", "2", "name", '"b"', "name", None, 1, 1), ("2", "2", "name", None, "name", "null", 1, 1),
    ]


def test_different_key_fields(records):
    got = diff.diff_report(
        records(['{"id":1,"x":"a"}']), records(['{"nr":1,"y":"b"}']), ["x"], ["id"], ["y"], ["nr"]
    )
    assert rows(got) == [
        ("1", "1", "x", '"a"', "y", None, 1, 1), ("1", "1", "x", None, "y", '"b"', 1, 1),
    ]


def test_a_repeated_row_changes_counts_only(spark):
    left = spark.createDataFrame([("k", "x", "x", "x")], ROW)
    rights = [("k", "x", "x", "y")] * 3 + [("k", "x", "x", "x")]
    got = diff.diff_report(left, spark.createDataFrame(rights, ROW), FIELDS, ["k"])
    assert rows(got) == [("k", "k", "c", '"x"', "c", None, 1, 3), ("k", "k", "c", None, "c", '"y"', 1, 3)]
    doubled = diff.diff_report(left.union(left), spark.createDataFrame(rights, ROW), FIELDS, ["k"])
    assert rows(doubled) == [("k", "k", "c", '"x"', "c", None, 2, 3), ("k", "k", "c", None, "c", '"y"', 2, 3)]


def test_pairs_refuse_keys_that_repeat_on_both_sides(spark):
    one = spark.createDataFrame([("k", "x", "x", "x"), ("l", "x", "x", "x")], ROW)
    many = spark.createDataFrame([("k", "x", "x", "y")] * 3, ROW)
    assert rows(diff.diff_pairs(one, many, FIELDS, ["k"])) == [("k", "k", "c", '"x"', "c", '"y"')] * 3
    with pytest.raises(ValueError, match="1 keys repeat"):
        diff.diff_pairs(one.union(one), many, FIELDS, ["k"])


def test_equal_and_disjoint_sides_give_nothing(spark):
    left = spark.createDataFrame(random_rows(5, 5, 9), ROW).dropDuplicates(["k"])
    assert diff.diff_report(left, left, FIELDS, ["k"]).collect() == []
    other = left.selectExpr("concat('z', k) as k", "a", "b", "c")
    assert diff.diff_report(left, other, FIELDS, ["k"]).collect() == []


@pytest.mark.parametrize("right", [["a"], [], ["a", "b", "c", "d"]])
def test_unequal_field_lists_are_rejected(right):
    with pytest.raises(ValueError):
        diff.check_fields(FIELDS, right)
