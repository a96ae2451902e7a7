"""Mixing against a plain form that fills sources step by step and sorts by hash."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from conftest import rows

from twinrow.llm import mixing
from twinrow.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, text string, source string, size int, place string, mix_top int, target double"
ODD = [
    (1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (4, " \t\x0b ", None), (5, "one", None), (None, "no id here", "y"),
    (6, "w " * 4000, "x"), (7, "   ", ""), (8, "a b c", "x"), (8, "a b c", "x"), (9, "d\ne\r\nf", "Z"),
] + [(100 + i, "many " * (i % 7), "xyz"[i % 3]) for i in range(90)]


def plain(items):
    size = [len(re.findall("[^\x20\x09-\x0D]+", t or "")) for _, t, _ in items]
    order = sorted({s for *_, s in items}, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total = defaultdict(int)
    for n, (*_, s) in zip(size, items):
        total[s] += n
    target, left, open_ = {}, 1.5 * sum(size), set(order)
    while open_:
        given = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if given[s] > 2 * total[s]}
        if not over:
            target |= given
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        open_ -= over
    taken = [0] * len(items)
    for s in order:
        if not total[s]:
            continue
        times = int(target[s] // total[s])
        rest = target[s] - times * total[s]
        groups = defaultdict(list)
        for k, (i, t, own) in enumerate(items):
            if own == s:
                name = f"{'' if i is None else i}:{t or ''}"
                groups[hashlib.md5(name.encode()).hexdigest()[:15]].append(k)
        at, more = 0, True
        for h in sorted(groups):
            own = sum(size[k] for k in groups[h])
            if more and at + own > rest:
                more = False
                add = at + own - rest < rest - at
            else:
                add = more
            at += own
            for k in groups[h]:
                taken[k] = size[k] * (times + add)
    return [(i, n, total[s], pytest.approx(target[s]), k) for (i, _, s), n, k in zip(items, size, taken)]


def frame(spark, items):
    return spark.createDataFrame([(*i, 1, "p", 2, 0.5) for i in items], SCHEMA)


@pytest.mark.parametrize("items", [ODD, ODD[:1], ODD[3:4], [], ODD * 2, [(i, "a b", "s") for i in range(50)]])
def test_mix_equals_the_plain_form(spark, items):
    got = mixing.judged(frame(spark, items))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    have = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4]))
    want = sorted(plain(items), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4]))
    assert have == want


def test_only_boundary_buckets_are_refined(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEP", 1)
    items = [(i, f"w {i} " * (i % 5 + 1), "ab"[i % 3 == 0]) for i in range(300)]
    monkeypatch.setattr(mixing, "DIGITS", 15)
    have = rows(mixing.judged(frame(spark, items)).select("doc_id", "taken"))
    assert have == sorted([(r[0], r[4]) for r in plain(items)], key=repr)


def test_mixed_rows_are_whole(spark):
    docs = frame(spark, ODD)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    words = {i: n for i, n, *_ in plain(ODD) if i != 8}
    taken = defaultdict(int)
    for r in out.collect():
        if r.doc_id != 8:
            taken[r.doc_id] += words[r.doc_id]
        assert r.place == "p" and (r.doc_id, r.text, r.source) in ODD
    assert {i: n for i, n in taken.items() if n} == {r[0]: r[4] for r in plain(ODD) if r[4] and r[0] != 8}
    assert mixing.mixed(frame(spark, [])).count() == 0


def test_query_and_its_sql_agree_and_come_near(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op11_mixing"](spark, folder)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = con.execute(SQL["op11_mixing"])
    names = [c[0] for c in want.description]
    have = sorted(tuple(r) for r in got.select(*names).collect())
    assert have == sorted(want.fetchall())
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source")
    for r in got.join(docs, "doc_id").groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"]


def test_no_python_in_the_plan(spark):
    plan = mixing.judged(frame(spark, ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
