"""Spelling variants against plain loops over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from twinrow.llm import spelling
from twinrow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, word string, n int, leaf string, code string"


def plain_words(items):
    found = Counter()
    for i, text in items:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_near(words):
    """Near words by what is left when one place is masked or taken out."""
    by = {}
    for w in words:
        for k in range(len(w)):
            by.setdefault((w[:k], w[k + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for own in by.values():
        for w in own:
            near[w] |= own - {w}
    for w in words:
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1 :]
            if shorter in near:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def plain(items):
    n = plain_words(items)
    near = plain_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def answer(spark, items):
    docs = spark.createDataFrame([(*i, "w", 1, "l", "c") for i in items], SCHEMA)
    got = spelling.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def noisy(seed, n, letters="abcdeé", size=(4, 8)):
    pick = random.Random(seed)
    stems = ["".join(pick.choice(letters) for _ in range(pick.randrange(*size))) for _ in range(40)]
    items = []
    for i in range(n):
        words = []
        for _ in range(pick.randrange(60)):
            w = pick.choice(stems)
            k = pick.randrange(len(w))
            w = pick.choice([w, w, w, w[:k] + w[k + 1 :], w[:k] + pick.choice(letters) + w[k:], w[:k] + pick.choice(letters) + w[k + 1 :]])
            words.append(w if pick.random() < 0.8 else w.upper())
        items.append((i, pick.choice([" ", ", ", "1", "×"]).join(words)))
    return items


ODD = [
    (1, None), (2, ""), (None, "colour color colour colour " * 3), (3, "colours Colour COLOR color's " * 4), (3, "colours " * 9),
    (4, "x" * 300 + " " + "x" * 299 + " " + "x" * 299 + "y "), (5, ("x" * 300 + " ") * 3 + ("x" * 299 + " ") * 8), (6, "ÀÉÎÕÜ àéîõü ÀÉÎÕÜ " * 3),
    (7, "Ā" + "straße strasse straße " * 3 + "中文"), (3, "colours " * 9),
]


@pytest.mark.parametrize("items", [ODD, noisy(1, 80), noisy(2, 60, "ab", (5, 9)), []])
def test_variants_equal_plain_loops(spark, items):
    assert answer(spark, items) == plain(items)


@pytest.mark.parametrize("cell, sample, leaf", [(12, 60, 2), (40, 5, 1), (3, 2000, 3)])
def test_small_cells_and_blocks_change_nothing(spark, monkeypatch, cell, sample, leaf):
    for name, value in (("CELL", cell), ("SAMPLE", sample), ("LEAF", leaf), ("QUERIES_AT_ONCE", 5), ("COMPARED", 40)):
        monkeypatch.setattr(spelling, name, value)
    items = noisy(3, 60) + [(90, "abcde abced acbde bacde edcba " * 3)]
    assert answer(spark, items) == plain(items)


def test_checksums_are_put_together():
    pick = random.Random(1)
    for _ in range(200):
        a, b = (bytes(pick.randrange(256) for _ in range(pick.randrange(1, 64))) for _ in "ab")
        made = spelling.shifted(np.array([zlib.crc32(a)], np.uint32))[len(b), 0] ^ np.uint32(zlib.crc32(b))
        assert int(made) == zlib.crc32(a + b)


def test_distance_of_codes_is_a_lower_bound():
    pick = random.Random(2)
    for _ in range(500):
        a = "".join(pick.choice("abcxyzé÷ÿ") for _ in range(pick.randrange(5, 9)))
        k = pick.randrange(len(a))
        b = pick.choice([a[:k] + a[k + 1 :], a[:k] + "q" + a[k + 1 :], a[:k] + "à" + a[k:]])
        x, y = spelling.coded(*spelling.latin(pa.array([a, b])))
        assert int(x ^ y).bit_count() <= 2 - (len(a) != len(b))


def test_trees_reach_all_in_range():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdef"), 6)) for _ in range(600)]
    code = spelling.coded(*spelling.latin(pa.array(words)))
    nodes = [[0, -1, -1, -1, 0, 0]]
    leaves = spelling.grow(nodes, 0, code, 5, 0)
    tree = spelling.Tree.frozen(nodes)
    of = np.empty(len(code), int)
    for k, own in enumerate(leaves):
        of[own] = k
    assert (tree.home(np.zeros(len(code), np.int64), code) == of).all()
    place, leaf = tree.reached(np.zeros(len(code), np.int64), code, 2)
    reached = set(zip(place.tolist(), leaf.tolist()))
    near = np.bitwise_count(code[:, None] ^ code[None, :]) <= 2
    assert all((a, of[b]) in reached for a, b in zip(*np.nonzero(near)))
    assert len(reached) < len(code) * len(leaves) / 2


def test_query_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_spelling"](spark, folder).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain([tuple(r) for r in docs])
