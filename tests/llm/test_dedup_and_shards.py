import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows

from twinrow.llm import exact, shards, simhash
from twinrow.llm.components import components
from plain_forms import docs, plain_components, plain_fingerprint, plain_shards  # noqa: F401

ODD = [
    (1, "a b"), (2, None), (3, ""), (4, "a b"), (5, "A b"), (9, "x" * 70 + "1"), (10, "x" * 70 + "2"),
    (11, "x" * 70 + "1"), (None, "a b"), (None, "alone"), (12, "ü" * 5000 + " end"), (12, "ü" * 5000 + " end"),
]


def expected_exact(items):
    groups = defaultdict(list)
    for i, t in items:
        groups[t or ""].append(i)
    out = []
    for i, t in items:
        own = groups[t or ""]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact(docs):
    assert rows(exact.marked(docs(ODD))) == expected_exact(ODD)
    kept = exact.deduplicated(docs(ODD))
    assert kept.columns == docs(ODD).columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect() if r.doc_id) == [
        (False, i) for i in (3, 4, 5, 10, 11, 12)
    ]
    assert kept.where("doc_id is null").count() == 1


def test_exact_of_nothing(docs):
    assert exact.marked(docs([])).count() == 0
    assert exact.deduplicated(docs([])).count() == 0


def random_docs(seed, n):
    pick = random.Random(seed)
    texts = [" ".join(pick.choice("ab") for _ in range(pick.randrange(12))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("items, count", [(random_docs(1, 60), 8), (random_docs(2, 5), 8), (ODD[:8], 3), ([], 4)])
def test_shards(docs, items, count):
    got = shards.sharded(docs(items), count).collect()
    where, capacity = plain_shards(items, count)
    assert {r.doc_id: r.shard for r in got} == where
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
        text = dict(items)[r.doc_id] or ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert sum(r.size for r in own) <= capacity


def test_shards_look_up_several_buckets(docs, monkeypatch):
    monkeypatch.setattr(shards, "BUCKET", 3)
    items = random_docs(3, 80)
    got = shards.sharded(docs(items), 5).collect()
    assert {r.doc_id: r.shard for r in got} == plain_shards(items, 5)[0]


def test_shards_of_repeated_rows_and_null_ids(docs):
    items = [*ODD, *ODD]
    got = shards.sharded(docs(items), 4).collect()
    assert len(got) == len(items)
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def near_copies(seed, groups, copies):
    pick = random.Random(seed)
    items = []
    for _ in range(groups):
        words = [f"w{pick.randrange(500)}" for _ in range(120)]
        for _ in range(copies):
            own = list(words)
            for _ in range(pick.randrange(4)):
                own[pick.randrange(len(own))] = "changed"
            items.append((pick.randrange(10**6), " ".join(own)))
    return list({i: (i, t) for i, t in items}.values())


@pytest.mark.parametrize("block, short", [(1024, 64), (8, 3)])
def test_near_groups(docs, monkeypatch, block, short):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SHORT", short)
    items = near_copies(4, 6, 30) + [(2_000_000, None), (2_000_001, ""), (2_000_002, "one two")]
    got = {r.doc_id: r for r in simhash.near_groups(docs(items)).collect()}
    prints = {i: plain_fingerprint(t) for i, t in items}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in prints.items()}
    links = [
        (a, b) for a, x in prints.items() for b, y in prints.items() if a < b and (x ^ y).bit_count() <= 4
    ]
    assert {i: r.component_id for i, r in got.items()} == plain_components(prints, links)
    kept = simhash.representatives(docs(items))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in got.values()})


def test_near_groups_without_ids_and_with_repeats(docs):
    items = [(None, "p q r s t"), (None, "p q r s t"), (7, "p q r s t"), (7, "other words are here now"), (None, "lone one")]
    got = simhash.near_groups(docs(items)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(
        [(None, 7), (None, 7), (7, 7), (7, 7), (None, None)], key=repr
    )
    kept = simhash.representatives(docs(items)).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [(7, "other words are here now"), (7, "p q r s t")]
    assert [r.text for r in kept if r.doc_id is None] == ["lone one"]
    assert simhash.near_groups(docs([])).count() == 0


def test_components(spark):
    pick = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(pick.randrange(100, 160), pick.randrange(100, 160)) for _ in range(50)]
    edges += [(3, 3), (-5, 200), (200, -5)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    linked = [e for e in edges if e[0] != e[1]]
    nodes = {n for e in linked for n in e}
    assert {r.node: r.root for r in got.collect()} == plain_components(nodes, linked)


def test_slabs_grow_with_the_fingerprints():
    assert simhash.slabs_for(1000) == 6
    assert simhash.slabs_for(10**9) > simhash.slabs_for(10**7) > 6
    assert np.unique(simhash.grids(7)).size == 35
