"""Brute-force versions of the operators, and the documents they are tried on."""

import re

import pytest
import xxhash

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, id long, fp string, size int, kept string"


@pytest.fixture
def docs(spark):
    """Documents with columns whose names the operators use themselves."""

    def make(items):
        rows = [(i, t, None, "src", len(t or ""), 5, "x", 1, None) for i, t in items]
        return spark.createDataFrame(rows, EXTRA)

    return make


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
    return root


def plain_shards(items, count):
    """Shard of every id, by trying every capacity from below, and the capacity."""
    groups = {}
    for i, t in sorted(items):
        groups.setdefault(t or "", []).append(i)
    sizes = [len(ids) * (len(t.encode()) + 1) for t, ids in groups.items()]
    capacity = max(sizes, default=0)
    while True:
        where, shard, held = {}, 0, 0
        for ids, size in zip(groups.values(), sizes):
            if held + size > capacity:
                shard, held = shard + 1, 0
            held += size
            where |= dict.fromkeys(ids, shard)
        if shard < count:
            return where, capacity
        capacity += 1
