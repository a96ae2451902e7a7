"""Numpy helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from twinrow.llm.common import by_bytes, words_of
from twinrow.llm.simhash import embedded, fingerprints_of, grids
from twinrow.llm.xxh64 import xxh64

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x1c É🙂", max_size=30)), max_size=6)


def plain_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words(texts):
    words = words_of(pa.array(texts, pa.string()))
    got = words.array().to_pylist()
    assert [got[a:b] for a, b in zip(words.first, words.first[1:])] == [plain_words(t) for t in texts]
    for t, a, b in zip(texts, words.first, words.first[1:]):
        if b > a:
            run = words.data[words.start[a] : words.end[b - 1]].tobytes()
            assert run == b" ".join(plain_words(t))


def test_xxh64_equals_the_library():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 4000).astype(np.uint8)
    start, size = rng.integers(0, 3000, 800), rng.integers(0, 900, 800)
    got = xxh64(data, start, size, 42)
    assert got.tolist() == [
        xxhash.xxh64_intdigest(data[a : a + n].tobytes(), 42) for a, n in zip(start, size)
    ]


def plain_fingerprint(text):
    words = plain_words(text)
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_fingerprints(texts):
    assert fingerprints_of(pa.array(texts, pa.string())).tolist() == [plain_fingerprint(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4), st.sampled_from([6, 7, 9]))
def test_near_fingerprints_share_a_cell(fp, flips, slabs):
    other = fp
    for b in flips:
        other ^= 1 << b
    a, b = embedded(np.array([fp, other], np.uint64)).tolist()
    assert (a ^ b).bit_count() <= (fp ^ other).bit_count()
    assert any((a & m) == (b & m) for m in grids(slabs))


def test_pieces_of_a_batch_are_whole_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 50, "", "c"]})
    parts = list(by_bytes(iter([batch]), limit=12))
    assert [p.column("text").to_pylist() for p in parts] == [["a" * 10, None], ["b" * 50], ["", "c"]]
