"""Alignment against plain loops over both libraries' own tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from twinrow.llm import alignment
from twinrow.llm.queries import QUERIES

RANKS, MODEL = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, digest string, pair int, n_a string, copies int, id int"
NAMES = ["doc_id", *alignment.MEASURES, "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """Rows of the answer by loops, from the tokenizer file the contract names."""
    a_lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in printable}
    to_byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    a_bytes = {i: bytes(to_byte[c] for c in t) for t, i in a_lib.get_vocab().items() if i < 50256}

    def b_surface(i):
        p = b_lib.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return None
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        sides = [[(i, a_bytes[i]) for i in a], [(i, b_surface(i)) for i in b]]
        if any(b"".join(s for _, s in side) != (" " + text).encode() for side in sides):
            return None
        found, at, end = [([], [])], [0, 0], [0, 0]
        while at[0] < len(a) or at[1] < len(b):
            k = 0 if end[0] <= end[1] and at[0] < len(a) else 1
            found[-1][k].append(sides[k][at[k]][0])
            end[k] += len(sides[k][at[k]][1])
            at[k] += 1
            if end[0] == end[1]:
                found.append(([], []))
        return found[:-1]

    def answer(items):
        own = [groups(t) for _, t in items]
        count = Counter()
        for gs in own:
            count.update({(x, y) for a, b in gs or [] for x in a for y in b})
        most = Counter()
        for (x, _), n in count.items():
            most[x] = max(most[x], n)
        out = []
        for (i, _), gs in zip(items, own):
            links = [(x, y) for a, b in gs or [] for x in a for y in b]
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs or [])
            out.append((
                i, sum(len(a) for a, _ in gs or []), sum(len(b) for _, b in gs or []), len(gs or []), len(links),
                sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if gs else "",
            ))
        return sorted(out, key=repr)

    return answer


def some_texts(seed, n):
    pick = random.Random(seed)
    parts = ["the ", "mill", "  ", "\n", "é", "日本", "▁", "<s>", "<|endoftext|>", "<0x41>", "😀", "́", "12", "ing ",
             "\u0000", "\t", " a", "zz", "ß", "‍", "’s", "'s", "﻿", " "]
    return [(i, "".join(pick.choice(parts) for _ in range(pick.randrange(1, 25)))) for i in range(n)]


ODD = [
    (1, "Hello world, hello worlds"), (2, None), (3, ""), (4, " "), (5, "Hello world, hello worlds"), (None, "no id"),
    (7, "a▁b"), (8, "x" * 3000), (9, "日" * 700), (10, "\n\n \n"), (5, "Hello world, hello worlds"), (11, "tail  "),
    (12, "ab " * 3000), (13, " lead"),
]


def answer_of(spark, items):
    docs = spark.createDataFrame([(*i, "d", 1, "n", 2, 3) for i in items], SCHEMA)
    got = alignment.alignment(docs, RANKS, MODEL)
    assert got.columns == NAMES
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("items", [ODD, some_texts(1, 150) * 2, []])
def test_alignment_equals_plain_loops(spark, plain, items):
    assert answer_of(spark, items) == plain(items)


def test_long_groups_and_counts_by_join(spark, plain, monkeypatch):
    items = ODD + some_texts(2, 60)
    monkeypatch.setattr(alignment, "PAIRS", 0)
    assert answer_of(spark, items) == plain(items)


def test_blocks_of_any_size_give_the_same_pairs(monkeypatch):
    import pyarrow as pa

    from twinrow.llm import pieces

    tokenizers = alignment.Tokenizers(RANKS, pieces.Model.load(MODEL))
    texts = pa.array([t or "" for _, t in ODD + some_texts(3, 50)])
    whole = alignment.texts_aligned(tokenizers, texts)
    for links in (1, 3, 50):
        monkeypatch.setattr(alignment, "LINKS", links)
        assert alignment.texts_aligned(tokenizers, texts) == whole


def test_counts_are_added_up_in_parts(monkeypatch):
    import pyarrow as pa

    pick = random.Random(5)
    rows = [([pick.randrange(30) for _ in range(pick.randrange(9))], pick.randrange(1, 4)) for _ in range(200)]
    rows = [(sorted(set(p)), n) for p, n in rows]
    want = Counter()
    for p, n in rows:
        want.update(dict.fromkeys(p, n))
    monkeypatch.setattr(alignment, "HELD", 10)
    batches = [pa.RecordBatch.from_pydict({"pairs": pa.array([p for p, _ in rows[i : i + 7]], pa.list_(pa.int64())), "copies": [n for _, n in rows[i : i + 7]]}) for i in range(0, 200, 7)]
    got = Counter()
    for b in alignment._counted(iter(batches)):
        for p, n in zip(b.column("pair").to_pylist(), b.column("n").to_pylist()):
            got[p] += n
    assert got == want


def test_query_over_a_whole_table(spark, plain):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_alignment"](spark, folder).select(*NAMES)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain([tuple(r) for r in docs])
