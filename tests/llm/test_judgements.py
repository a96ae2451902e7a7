"""Decontamination, URL filter, toxicity, language model and pipeline."""

import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from plain_forms import docs  # noqa: F401
from pyspark.sql import functions as F

from twinrow.llm import exact, leaks, maxent, simhash, toxicity, url_rules
from twinrow.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- decontamination

QUESTION = (
    "Every day the farmer {n} sells {a} apples and {b} pears at the market, "
    "then {n} walks {a} miles home to feed {b} cows and rest"
)
ITEMS = [(10, QUESTION.format(n="Tom", a=5, b=7)), (11, "hi there"), (12, None), (13, "")]


def plain_marked(text):
    """The placeholders, step by step as the docstring says."""
    text = re.sub("[\u0002-\u0004]", " ", text or "")
    text = re.sub(r"(?<=[a-zé0-9,] )[A-Z][a-zé]+", "\u0002\\g<0>", text).lower()
    text = re.sub(
        rf"([0-9]+(?:[.,][0-9]+)*)(?: ?({'|'.join(leaks.UNITS)})(?![a-zé0-9]))?",
        lambda m: f" \u0003{m[1]} " + (f"\u0004{m[2]} " if m[2] else ""), text,
    )
    text = re.sub(r"[.,](?![0-9])", " ", text)
    return [w for w in re.split("[^a-zé0-9\u0002-\u0004.,]+", text) if w]


def plain_contaminations(items, benchmark):
    """All pairs of document and item, by comparing every window with every window."""

    def windows(words, size):
        return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]

    def types(window):
        return tuple(w[0] if w[0] in "\u0002\u0003\u0004" else w for w in window)

    found = set()
    for i, text in items:
        seen = plain_marked(text)
        for item, question in benchmark:
            own = plain_marked(question)
            size = min(5, len(own))
            if not size:
                continue
            total = {types(w) for w in windows(own, size)}
            lanes = {}
            for a, x in enumerate(windows(own, size)):
                for b, y in enumerate(windows(seen, size)):
                    if types(x) == types(y):
                        lanes.setdefault(b - a, []).append((x, y))
            good = set()
            for pairs in lanes.values():
                slots = {(p, q) for x, y in pairs for p, q in zip(x, y) if p[0] in "\u0002\u0003\u0004"}
                if len({p for p, _ in slots}) == len(slots):
                    good |= {types(x) for x, _ in pairs}
            if len(good) >= 0.8 * len(total):
                found.add((i, item))
    return found


LEAKY = [
    (1, "bla bla " + QUESTION.format(n="Tom", a=5, b=7) + " more"), (2, QUESTION.format(n="Ann", a=9, b=4)),
    (3, QUESTION.format(n="Ann", a=9, b=9)), (4, QUESTION.format(n="Ann", a=9, b=4).replace("walks 9", "walks 8")),
    (5, None), (6, ""), (7, "well hi there you"), (8, QUESTION.format(n="Tom", a=5, b=7)[:70]),
    (9, "filler \u0002 1,200.5 kg of 3km é. " * 30 + QUESTION.format(n="Zoe", a="1.5", b="2,000")),
]


def test_marked_words_equal_the_plain_form(spark):
    texts = [t for _, t in LEAKY] + ["In 2020 Tom met Alice Bob, who has 12h; 5% x1.5y .7, a.b", "...,,, 1.2.3 4, 5 m"]
    df = spark.createDataFrame([(t or "",) for t in texts], "text string")
    got = [r[0] for r in df.select(leaks.marked_words(F.col("text"))).collect()]
    assert got == [plain_marked(t) for t in texts]


def test_contaminations_equal_brute_force(spark, docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = plain_contaminations(LEAKY, ITEMS)
    assert {(1, 10), (2, 10), (3, 10), (7, 11), (9, 10)} <= want and not {4, 8} & {i for i, _ in want}
    got = leaks.contaminations(docs(LEAKY), benchmark)
    assert {(r.id, r.item) for r in got.collect()} == want
    flagged = leaks.marked(docs(LEAKY), benchmark)
    assert {r.doc_id for r in flagged.where("contaminated").collect()} == {i for i, _ in want}
    assert flagged.count() == len(LEAKY)
    kept = leaks.clean(docs(LEAKY), benchmark)
    assert kept.columns == docs(LEAKY).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in LEAKY} - {i for i, _ in want}


def test_decontamination_by_shuffle_with_odd_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(leaks, "BROADCAST_ROWS", 0)
    items = [(None, LEAKY[0][1]), (None, "clean"), (7, "clean too"), (7, LEAKY[1][1]), (7, LEAKY[1][1])]
    benchmark = spark.createDataFrame(ITEMS + ITEMS[:1], "item_id long, text string")
    kept = leaks.clean(docs(items), benchmark)
    assert sorted(r.text for r in kept.collect()) == ["clean", "clean too"]
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert leaks.marked(docs(items), nothing).where("contaminated").count() == 0
    assert leaks.marked(docs([]), benchmark).count() == 0


PASSAGE = (
    "the old mill by the river grinds 40 sacks of rye before noon and the miller counts them twice while "
    "his daughter ties each sack with blue string and writes the weight of every one on a board near the "
    "door so that the carter who comes at dusk can load 40 sacks without asking"
)


def leaked(spark, docs, texts, benchmark):
    items = spark.createDataFrame(benchmark, "item_id long, text string")
    flagged = leaks.marked(docs(list(enumerate(texts))), items).collect()
    return {r.doc_id: r.item_ids for r in flagged if r.contaminated}


def test_an_edited_number_takes_out_its_windows_only(spark, docs):
    texts = [PASSAGE.replace("load 40", "load 39"), PASSAGE.replace("40", "12"), PASSAGE[:150]]
    assert leaked(spark, docs, texts, [(1, PASSAGE)]) == {0: [1], 1: [1]}


def test_two_values_may_become_one_but_not_one_two(spark, docs):
    texts = [QUESTION.format(n="Ann", a=a, b=b) for a, b in ((6, 8), (6, 6))]
    texts.append(texts[0].replace("feed 8", "feed 9").replace("walks 6", "walks 4"))
    assert leaked(spark, docs, texts, ITEMS[:1]) == {0: [10], 1: [10]}


def test_benchmark_rows_without_id_or_with_the_same(spark, docs):
    other = "seven grey geese walk along the frozen canal towards the lamp of the ferryman who sleeps in his boat"
    texts = [PASSAGE, other, "neither of the two"]
    assert leaked(spark, docs, texts, [(None, PASSAGE)]) == {0: [None]}
    assert leaked(spark, docs, texts, [(1, PASSAGE), (1, other), (1, other)]) == {0: [1], 1: [1]}


def test_names_at_sentence_starts_and_lower_cased_copies(spark, docs):
    story = "{} has 5 apples. {} gives her 3 more pears from the tree behind the barn. \u201c{} is kind\u201d, says the old man."
    talk = "yesterday the tall {0} met a friend called {1} near the {2} gate and then {0} went home"
    texts = [
        story.format("Eve", "Max", "Max"), story.format("Alice", "Bob", "Bob").lower(), talk.format("Paul", "Rita", "North").lower(),
        "Max has no apples. Rita has none.", story.format("Eve", "Max", "Eve").replace("3", "5"),
    ]
    items = [(1, story.format("Alice", "Bob", "Bob")), (2, talk.format("Paul", "Rita", "North"))]
    assert leaked(spark, docs, texts, items) == {0: [1], 1: [1], 2: [2]}
    assert leaked(spark, docs, ["Over there", "hi There"], [(1, "Hi there")]) == {1: [1]}


def test_common_windows_do_not_multiply(spark, docs):
    """Thousands of items that share a phrase: texts of the phrase meet none of them."""
    phrase = "please read the following question with care and choose the best answer"
    words = "amber brook cedar dune ember flint grove heath inlet jetty".split()
    items = [
        (i, f"{phrase} {' '.join(words[int(c)] + words[int(d)] + ' ' + words[int(d)] for c, d in zip(f'{i:04d}', f'{i:04d}'[::-1]))} and why {words[i % 10]} of {words[i // 10 % 10]} or {words[i // 100 % 10]}")
        for i in range(2000)
    ]
    texts = [phrase, phrase + " " + phrase, items[77][1], "before " + items[1234][1] + " after"]
    found = leaked(spark, docs, texts, items)
    assert set(found) == {2, 3} and 77 in found[2] and 1234 in found[3]


# ---------------------------------------------------------------- urls

URLS = [
    None, "", "no scheme", "HTTP://A.COM", "http://Com/en/", "http://x.net/es/1?a=http://b.com/",
    "a\nb://EXAMPLE.com/en/\nx?q#f", "http://xcom/", "http://a.example.com?x/en/", "x://y://z.net/fr/",
    "http://www.example.com/en/1", "http://m.example.com/en/1", "http://example.comx/en/", "://", "http://İ.com/",
    *[f"http://h{i % 3}.example.org/{'en' if i % 2 else 'de'}/{i}.html" for i in range(20)],
    *[f"http://wide.org/word{i}x/page" for i in range(30)],
]


def plain_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, v) for v, h, p in url_rules.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("x"))
    got = {r.page_id: r for r in url_rules.judged(pages).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")
    wide = [r.branch for r in got.values() if r.host == "wide.org"]
    assert set(wide) == {"/*/page"}
    assert url_rules.judged(pages.limit(0)).count() == 0


def test_templates_are_rejected_by_their_labels(spark):
    labelled = [f"http://s{i % 9}.example.com/en/{i}" for i in range(60)] + [f"http://s{i % 9}.example.com/de/{i}" for i in range(60)]
    asked = ["http://new.org/en/5", "http://new.org/de/5", "http://new.org/it/5", "nothing"]
    pages = spark.createDataFrame(list(enumerate(labelled + asked)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.judged(pages).collect()}
    assert [got[len(labelled) + i] for i in range(4)] == ["block", "allow", "allow", "allow"]


# ---------------------------------------------------------------- toxicity


def spoken(seed, n):
    pick = random.Random(seed)
    items, labels = [], []
    for i in range(n):
        words = [f"w{pick.randrange(300)}" for _ in range(pick.randrange(5, 200))]
        junk, toxic = pick.random() < 0.2, pick.random() < 0.2
        if junk:
            words[::2] = [w + "###" for w in words[::2]]
            words.append("zzz")
        if toxic:
            words.insert(pick.randrange(len(words)), pick.choice(["nasty.", "VILE", "grubbing", "grubbed!"]))
        items.append((i, " ".join(words)))
        labels.append((i, int(not junk), int(toxic)))
    return items, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_toxicity(spark, docs):
    items, labels = spoken(1, 700)
    known = spark.createDataFrame(labels[:500] + [(None, 1, 1), (3, None, None)], LABELS)
    got = {r.doc_id: r for r in toxicity.judged(docs(items), known).collect()}
    right = [got[i].rejected == bool(t) for i, _, t in labels[500:]]
    assert sum(right) >= 0.98 * len(right)
    junk = [(got[i].p_junk > 0.5) == (q == 0) for i, q, _ in labels[500:]]
    assert sum(junk) >= 0.9 * len(junk)
    kept = toxicity.accepted(docs(items), known)
    assert kept.columns == docs(items).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.rejected}


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 0, 0)], [(1, None, None)]])
def test_toxicity_with_few_labels(spark, docs, labels):
    items = [(1, "a b"), (2, None), (None, ""), (2, "x " * 5000)]
    got = toxicity.judged(docs(items), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 4 and not any(r.rejected for r in got)
    assert toxicity.accepted(docs([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_rows_of_one_id_do_not_outweigh_the_sample(spark, docs, monkeypatch):
    seen = []
    fitted = toxicity.fitted
    monkeypatch.setattr(toxicity, "fitted", lambda *a: seen.append(a[2]) or fitted(*a))
    items = [(1, f"text {i % 40}") for i in range(80)] + [(i, f"word {i}") for i in range(2, 6)]
    known = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 6)], LABELS)
    for sample, want in ((5, 5), (20, 20), (100, 44)):
        toxicity.train(docs(items), known, sample=sample)
        assert seen.pop() == want


def test_the_chain_feeds_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    first = rng.integers(0, 2, 400).astype(float)
    labels = np.stack([first, first], axis=1)
    row, feature = np.arange(400), first.astype(int)
    chain = toxicity.fitted(["a", "b"], {"x": 0, "y": 1}, 400, row, feature, labels, rng.integers(0, 4, 400))
    assert chain.earlier[0].size == 0 and chain.earlier[1][0] > 0.1
    p = chain.probabilities(2, np.array([0, 1]), np.array([0, 1]))
    assert (p[0] < 0.1).all() and (p[1] > 0.9).all()


# ---------------------------------------------------------------- language model


def plain_tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), None]


def corpus(seed, n):
    pick = random.Random(seed)
    pairs = [(f"a{i}", f"b{i}") for i in range(30)]
    return [
        (i, " ".join(w for _ in range(pick.randrange(30)) for w in pick.choice(pairs)) + f" rare{i}") for i in range(n)
    ] + [(n, None), (n + 1, ""), (None, "A0 b0"), (n + 2, "L" * 500), (n + 3, "l" * 500)]


def test_language_model(docs):
    items = corpus(1, 300)
    got = maxent.scored(docs(items)).collect()
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    count = Counter(t for i, x in items if not out(i) for t in plain_tokens(x))
    n = sum(count.values())
    below = math.log10(n + 0.5 * (len(count) + 1))
    want = []
    for i, x in items:
        tokens = plain_tokens(x)
        base = sum(math.log10(count[t] + 0.5) - below for t in tokens)
        want.append((i, out(i), len(tokens), sum(count[t] > 0 for t in tokens), n, round(base, 6)))
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_without_training_documents(docs):
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = maxent.scored(docs([(only, "new words")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0)
    assert r.base_score == pytest.approx(0) and r.score == pytest.approx(3 * math.log10(0.5))
    assert maxent.scored(docs([])).count() == 0


def test_probabilities_of_all_tokens_add_up():
    rng = np.random.default_rng(0)
    tokens = [f"t{i}".encode() for i in range(1500)] + [maxent.END]
    v = maxent.Vocabulary.of(tokens, rng.integers(1, 1000, len(tokens)), 40.0)
    w = maxent.Weights(rng.normal(0, 0.3, maxent.Weights.zero().classes.shape).astype(np.float32),
                       rng.normal(0, 0.3, maxent.Weights.zero().words.shape).astype(np.float32))
    every = np.arange(v.size + 1)
    same = np.full(len(every), 3)
    s = maxent.Sequence(every, same, same + 5, np.array([0, len(every)]), every[:0], pa.array([], pa.large_binary()))
    assert np.exp(maxent.Scorer(v, w).log_probability(s)).sum() == pytest.approx(1, abs=1e-4)


def test_sequences_stop_at_texts():
    s = maxent.sequence(pa.array(["a b", None, "c a"]), {b"a": 0, b"b": 1}, 9)
    assert s.token.tolist() == [0, 1, 9, 9, 2, 0, 9]
    assert s.before.tolist() == [3, 0, 1, 3, 3, 2, 0]
    assert s.skipped.tolist() == [3, 3, 0, 3, 3, 3, 2]
    assert (s.open_text.tolist(), s.open_token.to_pylist()) == ([2], [b"c"])


# ---------------------------------------------------------------- queries, pipeline


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    cursor = con.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.select(names)) == sorted(cursor.fetchall(), key=repr)


def test_pipeline_equals_its_stages_by_brute_force(spark, monkeypatch):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline

    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    left = spark.read.parquet(f"{SMALL}/documents.parquet")
    judged = toxicity.judged(left, spark.read.parquet(f"{SMALL}/labels.parquet"))
    civil = {r.doc_id for r in judged.where("not rejected").collect()}
    texts = {r.doc_id: r.text for r in left.collect() if r.doc_id in civil}
    last = {t: i for i, t in sorted(texts.items())}
    texts = {i: t for t, i in last.items()}
    prints = {i: simhash.fingerprints_of(pa.array([t]))[0] for i, t in texts.items()}
    kept = []
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in sorted(prints):
            for b in sorted(prints):
                if root[a] < root[b] and int(prints[a] ^ prints[b]).bit_count() <= 4:
                    root[b], changed = root[a], True
    kept = [(i, texts[i]) for i in sorted(texts) if root[i] == i]
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    index = {}
    for item, text in benchmark:
        words = plain_marked(text)
        for i in range(len(words) - 4):
            index.setdefault(tuple(words[i : i + 5]), set()).add(item)
    near = {
        i for i, t in kept
        for w in [plain_marked(t)] if any(tuple(w[k : k + 5]) in index for k in range(len(w) - 4))
    }
    gone = {i for i, _ in plain_contaminations([x for x in kept if x[0] in near], benchmark)}
    assert set(out) == {i for i, _ in kept} - gone
    assert len(out) < left.count() and exact.PREFIX > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "sentencepiece",
    ]
