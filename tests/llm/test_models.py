"""Decoding and scoring of the trained models against plain loops."""

import itertools
import math

import numpy as np
import pyarrow as pa

from twinrow.llm import lstm, pii, toxicity


def test_viterbi_equals_the_best_of_all_paths():
    rng = np.random.default_rng(7)
    allowed = pii.allowed_steps()[:5, :5]
    for seed in range(6):
        tagger = lstm.Tagger.new(4, allowed, seed)
        tagger.trans = rng.normal(size=allowed.shape).astype(np.float32) * 3
        tagger.wo = rng.normal(size=tagger.wo.shape).astype(np.float32) * 9
        x = rng.integers(0, len(tagger.wx_f), (8, 5))
        scores, steps = tagger.scores(x), tagger._steps()
        tags, margin = tagger.decode(x)
        for own, e, m in zip(tags, scores, margin):
            def worth(path):
                return sum(e[t, k] + steps[path[t - 1] if t else 0, k] for t, k in enumerate(path))

            best = max(itertools.product(range(5), repeat=5), key=worth)
            assert math.isclose(worth(tuple(own)), worth(best), rel_tol=1e-4)
            assert all(allowed[a, b] for a, b in zip((0, *own), own))
            assert np.allclose(m, [e[t, k] - e[t, 0] for t, k in enumerate(own)])


def plain_features(text):
    found = set()
    for word in (text or "").split():
        word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
        found.update(toxicity._features(word.encode()))
    return found


def test_chain_equals_plain_loops():
    texts = ["Bad bad apple pie", None, "", "sweet apples, bad! " + "x" * 60, "nothing known"]
    names = sorted(set().union(*map(plain_features, texts)) - {"nothing", "noth-", "nothi-"})
    rng = np.random.default_rng(3)
    chain = toxicity.Chain(
        ["junk", "toxic"], {f: i for i, f in enumerate(names)}, [0.3, -0.4],
        [rng.normal(size=len(names)) for _ in range(2)], [np.zeros(0), np.array([1.7])],
    )
    text, feature, _ = toxicity._present(pa.array(texts), chain.features)
    got = chain.probabilities(len(texts), text, feature)
    for own, row in zip(texts, got):
        before = []
        for k in range(2):
            z = chain.bias[k] + sum(chain.weights[k][chain.features[f]] for f in plain_features(own) if f in chain.features)
            z += sum(p * w for p, w in zip(before, chain.earlier[k]))
            before.append(1 / (1 + math.exp(-z)))
        assert np.allclose(row, before)
    assert any(len(f) == 32 for f in names)
