import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from registrum.llm import hmm_lm
from registrum.llm.hmm_lm import CLASSES, HMM, Expected, likelihood, score_documents


def random_model(k=3, seed=1):
    r = np.random.default_rng(seed)
    emit = np.zeros((CLASSES, k))
    emit[:4] = r.dirichlet(np.ones(4), k).T
    return HMM(r.dirichlet(np.ones(k)), r.dirichlet(np.ones(k), k), emit)


def paths(m, seq):
    """(probability, states) of every path."""
    for states in itertools.product(range(m.states), repeat=len(seq)):
        p = m.start[states[0]] * m.emit[seq[0], states[0]]
        for a, b, x in zip(states, states[1:], seq[1:], strict=False):
            p *= m.move[a, b] * m.emit[x, b]
        yield p, states


def test_forward_recursion_against_all_paths():
    m, r = random_model(), np.random.default_rng(2)
    docs = [r.integers(0, 4, n).astype("i4") for n in (1, 2, 5, 3, 5)]
    got = likelihood(m, docs)
    for d, x in zip(docs, got, strict=True):
        assert math.isclose(10**x, sum(p for p, _ in paths(m, d)), rel_tol=1e-9)


@pytest.mark.parametrize("cells", [1 << 21, 1, 4])
def test_expected_counts_against_all_paths(monkeypatch, cells):
    monkeypatch.setattr(hmm_lm, "CELLS", cells)
    m = random_model()
    docs = [np.array(d, "i4") for d in ([0, 1, 2, 3], [2], [3, 3, 1])]
    e = Expected(m)
    e.add(docs)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for d in docs:
        total = sum(p for p, _ in paths(m, d))
        for p, s in paths(m, d):
            start[s[0]] += p / total
            for a, b in zip(s, s[1:], strict=False):
                move[a, b] += p / total
            for x, a in zip(d, s, strict=True):
                emit[x, a] += p / total
    assert np.allclose(e.start, start, atol=1e-4) and np.allclose(e.move, move, atol=1e-4) and np.allclose(e.emit[:4], emit, atol=1e-4)


def test_baum_welch_never_loses():
    m, r = random_model(), np.random.default_rng(3)
    docs = [r.integers(0, 4, 30).astype("i4") for _ in range(20)]
    before = likelihood(m, docs).sum()
    for _ in range(3):
        e = Expected(m)
        e.add(docs)
        m = HMM(e.start / e.start.sum(), e.move / e.move.sum(1, keepdims=True), e.emit / e.emit.sum(0))
        assert (now := likelihood(m, docs).sum()) >= before - 1e-3
        before = now


def test_scores(corpus, monkeypatch):
    texts = [f"the cat {k % 5} sat on the mat {k}" for k in range(60)] + ["der hund lief schnell nach hause" for _ in range(60)]
    got = {r.doc_id: r for r in score_documents(corpus(texts), states=2).collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in got}
    tokens = [t.split() + ["\0end"] for t in texts]
    c = Counter(w for i, t in enumerate(tokens) if not fold[i] for w in t)
    total, size = sum(c.values()), len(c)
    for i, t in enumerate(tokens):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[i], len(t), sum(w in c for w in t), total)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (total + size + 1)) for w in t), rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_go_through_the_join(corpus, monkeypatch):
    texts = [f"a b w{k % 40} q{k}" for k in range(80)]
    whole = {r.doc_id: tuple(r) for r in score_documents(corpus(texts), states=2).collect()}
    monkeypatch.setattr(hmm_lm, "LOOKUP", 5)
    few = {r.doc_id: tuple(r) for r in score_documents(corpus(texts), states=2).collect()}
    for i in whole:
        assert whole[i][:5] == few[i][:5] and math.isclose(whole[i][5], few[i][5], rel_tol=1e-9) and few[i][6] < 0


def test_odd_rows(odd, empty, corpus):
    got = score_documents(odd, states=2).collect()
    assert len(got) == 10 and sorted(r.n_tokens for r in got)[:4] == [1, 1, 1, 1] and all(np.isfinite(r.score) for r in got)
    assert score_documents(empty).collect() == []
    alone = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = score_documents(corpus([(alone, "x y")])).first()
    assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) and np.isfinite(r.score)
