import random
from functools import partial

import numpy as np
import pytest

from registrum.llm import near_dedup
from registrum.llm.common import components
from registrum.llm.near_dedup import SIDE, Shingler, may_be_similar, near_duplicates, one_of_each, parity, similar, sketch, table_keys


def brute(texts, size, percent=80):
    def shingles(t):
        w = (t or "").encode().lower().split()
        n = min(size, len(w))
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()

    sets = {i: shingles(t) for i, t in texts}
    label = {i: i for i in sets}
    for _ in sets:
        for i, a in sets.items():
            for j, b in sets.items():
                if i != j and a and b and 100 * len(a & b) >= percent * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    return {i: (len(s), label[i], label[i] == i) for i, s in sets.items()}


def edited(r, words, n):
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"n{r.randrange(10**6)}"
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(corpus, size):
    r = random.Random(size)
    texts = []
    for _ in range(12):
        base = [f"w{r.randrange(300)}" for _ in range(r.choice([3, 30, 80]))]
        texts += [" ".join(edited(r, base, r.choice([0, 0, 1, 2, 4, 6]))) for _ in range(r.randint(1, 12))]
    texts += ["", "a", "A", "b c", None]
    r.shuffle(texts)
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(corpus(texts).repartition(3, "doc_id"), shingle=size).collect()}
    assert got == brute(list(enumerate(texts)), size)


def test_groups_that_share_a_passage_are_not_linked(corpus):
    r = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [passage + " " + " ".join(f"o{r.randrange(10**6)}" for _ in range(15)) for _ in range(60)]
    got = near_duplicates(corpus(texts), shingle=2).collect()
    assert all(x.kept for x in got)


def test_chains(corpus):
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join([*[f"c{k}x{j}" for j in range(3 * k)], *base[3 * k :]]) for k in range(8)]
    assert {x.component_id for x in near_duplicates(corpus(texts), shingle=2).collect()} == {v[1] for v in brute(list(enumerate(texts)), 2).values()}


def test_link_that_does_not_run_through_hubs(corpus, monkeypatch):
    """Two groups of near copies in tasks of their own; of all pairs between them only that of the two last nodes, which are no hubs, is similar."""
    common = [f"s{k}" for k in range(80)]
    x, y = common + [f"x{k}" for k in range(10)], common + [f"y{k}" for k in range(10)]
    groups = [[[w if w != f"s{k}" else f"{g}{k}" for w in last] for k in range(30)] + [last] for g, last in (("a", x), ("b", y))]
    texts = [" ".join(t) for g in groups for t in g]
    docs = corpus(texts).coalesce(1)
    keep = near_dedup.written

    def two_tasks(df, name, *codec):
        out = keep(df, name, *codec)
        if name != "nodes":
            return out
        out = out.withColumn("node", out.row).repartitionByRange(2, out.least >= 31)
        assert out.rdd.glom().map(lambda rows: {r.least >= 31 for r in rows}).collect() == [{False}, {True}]
        return out

    monkeypatch.setattr(near_dedup, "written", two_tasks)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, shingle=1).collect()}
    assert got == brute(list(enumerate(texts)), 1) and sum(k for _, _, k in got.values()) == 1


def test_parity_rules_out_only_what_is_not_similar():
    r = np.random.default_rng(1)
    for n in (5, 50, 800):
        for cut in (0, 0.05, 0.1, 0.11, 0.2, 0.5):
            a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[int(cut * n) :], r.integers(0, 1 << 63, int(cut * n), dtype=np.uint64)]))
            assert not similar(a, b, 80) or may_be_similar(parity(a), parity(b), 80)


def test_tensored_keys():
    a = np.arange(50, dtype="u8") * np.uint64(0x9E3779B97F4A7C15)
    keys = table_keys(np.stack([sketch(np.sort(a)), sketch(np.sort(a))]))
    assert keys.shape == (2, SIDE * SIDE) and (keys[0] == keys[1]).all() and len(set(keys[0].tolist())) == SIDE * SIDE


def test_shingles_across_the_memo():
    s = Shingler(2)
    assert len(s("a b a b")) == 2 and len(s("a")) == 1 and len(s("")) == 0 and (s("A B") == s("a  b")).all()


@pytest.mark.parametrize("most", [1 << 20, 7])
def test_components(spark, most):
    r = random.Random(2)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(1000, k) for k in range(1001, 1100)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert {x.node: x.component for x in components(spark.createDataFrame(edges, "u long, v long"), most=most).collect()} == label


def test_odd_rows(odd, empty, corpus):
    got = near_duplicates(odd, shingle=2).collect()
    assert len(got) == 10 and sum(x.n_shingles == 0 for x in got) == 4
    assert {x.component_id for x in got if x.n_shingles == 5} == {1}
    kept = one_of_each(odd, shingle=2)
    assert kept.columns == odd.columns and sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == [1, 2, 4, 5, 7, 8, 9]
    assert near_duplicates(empty).collect() == [] and one_of_each(empty).collect() == []


def test_small_tasks(corpus, monkeypatch):
    """Hubs of a few pairs are dealt to several tasks, and tasks hold few nodes before they hand over hubs."""
    r = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(edited(r, base, r.choice([0, 1, 2]))) for _ in range(40)]
    monkeypatch.setattr(near_dedup, "compared", partial(near_dedup.compared, most=2))
    monkeypatch.setattr(near_dedup, "star_pairs", partial(near_dedup.star_pairs, held=3))
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(corpus(texts).repartition(3, "doc_id"), shingle=2).collect()}
    assert got == brute(list(enumerate(texts)), 2)
