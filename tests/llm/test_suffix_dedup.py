import hashlib
import random

import numpy as np
import pytest

from registrum.llm import suffix_dedup
from registrum.llm.collection_bwt import build
from registrum.llm.segments import Segmenter
from registrum.llm.suffix_dedup import dedup, digest


def brute(rows, window):
    """rows: (id, text) in order. (n_bytes, n_removed, n_spans, sha256) of each."""
    seen, out = set(), []
    for _, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - window + 1):
            if raw[k : k + window] in seen:
                gone[k : k + window] = True
            seen.add(raw[k : k + window])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(raw, "u1")[~gone])).hexdigest()))
    return out


def passages(seed, n=40):
    r = random.Random(seed)
    shared = ["".join(r.choice("abc é") for _ in range(r.randint(60, 300))) for _ in range(6)]
    def text():
        parts = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(0, 120)))]
        for _ in range(r.randint(0, 4)):
            parts.append(r.choice(shared)[r.randint(0, 30) :])
            parts.append("".join(r.choice("xyz ") for _ in range(r.randint(0, 50))))
        return "".join(parts)
    return [text() for _ in range(n)] + ["ab" * 200, "a" * 99, "a" * 100, "a" * 150, "", None]


@pytest.mark.parametrize("hot", [2048, 3])
def test_against_brute_force(corpus, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = passages(hot)
    got = {r.doc_id: tuple(r)[1:] for r in digest(dedup(corpus(texts).repartition(3), 100)).collect()}
    assert got == dict(enumerate(brute(list(enumerate(texts)), 100)))


def test_order_of_columns_and_prefixes():
    r = random.Random(5)
    for t in range(60):
        strings = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 8))]
        want = sorted((([x + 1 for x in s[k:]] + [0], i, len(s) - k, s[k - 1] + 1 if k else 0) for i, s in enumerate(strings) for k in range(len(s) + 1)), key=lambda x: x[:2])
        bwt, lcp, who, size = build(strings, limit=1 if t % 2 else 1 << 30)
        assert [(w, n, b) for w, n, b in zip(who.tolist(), size.tolist(), bwt.tolist(), strict=True)] == [x[1:] for x in want]

        def shared(a, b):
            k = 0
            while a[k] == b[k] != 0:
                k += 1
            return k

        assert lcp.tolist() == [0, *(shared(a[0], b[0]) for a, b in zip(want, want[1:], strict=False))]


def test_equal_windows_have_equal_minimizers():
    r = random.Random(6)
    part = bytes(r.choice(b"abcd") for _ in range(500))
    docs = [b"x" * 37 + part, part + b"yy", part[100:300], b"", b"z" * 99]
    cut = Segmenter(100, 32)
    first, n, mini, h, _ = cut(np.frombuffer(b"".join(docs), "u1"), np.cumsum([len(d) for d in docs]))
    data, at = b"".join(docs), {}
    for f, c, m, x in zip(first.tolist(), n.tolist(), mini.tolist(), h.tolist(), strict=True):
        for k in range(f, f + c):
            assert at.setdefault(data[k : k + 100], (m - k, x)) == (m - k, x)
    assert n.sum() == sum(max(0, len(d) - 99) for d in docs)


def test_parts_of_long_texts(corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 150)
    texts = passages(9, 10)
    got = {r.doc_id: tuple(r)[1:] for r in digest(dedup(corpus(texts), 100)).collect()}
    assert got == dict(enumerate(brute(list(enumerate(texts)), 100)))


def test_odd_rows(odd, empty, corpus):
    assert digest(dedup(odd)).count() == 10 and digest(dedup(empty)).collect() == []
    r = random.Random(1)
    text = "".join(r.choice("abcdef") for _ in range(300))
    rows = digest(dedup(corpus([(3, text), (1, text), (1, text), (None, text)]))).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows) == [(False, 1, 0), (False, 1, 300), (False, 3, 300), (True, 0, 300)]
