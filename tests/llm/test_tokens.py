import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from registrum.llm.common import filesystem, scratch
from registrum.llm.encoding import Encoder, hugging, ranked
from registrum.llm.separator_scan import count_tokens, scan
from registrum.llm.token_store import Reader, read_store, store_ids, write_store

BPE, MULTI = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
encode, multi = hugging(BPE), ranked(MULTI, P.PATTERN)
memo = Encoder(encode, 2, limit=200)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abz,.!'s 1\n\t_é́²　\x00\x1c-"), max_size=30), max_size=5))
def test_pieces_give_the_ids_of_the_whole(texts):
    want = [list(x) for x in encode(texts)] if texts else []
    assert [x.tolist() for x in memo(texts)] == want
    assert [x.tolist() for x in memo(texts, size=4)] == want


def test_store_round_trip(corpus, spark):
    r = random.Random(1)
    texts = [" ".join(r.choice(["the", "cat,", "Über.", "\n", "x1", "don't"]) for _ in range(r.randint(0, 40))) for _ in range(300)]
    order = list(enumerate(texts))
    r.shuffle(order)
    root = scratch(spark, "test-ids")
    files = write_store(corpus(order).repartition(3), root, BPE)
    got = {x.doc_id: x for x in read_store(spark, root, files).collect()}
    at = 0
    for i, ids in enumerate(encode(texts)):
        ids = [*ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    fs, folder = filesystem(root)
    with fs.open_input_stream(f"{folder}/dictionary") as f:
        raw = f.read()
    found = []
    for path, *_ in files:
        with fs.open_input_file(filesystem(path)[1]) as f:
            found += [x.tolist() for x in Reader(f, raw).get(7)]
    assert found == [[*encode([texts[7]])[0], 2]]
    with fs.open_input_file(filesystem(files[0][0])[1]) as f, pytest.raises(ValueError, match="dictionary"):
        Reader(f, raw + b"x")


def test_odd_stores(odd, empty):
    got = store_ids(odd, BPE).collect()
    assert len(got) == 10 and [r.n_tokens for r in got if r.doc_id in (2, 4)] == [1, 1]
    assert sorted(r.start for r in got) == [sum(x.n_tokens for x in sorted(got, key=lambda x: x.start)[:k]) for k in range(10)]
    assert {r.doc_id for r in sorted(got, key=lambda r: r.start)[-2:]} == {None}
    assert store_ids(empty, BPE).collect() == []


def test_counts(corpus, odd, empty):
    texts = [f"word{k} " * (k % 50) + "#" for k in range(200)]
    got = {r.doc_id: r.n_tokens for r in count_tokens(corpus(texts), MULTI, pattern=P.PATTERN, separator=50256).collect()}
    assert got == {k: len(x) for k, x in enumerate(multi(texts))}
    assert sorted(r.n_tokens for r in count_tokens(odd, MULTI, pattern=P.PATTERN, separator=50256).collect())[:3] == [0, 0, 0]
    assert count_tokens(empty, MULTI, pattern=P.PATTERN, separator=50256).collect() == []


@pytest.mark.parametrize("block", [2, 6, 64])
def test_blocks_are_stitched(spark, block):
    r = random.Random(block)
    root = scratch(spark, "test-flat")
    fs, at = filesystem(root)
    fs.create_dir(at)
    want = set()
    for name in ("a.ids", "b.ids", "none.ids"):
        ids = [] if name == "none.ids" else [r.choice([1, 2, 3, 9]) for _ in range(60)]
        with fs.open_output_stream(f"{at}/{name}") as f:
            f.write(np.array(ids, "<u2").tobytes())
        begin = place = 0
        for k, x in enumerate(ids):
            if x == 9:
                want.add((name, place, begin, k - begin))
                begin, place = k + 1, place + 1
    assert {tuple(x) for x in scan(spark, root, separator=9, block_bytes=block).collect()} == want
