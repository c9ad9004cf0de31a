import hashlib
import random
import struct
import zlib

import pytest

from registrum.llm.matroska import BLOCK, BLOCK_GROUP, CLUSTER, CUES, DOC_TYPE, EBML, EBML_LACE, FIXED, NO_LACE, SEGMENT, SIMPLE_BLOCK, TIMESTAMP, XIPH, element, features, lace, laced, mux, number, packets, padded, parse, payload_of, read_vint, to_media, vint


@pytest.mark.parametrize("n", [0, 1, 126, 127, 128, 16382, 16383, 1 << 20, (1 << 28) - 2, 1 << 40])
def test_numbers(n):
    assert read_vint(vint(n), 0) == (n, len(vint(n)))
    assert read_vint(b"\xff", 0) == (None, 1) and read_vint(b"\x1a\x45\xdf\xa3", 0, keep=True) == (EBML, 4)


@pytest.mark.parametrize("kind", [NO_LACE, XIPH, FIXED, EBML_LACE])
def test_lacing(kind):
    r = random.Random(kind)
    for _ in range(50):
        sizes = [r.choice([0, 1, 5, 254, 255, 256, 700, 9000]) for _ in range(r.randint(1, 6))]
        frames = [r.randbytes(sizes[0] if kind == FIXED else n) for n in (sizes[:1] if kind == NO_LACE else sizes)]
        data = lace(frames, kind)
        assert [data[a : a + n] for a, n in laced(data, 0, len(data), kind)] == frames


@pytest.mark.parametrize("size", [64, 448, 512, 576, 4096, 4160, 131072, 131136, 300032])
def test_round_trip(size):
    payload = random.Random(size).randbytes(size)
    data = mux(payload)
    p = parse(data)
    assert payload_of(data, p) == payload and p.doc_type == "matroska" and p.tracks[0]["codec"] == "A_PCM/INT/LIT"
    assert [t for _, t, *_ in p.packets] == [k * 64_000_000 for k in range(len(p.packets))]
    assert p.duration == size / 8 and len(p.cues) == len(p.clusters)


def test_unknown_sizes_groups_and_other_tracks():
    head = element(EBML, element(DOC_TYPE, b"webm"))
    block = b"\x82" + struct.pack(">hB", 5, 0) + b"abc"
    cluster = CLUSTER.to_bytes(4, "big") + b"\x01\xff\xff\xff\xff\xff\xff\xff" + number(TIMESTAMP, 10) + element(BLOCK_GROUP, element(BLOCK, block)) + element(0xEC, b"void") + element(SIMPLE_BLOCK, block)
    data = head + SEGMENT.to_bytes(4, "big") + b"\xff" + cluster + cluster + element(CUES, b"")
    p = parse(data)
    assert [(x[0], x[1], data[x[2] : x[2] + x[3]]) for x in p.packets] == [(2, 15_000_000, b"abc")] * 4 and len(p.clusters) == 2


@pytest.mark.parametrize("data", [b"", b"\x00\x01", b"RIFFxxxx", mux(b"x" * 64)[:-3]])
def test_broken_files(data):
    with pytest.raises((ValueError, IndexError)):
        if parse(data).doc_type == "":
            raise ValueError


def test_columns(corpus, odd, empty):
    got = sorted(features(to_media(odd)).collect(), key=repr)
    want = sorted((padded(r.text) for r in odd.collect()), key=repr)
    assert sorted((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == sorted((n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) for n, p in want)
    assert len({r.feature for r in got if r.n_bytes == 11}) == 1
    media = to_media(odd)
    assert packets(media).count() == sum(-(-len(p) // 512) for _, p in want)
    assert features(to_media(empty)).collect() == []


def test_null_and_broken_media(spark):
    whole = mux(padded("text")[1])
    media = spark.createDataFrame([(1, 4, whole), (2, None, None), (3, 0, b""), (4, 9, whole[:40]), (5, 1, b"\x00" * 50), (None, 4, whole)], "doc_id long, n_bytes long, media binary")
    got = features(media).collect()
    assert [r.payload_bytes for r in got if r.doc_id in (1, None)] == [64, 64]
    by_id = {r.doc_id: r for r in got}
    assert by_id[2][2:] == (None,) * 6 and by_id[5].media_bytes == 50
    assert all(by_id[k].payload_sha256 != by_id[1].payload_sha256 for k in (3, 4, 5))
    assert {r.doc_id for r in packets(media).collect()} >= {1, None}
