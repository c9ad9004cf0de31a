import os
import random
import zlib
from concurrent.futures import ThreadPoolExecutor
from fractions import Fraction

import pyarrow.parquet as pq
import pytest

from registrum.llm.mixing import by_length, mixed_documents, pareto_mix
from registrum.llm.sharding import Conflict, ShardStore, nullable, placement, shard_documents, shard_placement


def targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), copies=2):
    """By repeated resharing, as the words of the contract say."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out = dict.fromkeys(names, Fraction(0))
    left, open_ = share * sum(sizes.values()), set(names)
    while left > 0 and open_:
        total = sum(w[s] for s in open_)
        give = {s: left * w[s] / total for s in open_}
        left = Fraction(0)
        for s, g in give.items():
            out[s] += g
            if out[s] > copies * sizes[s]:
                left += out[s] - copies * sizes[s]
                out[s] = Fraction(copies * sizes[s])
                open_.discard(s)
    return out


def test_targets_and_sums(corpus):
    r = random.Random(3)
    sources = [r.choice(["hot"] * 6 + ["a", "b", "c", "é", None]) for _ in range(400)]
    texts = [" ".join("w" for _ in range(r.choice([1, 3, 20, 200]))) for _ in sources]
    got = pareto_mix(corpus(texts, sources)).collect()
    sizes = {}
    for s, t in zip(sources, texts, strict=True):
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(float(want[x.source]))
        assert 0 <= x.taken <= 2 * x.size
        taken[x.source] += x.taken
    assert all(0 <= float(want[s]) - taken[s] < 1 for s in sizes)
    # Pareto: no document that is passed over has a lesser score than one that is taken.
    for s in sizes:
        more = [(x.score, x.taken - x.whole * x.size) for x in got if x.source == s and x.score is not None and x.size]
        inside, outside = [a for a, b in more if b > 0], [a for a, b in more if b <= 0]
        assert not inside or not outside or max(inside) <= min(outside)
    assert sorted(map(tuple, pareto_mix(corpus(texts, sources)).select("doc_id", "taken").collect())) == sorted((x.doc_id, x.taken) for x in got)


def test_weights_change_the_odds(corpus):
    from pyspark.sql import functions as F

    df = corpus(["w w w w"] * 300, ["s"] * 300).withColumn("m", F.when(F.col("doc_id") < 100, 3.0).otherwise(0.5))
    got = pareto_mix(df, share=(1, 2), weight_col="m").collect()
    rate = [sum(x.taken for x in got if (x.doc_id < 100) == early) for early in (True, False)]
    assert sum(rate) == 600 and rate[0] > 1.5 * rate[1]
    assert len({round(x.pi, 6) for x in got}) == 2


def test_odd_rows(odd, empty):
    got = pareto_mix(odd).collect()
    assert len(got) == 10 and all(0 <= x.taken <= 2 * x.size for x in got) and sum(x.size == 0 for x in got) == 4
    assert pareto_mix(empty).collect() == []
    assert mixed_documents(odd).columns == odd.columns and mixed_documents(empty).count() == 0


def test_copies(corpus):
    docs = corpus(["w " * 10] * 50 + ["v " * 10] * 50, ["a"] * 50 + ["b"] * 50)
    n = {r.source: r["count"] for r in mixed_documents(docs).groupBy("source").count().collect()}
    assert n == {"a": 100, "b": 50}


def test_store(spark, corpus, tmp_path):
    docs = corpus([f"text {k} " * 50 for k in range(900)])
    store = ShardStore(spark, f"file://{tmp_path}/s", rows_per_shard=20, base_bytes=1000, target_bytes=9_000)
    assert store.append(docs.filter("doc_id < 600")) == 1 and store.append(docs.filter("doc_id >= 600")) == 2
    before = store.shards()
    assert len(before) >= 45
    store.compact(nullable(docs.schema))
    after = store.shards()
    assert len(after) < len(before) / 3 and max(s.bytes for s in after) < 3 * store.target_bytes and store.plan(after) == []
    back = store.read(nullable(docs.schema))
    assert sorted(map(tuple, back.drop("_shard").collect())) == sorted(map(tuple, docs.collect()))
    assert back.select("_shard").distinct().count() == len(after)
    with pytest.raises(Conflict):
        store.commit(after, 1)
    last = store.version()
    assert last >= 3
    first = store.read(nullable(docs.schema), version=1)
    assert sorted(r.doc_id for r in first.collect()) == list(range(600))
    assert store.expire(keep=1) >= len(before) and store.read(nullable(docs.schema)).count() == 900 and store.version() == last
    with pytest.raises(Exception):  # noqa: B017
        store.shards(1)


def test_two_writers(spark, corpus, tmp_path):
    docs = corpus([f"text {k}" for k in range(40)])
    one, two = (ShardStore(spark, f"file://{tmp_path}/s", fanout=2, rows_per_shard=5) for _ in range(2))
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda k: (one, two)[k % 2].append(docs.filter(f"doc_id % 8 = {k}")), range(8)))
    assert sorted(done) == list(range(1, 9))
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda s: s.compact(nullable(docs.schema)), (one, two)))
    assert sorted(r.doc_id for r in one.read(nullable(docs.schema)).collect()) == list(range(40))


def test_placement_against_the_files(spark, corpus):
    """Every row once, in the file that holds it, with the checksum of its text."""
    docs = corpus([(k % 90, f"text {k} " * (k % 70)) for k in range(200)] + [(None, None)])
    store, back = shard_documents(docs, rows_per_shard=9, base_bytes=500, target_bytes=6000)
    rows = []
    for n, s in enumerate(sorted(store.shards(), key=lambda s: s.name)):
        at = f"{store.root}/{s.name}"
        table = pq.read_table(at.removeprefix("file://"))
        rows += [(i, n, store.tier(s.bytes), os.path.getsize(at.removeprefix("file://")), store.version(), zlib.crc32((t or "").encode())) for i, t in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True)]
    got = placement(store, back).collect()
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in got) and len(rows) == 201


def test_clashing_shard_column(corpus):
    from pyspark.sql import functions as F

    _, back = shard_documents(corpus(["a", "b"]).select("*", F.lit(1).alias("_SHARD"), F.lit(2).alias("_shard_in")))
    assert {(r["__shard_in"], r["_shard_in"]) for r in back.collect()} == {(1, 2)}


def test_odds_by_length_are_filled_up(corpus):
    """Documents of high odds reach two copies, and the others make up for them."""
    texts = ["w " * (1200 if k % 10 == 0 else 150 if k % 3 == 0 else 20) for k in range(120)]
    got = pareto_mix(corpus(texts, ["a", "b"] * 60), share=(17, 10), weights=(1, 1), odds=by_length).collect()
    taken, target = sum(x.taken for x in got), {x.source: x.target for x in got}
    assert 0 <= sum(target.values()) - taken < 2 and all(x.taken <= 2 * x.size for x in got)
    assert len({round(x.pi + x.whole, 9) for x in got}) > 2


@pytest.mark.parametrize("held", [1, 7])
def test_the_end_of_a_target_is_found_in_steps(corpus, monkeypatch, held):
    from registrum.llm import mixing

    r = random.Random(held)
    docs = corpus([(k // 2, "w " * r.randint(0, 9)) for k in range(600)], ["a"] * 500 + [None] * 100)
    want = sorted((x.doc_id, x.taken) for x in pareto_mix(docs).collect())
    monkeypatch.setattr(mixing, "HELD", held)
    monkeypatch.setattr(mixing, "PARTS", 3)
    assert sorted((x.doc_id, x.taken) for x in pareto_mix(docs).collect()) == want


def test_mixed_documents_follow_the_mix(corpus):
    r = random.Random(9)
    docs = corpus(["w " * r.choice([0, 1, 5, 300]) for _ in range(200)], [r.choice(["a", "b", None]) for _ in range(200)])
    n = {x.doc_id: x["count"] for x in mixed_documents(docs).groupBy("doc_id").count().collect()}
    for x in pareto_mix(docs).collect():
        if x.size:
            assert n.get(x.doc_id, 0) == int(x.taken / x.size + 0.5)


def test_plan_takes_similar_sizes(spark, tmp_path):
    from registrum.llm.sharding import Shard

    store = ShardStore(spark, f"file://{tmp_path}/p", base_bytes=10, fanout=4, target_bytes=1000)
    small, large = [Shard(f"a{k}", 12) for k in range(5)], [Shard(f"b{k}", 300) for k in range(3)]
    assert store.plan(small + large) == [small]
    assert [len(r) for r in store.plan([Shard(f"c{k}", 300) for k in range(7)])] == [3, 3]


def test_odd_shards(odd, empty):
    _, back = shard_documents(odd)
    assert sorted(map(repr, (tuple(r)[:5] for r in back.collect()))) == sorted(map(repr, (tuple(r)[:5] for r in odd.collect())))
    assert shard_placement(odd).count() == 10 and shard_placement(empty).count() == 0
