import random
import zlib
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from registrum.llm import decontaminate
from registrum.llm.decontaminate import MASKS, clean, hash_words, leaks, matches, plain_words
from registrum.llm.mixing import pareto_mix
from registrum.llm.quality_fm import EDGES, SIZE, Machine, extract, quality_scores, train, with_scores


def test_pairs_by_the_identity_of_squares():
    r = np.random.default_rng(1)
    m = Machine(rank=4)
    m.w = r.normal(size=SIZE).astype("f4")
    m.v = r.normal(size=m.v.shape).astype("f4")
    place, value = np.array([3, 9, 77, 500]), np.array([1.0, 0.5, -2.0, 0.1], "f4")
    slow = (m.w[place] * value).sum() + sum(m.v[place[i]] @ m.v[place[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    assert np.isclose(m.raw(place, value, np.array([0]))[0][0], slow, rtol=1e-4)


def test_features():
    for text in (None, "", "x", "A b! " * 1000):
        place, value = extract(text)
        assert len(place) == len(value) and 0 <= place.min() and place.max() < SIZE and len(place) >= len(EDGES)
    assert (extract(None)[0] == extract("")[0]).all()


def texts(n, seed):
    r = random.Random(seed)
    good = ["the", "cat", "sat", "on", "a", "mat", "while", "rain", "fell", "over", "hills"]
    out = []
    for k in range(n):
        words = [r.choice(good) for _ in range(r.randint(20, 60))]
        out.append(" ".join(words) + "." if k % 4 else " ".join(w.upper() + "!!" for w in words[:8] * 3))
    return out


def test_held_out_accuracy(corpus, spark):
    docs = corpus(texts(400, 1))
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(0, 400, 2)] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == 400 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in got]) > 0.98
    again = {r.doc_id: r.score for r in quality_scores(docs.repartition(3), labels).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in got)


def test_odd_rows(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_scores(odd, none).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got) and quality_scores(empty, none).collect() == []
    scored = with_scores(odd, train(odd, none))
    assert scored.columns == [*odd.columns, "_quality"]
    with pytest.raises(ValueError, match="_quality"):
        with_scores(scored, Machine())


def words(r, n, top=3000):
    return [f"w{r.randrange(top)}" for _ in range(n)]


def brute_hits(doc, item, least=13, identity=0.8):
    """Whether some alignment without gaps has a run of least equal words, or all of a shorter item, that are identity of it."""
    best = False
    for shift in range(-len(item) + 1, len(doc)):
        a, b = max(0, -shift), min(len(item), len(doc) - shift)
        same = [doc[k + shift] == item[k] for k in range(a, b)]
        for x in range(len(same)):
            for y in range(x + 1, len(same) + 1):
                n = sum(same[x:y])
                if n >= min(least, len(item)) and n >= identity * (y - x):
                    best = True
    return best


def found_in(spark, docs, items):
    """{item: words}, the most equal words for a single item, of each document."""
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    rows = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(docs)], "row long, text string")
    return {r.row: r for r in matches(rows, bench).collect()}


def test_substitutions_against_brute_force(spark):
    r = random.Random(3)
    items = [words(r, n) for n in (3, 7, 14, 20, 40)]
    docs = []
    for k in range(60):
        item = list(r.choice(items))
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            item[r.randrange(len(item))] = "other"
        docs.append(words(r, r.randint(0, 30)) + (item if k % 3 else []) + words(r, r.randint(0, 30)))
    found = found_in(spark, docs, items)
    want = [{k for k, x in enumerate(items) if brute_hits(d, x)} for d in docs]
    got = [found[k].n_items if k in found else 0 for k in range(len(docs))]
    assert all(n <= len(w) for n, w in zip(got, want, strict=True)) and sum(got) >= 0.9 * sum(map(len, want))
    exact = [{k for k, x in enumerate(items) if any(d[i : i + len(x)] == x for i in range(len(d)))} for d in docs]
    assert all(len(e) <= n for e, n in zip(exact, got, strict=True))


def test_each_run_of_an_alignment_with_a_seed(spark):
    """Items and documents have words of their own, so a document can hold its own item only; several runs lie in an alignment."""
    r = random.Random(5)
    pairs = []
    for k in range(150):
        item = [f"i{k}x{j}" for j in range(r.choice([14, 30, 60, 100]))]
        rate = r.choice([0.1, 0.2, 0.25, 0.3])
        pairs.append((item, ["other" if r.random() < rate else w for w in item]))
    item = [f"e{j}" for j in range(60)]
    pairs.append((item, item[:13] + [w if j % 3 else "other" for j, w in enumerate(item[13:])]))
    found = found_in(spark, [d for _, d in pairs], [i for i, _ in pairs])
    want = {}
    for k, (item, doc) in enumerate(pairs):
        same = [a == b for a, b in zip(item, doc, strict=True)]
        sums = np.concatenate([[0], np.cumsum(same)])
        runs = [n for x in range(len(same)) for y in range(x + 13, len(same) + 1) if (n := sums[y] - sums[x]) >= 13 and 5 * n >= 4 * (y - x)]
        if runs:
            want[k] = (1, k, max(runs))
    assert {k: (x.n_items, x.item_id, x.words) for k, x in found.items()} == want and len(want) > 60


def test_hashes_of_words_in_chunks(monkeypatch):
    texts = ["a b, a", None, "", "  Ab aB ", "x" * 50 + " b a " + "y " * 30, "É é"]
    monkeypatch.setattr(decontaminate, "CHUNK", 7)
    got = hash_words(texts)
    names = {}
    for text, h in zip(texts, got, strict=True):
        assert len(h) == len(plain_words(text))
        for w, x in zip(plain_words(text), h.tolist(), strict=True):
            assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)


def test_each_short_run_has_a_seed():
    for n, others in ((13, 0), (14, 1), (15, 2), (16, 3), (17, 3), (20, 4)):
        for at in combinations(range(n), others):
            assert any(all(c == "0" or k + o not in at for o, c in enumerate(m)) for m in MASKS for k in range(n - len(m) + 1))


def test_odd_items_and_rows(odd, empty, corpus, spark):
    r = random.Random(4)
    items = [(k, " ".join(words(r, 30))) for k in range(40)]
    bench = spark.createDataFrame([*items, (None, "lone item of five words"), (99, None), (3, items[3][1])], "item_id long, text string")
    docs = corpus(["x y " + items[3][1].upper() + " z", " ".join(words(r, 50)), "a lone, item: of five WORDS here", f"{items[7][1]}. {items[8][1]}"])
    got = {x.doc_id: (x.contaminated, x.n_items, x.item_id) for x in leaks(docs, bench).collect()}
    assert got == {0: (True, 1, 3), 1: (False, 0, None), 2: (True, 1, -1), 3: (True, 2, 7)}
    assert clean(odd, bench).count() == 10 and clean(odd, bench).columns == odd.columns
    assert leaks(empty, bench).collect() == [] and leaks(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert plain_words(None) == [] and plain_words("É-b, C") == ["é".encode(), b"b", b"c"]


def test_scores_against_a_plain_sum_over_pairs(corpus, spark):
    """The query's scores are those of the machine it fits, summed pair by pair."""
    r = random.Random(6)
    docs = corpus([" ".join(words(r, r.randint(0, 12), 8 + 40 * (k % 2))) for k in range(60)] + [None])
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(3, 0), (None, 1), (4, None)], "doc_id long, quality int")
    m = train(docs, labels)
    got = {x.doc_id: x for x in quality_scores(docs, labels).collect()}
    for x in docs.collect():
        place, value = extract(x.text)
        z = m.w0 + float((m.w[place] * value).sum())
        z += sum(float(m.v[a] @ m.v[b]) * float(value[i]) * float(value[j]) for i, a in enumerate(place) for j, b in enumerate(place) if i < j)
        assert got[x.doc_id].score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)
        assert got[x.doc_id].held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and got[x.doc_id].predicted == int(got[x.doc_id].score >= 0.3)


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_stages_on_odd_tables(table, request, spark, data, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing names in, and what each stage keeps is its own whole rows."""
    docs, folder = request.getfixturevalue(table), str(data / "sf0.001")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name == corpus_pipeline.STAGES[-1][0]:
            assert out.count() == docs.count()
            break
        assert out.columns == docs.columns
        at = f"file://{tmp_path}/{name.replace(' ', '-')}"
        out.write.parquet(at)
        before, docs = {repr(tuple(r)) for r in docs.collect()}, spark.read.parquet(at)
        assert {repr(tuple(r)) for r in docs.collect()} <= before


def test_pipeline_against_plain_stages(spark, data, corpus):
    """On a small table: scores by the machine, similarity of all pairs, items by words, and the mix's own decisions."""
    folder = str(data / "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(120)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    m = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = docs.collect()
    good = [r for r in rows if m.score([extract(r.text)])[0] >= 0.3]
    sets = {}
    for r in good:
        w = (r.text or "").encode().lower().split()
        n = min(5, len(w))
        sets[r.doc_id] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
    group = {i: i for i in sets}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in links:
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    single = {i for i in group if group[i] == i}
    items = [plain_words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    grams = {tuple(x[k : k + 13]) for x in items for k in range(len(x) - 12)}
    leaky = {r.doc_id for r in good if r.doc_id in single and any(tuple(w[k : k + 13]) in grams for w in [plain_words(r.text)] for k in range(len(w) - 12))}
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, folder)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in good}
    one = stages["near duplicates"](spark, kept, folder)
    assert {r.doc_id for r in one.collect()} == single
    safe = stages["decontamination"](spark, one, folder)
    found = {r.doc_id for r in safe.collect()}
    assert not found & leaky and len(found) >= 0.9 * len(single - leaky)
    want = {x.doc_id: int(x.taken / x.size + 0.5) if x.size else None for x in pareto_mix(safe).collect()}
    copies = {r.doc_id: r["count"] for r in stages["mixing"](spark, safe, folder).groupBy("doc_id").count().collect()}
    assert all(n is None or copies.get(i, 0) == n for i, n in want.items())


def test_pipeline(spark, data):
    folder = str(data / "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    from registrum.llm import near_dedup

    by_id = {r.doc_id: r for r in docs.collect()}
    good = corpus_pipeline.classify(spark, docs, folder)
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) > 0.95 * len(labels)
    single = corpus_pipeline.deduplicate(spark, good, folder)
    groups = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(good).collect()}
    assert {r.doc_id for r in single.collect()} == set(groups.values())
    rows = corpus_pipeline.run(spark, folder)
    import zlib

    out = rows.collect()
    assert out and all(r.doc_id in kept and zlib.crc32(by_id[r.doc_id].text.encode()) == r.text_crc32 for r in out)
