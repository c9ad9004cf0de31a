"""Benchmark decontamination by spaced seeds that tolerate substituted words."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Beside, beside, bit_map, bounded_batches, free_name, in_map, lean, need, numbered, sliced, written
from .segments import BASE, powers

#: Where a mask has 0, the word there may differ. The last has a seed in each run of 13 equal words or more with s others that are at
#: most a fifth: 13 or 4 s equal words fall into s + 1 stretches, so one of these has four.
MASKS = ("110110101011", "1110010110111", "101101110011", "11101101", "1111")
#: Of items that are shorter than a mask: all their words.
WHOLE = tuple("1" * n for n in range(1, min(map(len, MASKS))))
#: Of texts in lower case: ASCII marks to spaces. What is left between spaces is a word.
TABLE = bytes(ord(c.lower()) if (c := chr(i)).isalnum() and i < 128 else i if i >= 128 else 32 for i in range(256))
FACTORS = np.random.default_rng(20).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes whose words are hashed at once, and copies of the benchmark's side of a join, among which rows of a common seed or item are dealt.
CHUNK, SALT = 1 << 20, 8

_up, _down = powers(BASE, 1), powers(BASE, 1)


def plain_words(text: str | None) -> list[bytes]:
    return plain(text).split()


def plain(text: str | None) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(TABLE) if text else b""


def hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the words of plain() bytes. A word's hash depends on its bytes alone."""
    global _up, _down
    if len(data) > len(_up):
        _up, _down = powers(BASE, len(data)), powers(pow(BASE, -1, 1 << 64), len(data))
    raw = np.frombuffer(data, "u1")
    ink = np.concatenate([[False], raw != 32, [False]])
    first, stop = np.flatnonzero(ink[1:] & ~ink[:-1]), np.flatnonzero(ink[:-1] & ~ink[1:])
    total = np.zeros(len(raw) + 1, "u8")
    np.cumsum((raw.astype("u8") + np.uint64(1)) * _up[: len(raw)], out=total[1:])
    h = (total[stop] - total[first]) * _down[first] if len(first) else np.zeros(0, "u8")
    h = (h ^ h >> np.uint64(32)) * FACTORS[63]
    return h ^ h >> np.uint64(29), first


def hash_words(texts: list[str | None]) -> list[np.ndarray]:
    """The hashes of each text's words."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    held: list[tuple[int, bytes]] = []

    def flush() -> None:
        h, places = hashed(b" ".join(x for _, x in held))
        ends = np.searchsorted(places, np.cumsum([len(x) + 1 for _, x in held]), "left")
        for (k, _), a, b in zip(held, np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
            out[k].append(h[a:b])
        held.clear()

    room = CHUNK
    for k, text in enumerate(texts):
        raw, at = plain(text), 0
        while at < len(raw) or not at:  # a text beyond CHUNK is cut at spaces
            end = len(raw) if len(raw) - at <= CHUNK else raw.find(b" ", at + CHUNK)
            end = len(raw) if end < 0 else end
            held.append((k, raw[at:end]))
            room -= end - at + 1
            at = end + 1
            if room <= 0:
                flush()
                room = CHUNK
    if held:
        flush()
    return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def seed_places(words: np.ndarray, mask: str, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) where all words under the mask are known."""
    span, offsets = len(mask), [k for k, c in enumerate(mask) if c == "1"]
    if len(words) < span:
        return np.zeros(0, "i8"), np.zeros(0, "u8")
    at = np.flatnonzero(known[: len(words) - span + 1])
    for o in offsets[1:]:
        at = at[known[at + o]]
    h = np.full(len(at), span, "u8")
    for k, o in enumerate(offsets):
        h += (words[at + o] ^ words[at + o] >> np.uint64(32)) * FACTORS[k]
        h ^= h >> np.uint64(29)
    return at, h * FACTORS[62]


def most_equal(same: np.ndarray, identity: float) -> int:
    """The most equal words of a run of an alignment of which they are at least the identity."""
    equal = np.concatenate([[0], np.cumsum(same)])
    part = Fraction(identity).limit_denominator(10_000)
    # A run qualifies where the balance is not lower at its end than at its begin; the first such begin has the most equal words.
    balance = part.denominator * equal - part.numerator * np.arange(len(equal))
    begin = np.searchsorted(-np.minimum.accumulate(balance), -balance, "left")
    return int((equal - equal[begin]).max())


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item, item_id (null: -1), n and words (hashes) of each different row of the benchmark that has words."""

    def make(batches):
        for b in sliced(batches):
            found = hash_words(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("item"), b.column("item_id"), pa.array([len(x) for x in found], pa.int32()), pa.array([x.tobytes() for x in found], pa.binary())], names=["item", "item_id", "n", "words"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(-1)).alias("item_id"), "text").distinct()
    rows = numbered(rows, "item").select("item", "item_id", "text")
    return written(rows.mapInArrow(lean(make), "item long, item_id long, n int, words binary").filter("n > 0"), "items")


def item_seeds(items: DataFrame) -> DataFrame:
    """seed, mask (its number), item, at: seeds of the items under all masks; of those shorter than a mask, their words as a whole."""

    def make(batches):
        for b in sliced(batches):
            for item, words in zip(b.column("item").to_pylist(), b.column("words").to_pylist(), strict=True):
                ids = np.frombuffer(words, "u8")
                all_known = np.ones(len(ids), bool)
                masks = [len(MASKS) + len(ids) - 1] if len(ids) <= len(WHOLE) else range(len(MASKS))
                for m in masks:
                    at, h = seed_places(ids, (*MASKS, *WHOLE)[m], all_known)
                    if len(h):
                        yield pa.RecordBatch.from_arrays([pa.array(h.view("i8")), pa.array(np.full(len(h), m, "i4")), pa.array(np.full(len(h), item)), pa.array(at)], names=["seed", "mask", "item", "at"])

    return written(items.select("item", "words").mapInArrow(lean(make), "seed long, mask int, item long, at long"), "seeds")


def salted(small: DataFrame, name: str) -> DataFrame:
    return small.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def alignments(docs: DataFrame, seeds: DataFrame, items: DataFrame) -> DataFrame:
    """row, item, shift: where a document (row, text) shares a seed with an item, by a join on the seeds' hashes. Maps of the seeds and of the
    items' words, whose size follows from their number within bounds, spare seeds that cannot meet; full maps would let all of them pass."""
    spark = docs.sparkSession

    def spell(batches):
        for b in sliced(batches):
            words = np.unique(np.frombuffer(b"".join(b.column("words").to_pylist()), "i8"))
            yield pa.RecordBatch.from_arrays([pa.array(words)], names=["w"])

    masks = sorted(r.mask for r in seeds.select("mask").distinct().collect())
    seed_map = spark.sparkContext.broadcast(bit_map(seeds.select("seed"), "seed"))
    word_map = spark.sparkContext.broadcast(bit_map(items.select("words").mapInArrow(lean(spell), "w long"), "w"))

    def make(batches):
        for b in sliced(batches):
            texts = hash_words(b.column("text").to_pylist())
            gap = np.zeros(64, "u8")  # no mask is as long
            flat = np.concatenate([x for t in texts for x in (t, gap)]) if texts else gap
            starts = np.concatenate([[0], np.cumsum([len(t) + len(gap) for t in texts])])
            known = in_map(word_map.value, flat)
            for s, t in zip(starts[:-1].tolist(), texts, strict=True):
                known[s + len(t) : s + len(t) + len(gap)] = False
            for m in masks:
                at, h = seed_places(flat, (*MASKS, *WHOLE)[m], known)
                want = in_map(seed_map.value, h)
                at, h = at[want], h[want]
                if not len(at):
                    continue
                doc = np.searchsorted(starts, at, "right") - 1
                place = at - starts[doc]
                if m >= len(MASKS):  # an item is found as a whole or not, so one place is enough
                    _, one = np.unique(np.stack([doc.view("u8"), h], 1), axis=0, return_index=True)
                    doc, place, h = doc[one], place[one], h[one]
                rows = b.column("row").to_numpy()[doc]
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(h.view("i8")), pa.array(np.full(len(h), m, "i4")), pa.array(place)], names=["row", "seed", "mask", "place"])

    found = docs.select("row", "text").mapInArrow(lean(make), "row long, seed long, mask int, place long").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int"))
    met = found.join(salted(seeds, "salt"), ["seed", "mask", "salt"])
    return written(met.select("row", "item", (F.col("place") - F.col("at")).alias("shift")).distinct(), "alignments")


def matches(docs: DataFrame, benchmark: DataFrame, *, min_match: int = 13, identity: float = 0.8) -> DataFrame:
    """row, n_items, item_id (the least), words (the most equal words of one of them): the rows of docs (row, text) in which items are found.

    An item is found where a run of its words, aligned without gaps, has min_match equal words (or all words of a shorter item)
    and they are at least `identity` of the run. All runs of each alignment that has a seed are looked at. Seeds of documents and of items are joined by
    their hashes; the document's words under an alignment are then cut out of the text, which is not shuffled, and joined with the item's.
    """
    items = benchmark_items(benchmark)
    met = alignments(docs, item_seeds(items), items)
    at = beside(met.join(F.broadcast(items.select("item", "n")) if items.count() <= 1_000_000 else items.select("item", "n"), "item").select("row", "item", "shift", "n"), "alignments")

    def cut_out(batches):
        lists = Beside(at)
        for b in sliced(batches):
            wanted = [(k, row, of) for k, row in enumerate(b.column("row").to_pylist()) if (of := lists.of(row)) is not None]
            if not wanted:
                continue
            words = hash_words(b.column("text").take(pa.array([k for k, *_ in wanted])).to_pylist())
            out: list[tuple] = []
            for (_, row, of), w in zip(wanted, words, strict=True):
                for item, shift, n in zip(of["item"].tolist(), of["shift"].tolist(), of["n"].tolist(), strict=True):
                    out.append((row, item, max(0, -shift), w[max(0, shift) : shift + n].tobytes()))
                    if len(out) >= 10_000:
                        yield pieces(out)
                        out = []
            if out:
                yield pieces(out)

    def pieces(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["row", "item", "begin", "piece"])

    def verify(batches):
        for b in sliced(batches):
            out = []
            for row, item, item_id, n, begin, piece, words in zip(*[b.column(c).to_pylist() for c in ("row", "item", "item_id", "n", "begin", "piece", "words")], strict=True):
                own = np.frombuffer(piece, "u8")
                equal = most_equal(own == np.frombuffer(words, "u8")[begin : begin + len(own)], identity)
                if equal >= min(min_match, n):
                    out.append((row, item, item_id, equal))
            columns = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["row", "item", "item_id", "words"])

    found = docs.select("row", "text").mapInArrow(lean(cut_out), "row long, item long, begin int, piece binary").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int"))
    sure = found.join(salted(items, "salt"), ["item", "salt"]).mapInArrow(lean(verify), "row long, item long, item_id long, words int")
    return written(sure.groupBy("row").agg(F.count_distinct("item").cast("int").alias("n_items"), F.min("item_id").alias("item_id"), F.max("words").alias("words")), "matches")


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, contaminated, n_items (test items found), item_id (the least of theirs, null if none), matched_words (the most equal words of one of them)
    of each row of docs. Options: those of matches().

    Null texts have no words. A null item_id counts as -1; equal rows of the benchmark count once. Repeated rows are judged each, an empty table
    gives no rows, and an empty benchmark is found nowhere. Other columns are ignored, whatever their names.
    """
    need(docs, "doc_id", "text")
    need(benchmark, "item_id", "text")
    docs = numbered(docs.select("doc_id", "text"), "row")
    found = docs.select("row", "doc_id").join(matches(docs, benchmark, **options), "row", "left")
    return found.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", F.coalesce("words", F.lit(0)).alias("matched_words"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs in which no test item is found, with all their columns, whatever their names."""
    need(docs, "text")
    need(benchmark, "item_id", "text")
    row = free_name(docs, "_row")
    docs = numbered(docs, row)
    at = beside(matches(docs.select(F.col(row).alias("row"), "text"), benchmark, **options), "matches")
    names = [c for c in docs.columns if c != row]

    def keep(batches):
        lists = Beside(at)
        for b in batches:
            want = [lists.of(x) is None for x in b.column(b.schema.get_field_index(row)).to_pylist()]
            yield b.filter(pa.array(want, pa.bool_())).select(names)

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(lean(keep), T.StructType([f for f in docs.schema.fields if f.name != row]))
