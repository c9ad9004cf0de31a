"""Removal of repeated substrings: suffix order of a collection, built column by column, decides what is repeated.

Inserting one symbol per document each round takes as many rounds as the longest document has bytes, so whole
documents are not inserted. They are cut into segments whose windows share a minimizer, which equal windows do in
equal places; segments of a minimizer that is found once hold nothing that repeats. Equal segments are counted
together, and the different segments of one minimizer are a collection of short strings: the collection
Burrows-Wheeler transform with its common prefixes is built for them in as many rounds as the longest has bytes
(twice the window at most), and runs of common prefixes of a window's length are the repeated windows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .collection_bwt import build
from .common import Beside, beside, bounded_batches, need, numbered, sliced, written
from .segments import Segmenter

GRAM = 32
LAST = (1 << 63) - 1
PART = 8 << 20
#: Strings of one group beyond which it is cut further, and the places of a minimizer in a window that then stay together.
HOT, STRIDE = 2048, 8


def parts_of(batches, columns: tuple[str, ...], window: int):
    """(values of columns by part, offsets of the parts in their documents, bytes end to end, ends): parts of documents of about 2 MB together.
    A document above PART bytes comes in parts that share window - 1 bytes, so each window is in one part."""
    values: list[tuple] = []
    offsets: list[int] = []
    held: list[bytes] = []
    size = 0
    for b in batches:
        for text, *rest in zip(b.column("text").to_pylist(), *[b.column(c).to_pylist() for c in columns], strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            for k in range(0, max(1, len(raw) - window + 1), PART):
                part = raw[k : k + PART + window - 1]
                values.append(tuple(rest))
                offsets.append(k)
                held.append(part)
                size += len(part)
                if size > 2 << 20:
                    yield values, np.array(offsets), b"".join(held), np.cumsum([len(x) for x in held])
                    values, offsets, held, size = [], [], [], 0
    if held:
        yield values, np.array(offsets), b"".join(held), np.cumsum([len(x) for x in held])


SEGMENT = "key long, print long, n int, d long, row long, a long, mini int, again boolean"


def segments(docs: DataFrame, window: int) -> DataFrame:
    """key (minimizer), print (of the segment's bytes), n (windows), d, row, a (first window), mini (the minimizer's distance from a) of each
    segment. again: an equal segment starts earlier in the same two megabytes of text, so a segment of countless copies has a row or so per
    task that is not marked."""

    def make(batches):
        cutter = Segmenter(window, GRAM)
        for values, offsets, data, ends in parts_of(sliced(batches), ("row", "d"), window):
            first, n, mini, h, prints = cutter(np.frombuffer(data, "u1"), ends)
            if not len(first):
                continue
            doc = np.searchsorted(ends, first, "right")
            shift = offsets[doc] - np.concatenate([[0], ends[:-1]])[doc]
            row, d = (np.array([v[k] for v in values], "i8") for k in (0, 1))
            rank = np.empty(len(row), "i8")
            rank[np.lexsort((offsets, row, d))] = np.arange(len(row))
            order = np.lexsort((first, rank[doc], prints))
            same = np.concatenate([[False], (prints[order][1:] == prints[order][:-1]) & (h[order][1:] == h[order][:-1]) & (n[order][1:] == n[order][:-1])])
            again = np.empty(len(first), bool)
            again[order] = same
            columns = (h.view("i8"), prints.view("i8"), n.astype("i4"), d[doc], row[doc], first + shift, (mini - first).astype("i4"), again)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "print", "n", "d", "row", "a", "mini", "again"])

    return docs.select("row", "d", "text").mapInArrow(make, SEGMENT)


def told_apart(found: DataFrame, window: int) -> DataFrame:
    """Of all segments, in one shuffle by key: copies (kind 0: spans s, e of segments that are found earlier) and strings to look into (kind 1: the
    first of each segment whose key has other segments; size: how many, as far as it tells whether they are above HOT).

    Rows of a key come sorted; a task holds the different segments of one key up to HOT of them. Marked rows need no look at their key and
    are dealt by their place."""
    schema = "kind int, key long, n int, row long, a long, mini int, size int, s long, e long"
    names = ("key", "print", "n", "d", "row", "a", "mini")

    def make(batches):
        carry, gone = {c: np.zeros(0, "i8") for c in names}, 0  # the open key's different segments, and how many of them were handed over

        def wanted(x: dict, size: np.ndarray) -> pa.RecordBatch:
            none = pa.nulls(len(size), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(size), "i4")), pa.array(x["key"]), pa.array(x["n"].astype("i4")), pa.array(x["row"]), pa.array(x["a"]), pa.array(x["mini"].astype("i4")), pa.array(np.minimum(size, HOT + 1).astype("i4")), none, none], names=["kind", "key", "n", "row", "a", "mini", "size", "s", "e"])

        def spans(row: np.ndarray, a: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            none, small = pa.nulls(len(row), pa.int64()), pa.nulls(len(row), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(row), "i4")), none, small, pa.array(row), none, small, small, pa.array(a), pa.array(a + n + window - 1)], names=["kind", "key", "n", "row", "a", "mini", "size", "s", "e"])

        for b in batches:
            again = b.column("again").to_numpy(zero_copy_only=False)
            x = {c: b.column(c).to_numpy().astype("i8") for c in names}
            if again.any():
                yield spans(x["row"][again], x["a"][again], x["n"][again])
                x = {c: v[~again] for c, v in x.items()}
            x = {c: np.concatenate([carry[c], x[c]]) for c in names}
            if not len(x["key"]):
                continue
            same = np.concatenate([[False], (x["key"][1:] == x["key"][:-1]) & (x["print"][1:] == x["print"][:-1]) & (x["n"][1:] == x["n"][:-1])])
            if same.any():
                yield spans(x["row"][same], x["a"][same], x["n"][same])
                x = {c: v[~same] for c, v in x.items()}
            starts = np.flatnonzero(np.concatenate([[True], x["key"][1:] != x["key"][:-1]]))
            counts = np.diff(np.append(starts, len(x["key"])))
            size = counts.copy()
            size[0] += gone
            last = starts[-1]
            each = np.repeat(size, counts)
            done = (each > 1) & (np.arange(len(each)) < last)
            if done.any():
                yield wanted({c: v[done] for c, v in x.items()}, each[done])
            gone = gone if len(starts) == 1 else 0
            carry = {c: v[last:] for c, v in x.items()}
            if len(carry["key"]) > HOT:
                yield wanted({c: v[:-1] for c, v in carry.items()}, np.full(len(carry["key"]) - 1, HOT + 1))
                gone += len(carry["key"]) - 1
                carry = {c: v[-1:] for c, v in carry.items()}
        if len(carry["key"]) + gone > 1:
            yield wanted(carry, np.full(len(carry["key"]), len(carry["key"]) + gone))

    dealt = found.repartition(F.when(F.col("again"), F.xxhash64("row", "a")).otherwise(F.col("key")))
    return written(dealt.sortWithinPartitions("key", "print", "n", "d", "row", "a").mapInArrow(make, schema), "segments")


def repeated_windows(strings: list[bytes], order: list[tuple[int, int, int]], window: int) -> list[list[int]]:
    """For each string the places of its windows that occur earlier in the order (d, row, a of each string's first byte)."""
    _, lcp, who, size = build(strings)
    run = np.cumsum((lcp < window) | (size < window))
    long = np.flatnonzero(size >= window)
    out: list[list[int]] = [[] for _ in strings]
    if not len(long):
        return out
    rank = np.empty(len(order), "i8")
    docs = sorted({o[:2] for o in order})
    place = {o: k for k, o in enumerate(docs)}
    rank = np.array([place[o[:2]] for o in order], "i8")
    begin = np.array([o[2] for o in order], "i8")
    lengths = np.array([len(s) for s in strings])
    owner, start = who[long], lengths[who[long]] - size[long]
    by = np.lexsort((begin[owner] + start, rank[owner], run[long]))
    runs = run[long][by]
    later = np.concatenate([[False], runs[1:] == runs[:-1]])
    for i, s in zip(owner[by][later].tolist(), start[by][later].tolist(), strict=True):
        out[i].append(s)
    return out


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of half-open spans; runs that touch are one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def partnered(strings: list[bytes], places: list[int], groups: list, window: int) -> list[int]:
    """Which strings may share a window with another of their group. All of a group's strings have the minimizer at the place given; a window has
    half of what it has besides on its left or on its right, so strings that share a window share the minimizer with that half."""
    half = -(-(window - GRAM) // 2)
    met: Counter = Counter()
    sides = []
    for s, m, g in zip(strings, places, groups, strict=True):
        pair = [(g, 0, s[m - half : m + GRAM])] if m >= half else []
        if len(s) >= m + GRAM + half:
            pair.append((g, 1, s[m : m + GRAM + half]))
        sides.append(pair)
        met.update(pair)
    return [k for k, pair in enumerate(sides) if any(met[x] > 1 for x in pair)]


def joined(s: np.ndarray, e: np.ndarray) -> list[tuple[int, int]]:
    """merged() of spans in arrays."""
    order = np.argsort(s, kind="stable")
    s, top = s[order], np.maximum.accumulate(e[order])
    new = np.flatnonzero(np.concatenate([[True], s[1:] > top[:-1]]))
    return list(zip(s[new].tolist(), top[np.append(new[1:], len(s)) - 1].tolist(), strict=True))


def collection_spans(strings: DataFrame, window: int, block: int = 1024) -> DataFrame:
    """row, s, e: spans covered by windows that occur earlier among the strings (key, part, common, d, row, a, mini, bytes) of one key, part and
    common. Tasks read sorted strings and build the transform of whole groups, together about `block` strings; no group has more than HOT."""

    def make(batches):
        held: list[tuple] = []

        def flush() -> pa.RecordBatch | None:
            kept = [held[k] for k in partnered([h[7] for h in held], [h[6] for h in held], [h[:3] for h in held], window)]
            rows, s, e = [], [], []
            if kept:
                for h, places in zip(kept, repeated_windows([h[7] for h in kept], [h[3:6] for h in kept], window), strict=True):
                    for x, y in merged([(p, p + window) for p in places]):
                        rows.append(h[4])
                        s.append(h[5] + x)
                        e.append(h[5] + y)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rows, s, e)], names=["row", "s", "e"]) if rows else None

        for b in batches:
            for r in zip(*[b.column(c).to_pylist() for c in ("key", "part", "common", "d", "row", "a", "mini", "bytes")], strict=True):
                if len(held) >= block and held[-1][:3] != r[:3]:
                    if (out := flush()) is not None:
                        yield out
                    held = []
                held.append(r)
        if held and (out := flush()) is not None:
            yield out

    return strings.repartition("key", "part", "common").sortWithinPartitions("key", "part", "common").mapInArrow(make, "row long, s long, e long")


def collapse(found: DataFrame, same: list[str], window: int) -> tuple[DataFrame, DataFrame]:
    """Of strings that agree in `same`: (the first of each with its count c, spans of all others). found has d, row, a, n (windows)."""
    first = written(found.groupBy(*same).agg(F.min(F.struct("d", "row", "a")).alias("first"), F.count("*").alias("c")), "firsts")
    others = found.join(first.filter("c > 1").select(*same, "first"), same).filter((F.col("row") != F.col("first.row")) | (F.col("a") != F.col("first.a")))
    return first, others.select("row", F.col("a").alias("s"), (F.col("a") + F.col("n") + window - 1).alias("e"))


def bytes_of(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The strings of segments (key, n, row, a, mini, size), read from the texts, which stay where they are: the segments are put beside them.

    Segments of a key with more than HOT of them are cut: windows with the minimizer in STRIDE neighbouring places stay together, with the
    bytes that all of them contain as a further key, so only strings that are nearly equal stay in one group."""
    at = beside(wanted.select("row", "key", "n", "a", "mini", "size"), "wanted")
    schema = "key long, part int, common long, d long, row long, a long, n int, mini int, bytes binary"

    def make(batches):
        import xxhash

        lists = Beside(at)
        for b in sliced(batches):
            out: list[tuple] = []
            for row, d, text in zip(b.column("row").to_pylist(), b.column("d").to_pylist(), b.column("text").to_pylist(), strict=True):
                of = lists.of(row)
                if of is None:
                    continue
                raw = (text or "").encode("utf-8", "surrogatepass")
                for key, n, a, mini, size in zip(*[of[c].tolist() for c in ("key", "n", "a", "mini", "size")], strict=True):
                    if size <= HOT:
                        out.append((key, -1, 0, d, row, a, n, mini, raw[a : a + n + window - 1]))
                        continue
                    p = a + mini
                    for part in range((p - a - n + 1) // STRIDE, mini // STRIDE + 1):
                        lo, hi = max(a, p - part * STRIDE - STRIDE + 1), min(a + n - 1, p - part * STRIDE)
                        common = xxhash.xxh3_64_intdigest(raw[p - part * STRIDE : p - part * STRIDE - STRIDE + 1 + window])
                        out.append((key, part, common - (1 << 63), d, row, lo, hi - lo + 1, p - lo, raw[lo : hi + window]))
                if len(out) > 20_000:
                    yield strings(out)
                    out = []
            if out:
                yield strings(out)

    def strings(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=["key", "part", "common", "d", "row", "a", "n", "mini", "bytes"])

    return written(docs.select("row", "d", "text").mapInArrow(make, schema), "strings", "lz4")


def repeated_spans(docs: DataFrame, window: int = 100) -> DataFrame:
    """row, s, e: half-open spans of bytes whose union is what windows cover that start earlier too. docs: row, d, text."""
    found = told_apart(segments(docs, window), window)
    copies = found.filter("kind = 0").select("row", "s", "e")
    strings = bytes_of(docs, found.filter("kind = 1"), window)
    keys, columns = ["key", "part", "common"], ["key", "part", "common", "d", "row", "a", "mini", "bytes"]
    cool = strings.filter("part < 0").select(*columns)
    pieces = strings.filter("part >= 0")
    if pieces.isEmpty():
        return copies.unionByName(collection_spans(cool, window))
    pieces = pieces.withColumn("print", F.sha2("bytes", 256))
    kept, more = collapse(pieces.drop("bytes"), [*keys, "print", "n"], window)
    groups = kept.groupBy(*keys).agg(F.count("*").alias("c")).filter("c > 1")
    single = kept.join(groups.withColumnRenamed("c", "size"), keys).select(*keys, "size", F.col("first.row").alias("row"), F.col("first.a").alias("a"))
    hot = written(single.join(pieces, [*keys, "row", "a"]), "pieces", "lz4")
    # What is still too many is decided window by window, as strings that are equal or not.
    each = hot.filter(F.col("size") > HOT).select("d", "row", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"), "a", "bytes")
    each = each.select("d", "row", (F.col("a") + F.col("k")).alias("a"), F.lit(1).alias("n"), F.sha2(F.substring("bytes", F.col("k") + 1, F.lit(window)), 256).alias("print"))
    _, rest = collapse(each, ["print"], window)
    small = hot.filter(F.col("size") <= HOT).select(*columns)
    return copies.unionByName(more).unionByName(rest).unionByName(collection_spans(cool.unionByName(small), window))


def dedup(docs: DataFrame, window: int = 100) -> DataFrame:
    """row, doc_id, spans (maximal removed runs of bytes: array of s, e) and kept (the bytes that are left) of each row of docs.

    A byte goes if a window of `window` bytes covers it that also starts earlier: in a row of a smaller doc_id, or earlier in the row; rows
    of one id stand in the order of the table, and rows with a null id behind all others. Windows are judged on the input. A text
    that is null or shorter than a window keeps its bytes. Texts are read three times and never shuffled; a table that is not read straight from
    files is written first, so that its rows keep their numbers. An empty table gives no rows; other columns are ignored.
    """
    need(docs, "doc_id", "text")
    docs = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "row").withColumn("d", F.coalesce("doc_id", F.lit(LAST)))
    at = beside(repeated_spans(docs, window), "spans")
    kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def make(batches):
        lists = Beside(at)
        for b in sliced(batches):
            runs, kept = [], []
            for row, text in zip(b.column("row").to_pylist(), b.column("text").to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                of = lists.of(row)
                gone = joined(of["s"], of["e"]) if of is not None else []
                last, rest = 0, []
                for s, e in gone:
                    rest.append(raw[last:s])
                    last = e
                runs.append([{"s": s, "e": e} for s, e in gone])
                kept.append(b"".join([*rest, raw[last:]]))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(runs, kind), pa.array(kept, pa.binary())], names=["row", "doc_id", "spans", "kept"])

    schema = "row long, doc_id long, spans array<struct<s: long, e: long>>, kept binary"
    bounded_batches(docs.sparkSession)
    return docs.select("row", "doc_id", "text").mapInArrow(make, schema)


def digest(deduped: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of what dedup() returns."""
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["e"] - x["s"]), F.lit(0))
    return deduped.select("doc_id", (F.length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
