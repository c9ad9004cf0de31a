"""Near-duplicate documents by MinHash with tensored banding, every link confirmed on whole shingle sets.

Table keys are pairs of members of two small collections of hashes: SIDE left and SIDE right groups of
ROWS minhashes each give SIDE * SIDE keys of 2 * ROWS minhashes from 2 * SIDE * ROWS of them. Two sets of
similarity s share a key unless all left or all right groups differ, which has a probability below
2 * (1 - s ** ROWS) ** SIDE: 2e-4 at 0.8, 8e-6 at 0.85, 1e-7 at 0.9.

Documents with one shingle set are one node. In each bucket the nodes are first compared with one of
them, the hub, so a bucket of n nodes gives n pairs. Where a pair fails, all nodes of the components of its two nodes
are then compared exactly with all bucketed nodes of other components, by a prefix filter: in the order of rising counts,
the first shingles of two similar sets must meet. Two nodes that share a bucket are joined by a path over hubs; if it does
not make them one component, a pair on it failed in the component of each. So no link is lost between nodes that
share a bucket, and no pairs within a component are formed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Beside, beside, components, cut, free_name, from_files, lean, need, numbered, sliced, small_batches, words, written

SIDE, ROWS = 13, 3
CELLS = 1 << 20
PARITY = 2048
_random = np.random.default_rng(6)
FACTORS = _random.integers(1, 1 << 63, 2 * SIDE * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(1, 1 << 63, 2 * SIDE * ROWS, dtype=np.uint64)
MIX = _random.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = (np.arange(SIDE)[:, None] * SIDE + np.arange(SIDE)).astype("u8")


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles; a text of fewer words is one shingle; none without words."""

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        tokens, known = words(text), self.known
        if len(known) > 100_000:
            known.clear()
        try:
            h = np.fromiter(map(known.__getitem__, tokens), "u8", len(tokens))
        except KeyError:
            for w in set(tokens).difference(known):
                known[w] = xxhash.xxh64_intdigest(w)
            h = np.fromiter(map(known.__getitem__, tokens), "u8", len(tokens))
        n = min(self.size, len(h))
        if not n:
            return h
        out = np.full(len(h) - n + 1, n, "u8")
        for k in range(n):
            out = (out ^ h[k : len(h) - n + 1 + k]) * MIX[0]
            out ^= out >> np.uint64(29)
        return np.unique(out)


def sketch(s: np.ndarray) -> np.ndarray:
    """The 2 * SIDE group hashes of a set that is not empty."""
    least = None
    for k in range(0, len(s), 4096):
        m = s[k : k + 4096, None] * FACTORS + SHIFTS
        m = ((m ^ (m >> np.uint64(31))) * MIX[1]).min(0)
        least = m if least is None else np.minimum(least, m)
    groups = least.reshape(2 * SIDE, ROWS)
    out = np.zeros(2 * SIDE, "u8")
    for k in range(ROWS):
        out = (out ^ groups[:, k]) * MIX[2]
        out ^= out >> np.uint64(30)
    return out


def table_keys(sketches: np.ndarray) -> np.ndarray:
    """Keys of nodes (rows): each left group with each right group."""
    left, right = sketches[:, :SIDE, None], sketches[:, None, SIDE:]
    k = (left * MIX[3] ^ right * MIX[4]) + PLACE * MIX[5]
    return (k ^ (k >> np.uint64(32))).reshape(len(sketches), -1)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def parity(s: np.ndarray) -> bytes:
    """The set's size, and for each of PARITY places whether an odd number of shingles falls there."""
    odd = np.bincount((s >> np.uint64(20)).astype("i8") & PARITY - 1, minlength=PARITY) & 1
    return len(s).to_bytes(8, "little") + np.packbits(odd.astype(bool)).tobytes()


def may_be_similar(a: bytes, b: bytes, percent: int) -> bool:
    """False only for sets that are not similar: places of different parity are as many as unshared shingles at most."""
    n = int.from_bytes(a[:8], "little") + int.from_bytes(b[:8], "little")
    apart = (int.from_bytes(a[8:], "big") ^ int.from_bytes(b[8:], "big")).bit_count()
    return apart * (100 + percent) <= n * (100 - percent)


def sets_similar(a: bytes, b: bytes, percent: int) -> bool:
    return similar(np.frombuffer(a, "u8"), np.frombuffer(b, "u8"), percent)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, np.ndarray) else v for v in columns.values()], names=list(columns))


def sketched(docs: DataFrame, shingle: int) -> DataFrame:
    """row, doc_id, n, print (of the set; null without words), sketch of each row."""

    def make(batches):
        shingles = Shingler(shingle)
        for b in batches:
            sets = [shingles(t) for t in b.column("text").to_pylist()]
            prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary())], names=["row", "doc_id", "n", "print", "sketch"])

    return docs.select("row", "doc_id", "text").mapInArrow(lean(make), "row long, doc_id long, n long, print binary, sketch binary")


def star_pairs(nodes: DataFrame, held: int = 2048) -> DataFrame:
    """x, h: each node with the hub of each of its buckets. A task first joins its own nodes to a hub of the task and hands over the
    hubs only, so a bucket that holds much of the table has a row per task and the rest is streamed from sorted rows."""

    def combined(want: str):
        def make(batches):
            ids: list[np.ndarray] = []
            rows: list[np.ndarray] = []

            def flush():
                node = np.concatenate(ids)
                keys = table_keys(np.frombuffer(b"".join(rows), "u8").reshape(len(node), -1))
                order = np.argsort(node, kind="stable")
                node, keys = node[order], keys[order]
                flat, who = keys.ravel(), np.repeat(node, keys.shape[1])
                order = np.argsort(flat, kind="stable")
                flat, who = flat[order], who[order]
                new = np.concatenate([[True], flat[1:] != flat[:-1]])
                if want == "keys":
                    return flat[new].view("i8"), who[new]
                hub = who[np.flatnonzero(new)][np.cumsum(new) - 1]
                pairs = np.unique(np.stack([who, hub], 1)[who != hub], axis=0)
                return pairs[:, 0], pairs[:, 1]

            names = ("key", "node") if want == "keys" else ("x", "h")
            for b in batches:
                ids.append(b.column("node").to_numpy(zero_copy_only=False))
                rows += b.column("sketch").to_pylist()
                if len(rows) >= held:
                    yield _batch(dict(zip(names, flush(), strict=True)))
                    ids, rows = [], []
            if rows:
                yield _batch(dict(zip(names, flush(), strict=True)))

        return make

    def stream(batches):
        last, hub = None, None
        for b in batches:
            if not b.num_rows:
                continue
            key, node = b.column("key").to_numpy(), b.column("node").to_numpy()
            new = np.concatenate([[last is None or key[0] != last], key[1:] != key[:-1]])
            first = np.where(new, node, -1)
            if not new[0]:
                first[0] = hub
            at = np.maximum.accumulate(np.where(first >= 0, np.arange(len(node)), 0))
            hubs = first[at]
            last, hub = key[-1], hubs[-1]
            off = node != hubs
            if off.any():
                pairs = np.unique(np.stack([node[off], hubs[off]], 1), axis=0)
                yield _batch({"x": pairs[:, 0], "h": pairs[:, 1]})

    own = nodes.select("node", "sketch").mapInArrow(lean(combined("pairs")), "x long, h long")
    keys = nodes.select("node", "sketch").mapInArrow(lean(combined("keys")), "key long, node long")
    across = keys.repartition("key").sortWithinPartitions("key", "node").mapInArrow(lean(stream), "x long, h long")
    return own.unionByName(across).distinct()


def sets_of(docs: DataFrame, rows: DataFrame, shingle: int) -> DataFrame:
    """node, set (sorted 64-bit hashes), parity of rows (node, row), which are put beside the texts, so that no text is shuffled and no other
    row's set is made again."""
    at = beside(rows.select("row", "node"), "rows")

    def make(batches):
        shingles, lists = Shingler(shingle), Beside(at)
        for b in sliced(batches):
            nodes = [None if (of := lists.of(row)) is None else int(of["node"][0]) for row in b.column("row").to_pylist()]
            wanted = [k for k, node in enumerate(nodes) if node is not None]
            if wanted:
                found = [shingles(t) for t in b.column("text").take(pa.array(wanted)).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([nodes[k] for k in wanted], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary()), pa.array([parity(s) for s in found], pa.binary())], names=["node", "set", "parity"])

    return docs.select("row", "text").mapInArrow(lean(make), "node long, set binary, parity binary")


def compared(pairs: DataFrame, items: DataFrame, column: str, test, percent: int, most: int = 1024) -> DataFrame:
    """x, h, linked: the test on the column of both nodes of each pair. A hub with many pairs is dealt to several tasks, each with what the
    hub has; a task holds two nodes' values at a time."""
    hubs = pairs.groupBy("h").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    dealt = pairs.join(hubs, "h").select("h", "x", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int").alias("part"))
    values = items.select("node", F.col(column).alias("value"))
    members = dealt.join(values.withColumnRenamed("node", "x"), "x").select("h", "part", F.lit(1).alias("role"), F.col("x").alias("id"), "value")
    heads = hubs.select("h", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(values.withColumnRenamed("node", "h"), "h").select("h", "part", F.lit(0).alias("role"), F.col("h").alias("id"), "value")

    def compare(batches):
        hub, own = None, None
        for b in batches:
            xs, hs, ok = [], [], []
            for h, role, ident, value in zip(*[b.column(c).to_pylist() for c in ("h", "role", "id", "value")], strict=True):
                if not role:
                    hub, own = h, value
                elif h == hub:
                    xs.append(ident)
                    hs.append(h)
                    ok.append(test(own, value, percent))
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(hs, pa.int64()), pa.array(ok, pa.bool_())], names=["x", "h", "linked"])

    return members.unionByName(heads).repartition("h", "part").sortWithinPartitions("h", "part", "role").mapInArrow(lean(compare), "x long, h long, linked boolean")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """x, h, linked: each pair compared on its whole sets, but for those that their parities rule out."""
    first = cut(compared(pairs, sets, "parity", may_be_similar, percent))
    return first.filter("not linked").unionByName(compared(first.filter("linked").drop("linked"), sets, "set", sets_similar, percent))


def counts_of(sets: DataFrame) -> np.ndarray:
    """Counts of the shingles in all sets in a table of a fixed number of cells, by the shingles' low bits."""
    chunk = 1 << 14

    def count(batches):
        total = np.zeros(CELLS, "i8")
        for b in batches:
            for s in b.column("set").to_pylist():
                np.add.at(total, np.frombuffer(s, "u8") & np.uint64(CELLS - 1), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(CELLS // chunk), pa.int32()), pa.array([total[k : k + chunk].tobytes() for k in range(0, CELLS, chunk)], pa.binary())], names=["k", "part"])

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, part in zip(b.column("k").to_pylist(), b.column("part").to_pylist(), strict=True):
                x = np.frombuffer(part, "i8")
                held[k] = held[k] + x if k in held else x
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["k", "part"])

    out = np.zeros(CELLS, "i8")
    with small_batches(sets.sparkSession):
        found = sets.select("set").mapInArrow(lean(count), "k int, part binary").repartition("k").mapInArrow(lean(add), "k int, part binary").collect()
    for r in found:
        out[r.k * chunk : (r.k + 1) * chunk] += np.frombuffer(r.part, "i8")
    return out


def rest_pairs(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, h) of nodes of different components that may be similar, the component of one of them at least failed against a hub.

    groups: node, component, failed. With t = percent / 100, a set of n shingles shows its first n - ceil(t n) + 1 to smaller sets and its
    first n - ceil(2 t n / (1 + t)) + 1 to larger ones; a pair also needs enough shingles after the one it meets at.
    """
    counts = sets.sparkSession.sparkContext.broadcast(counts_of(sets))

    def prefixes(batches):
        for b in batches:
            parts = []
            for node, data in zip(b.column("node").to_pylist(), b.column("set").to_pylist(), strict=True):
                s = np.frombuffer(data, "u8")
                n = len(s)
                order = np.lexsort((s, counts.value[s & np.uint64(CELLS - 1)]))
                large = n - -(-percent * n // 100) + 1
                small = n - -(-2 * percent * n // (100 + percent)) + 1
                first = s[order[:large]].view("i8")
                parts.append((first, np.full(len(first), node), np.full(len(first), n), np.arange(len(first)), np.arange(len(first)) < small))
            if parts:
                yield _batch(dict(zip(("shingle", "node", "n", "at", "small"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    rows = sets.select("node", "set").mapInArrow(lean(prefixes), "shingle long, node long, n long, at long, small boolean").join(groups, "node")
    rows = written(rows, "prefixes", "lz4")
    # Shingles at which a failed component meets another one; sums by task come before the shuffle, however common a shingle is.
    meeting = rows.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("failed").alias("any")).filter("low <> high and any")
    rows = rows.join(meeting.select("shingle"), "shingle", "left_semi")
    a, b = rows.filter("small").alias("a"), rows.alias("b")
    least = F.ceil(F.lit(percent) * (F.col("a.n") + F.col("b.n")) / F.lit(100 + percent))
    after = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    meet = (
        (F.col("a.shingle") == F.col("b.shingle"))
        & (F.col("a.component") != F.col("b.component"))
        & (F.col("a.failed") | F.col("b.failed"))
        & ((F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.node") < F.col("b.node"))))
        & (100 * F.col("a.n") >= percent * F.col("b.n"))
        & (after >= least)  # holds at the first shingle that a similar pair shares
    )
    return a.join(b, meet).select(F.col("a.node").alias("x"), F.col("b.node").alias("h")).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """row, doc_id, n_shingles, component_id and kept of each row of docs.

    Rows are linked whose sets of distinct shingles of `shingle` words have 100 * shared >= percent * all.
    component_id is the least doc_id that links reach. A row without words has no shingles and
    is linked with nothing. A null doc_id is never the least unless its component has no other; repeated rows fall into one
    component. A table that is not read straight from files is written first, so that its rows keep their numbers. An
    empty table gives no rows; other columns are ignored.
    """
    need(docs, "doc_id", "text")
    docs = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "row")
    every = written(sketched(docs, shingle), "sketches")
    nodes = every.filter("n > 0").groupBy("print").agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.min("n").alias("n"), F.min_by("sketch", "row").alias("sketch"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    pairs = cut(star_pairs(nodes))
    seen = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("h").alias("node"))).distinct()
    sets = written(sets_of(docs, seen.join(nodes.select("node", "row"), "node"), shingle), "sets", "lz4")
    tried = cut(confirmed(pairs, sets, percent))
    links = tried.filter("linked").select(F.col("x").alias("u"), F.col("h").alias("v"))
    first = components(links)
    lost = tried.filter("not linked").select(F.explode(F.array("x", "h")).alias("node")).distinct().withColumn("failed", F.lit(True))
    groups = cut(seen.join(first, "node", "left").select("node", F.coalesce("component", "node").alias("component")))
    lost = groups.join(lost, "node").select("component", "failed").distinct()
    groups = groups.join(lost, "component", "left").select("node", "component", F.coalesce("failed", F.lit(False)).alias("failed"))
    more = confirmed(cut(rest_pairs(sets, groups, percent)), sets, percent).filter("linked").select(F.col("x").alias("u"), F.col("h").alias("v"))
    final = components(links.unionByName(more))

    least = final.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    reached = final.join(least, "component").select("node", "component_id")
    by_print = nodes.select("print", "node", "least").join(reached, "node", "left").select("print", F.coalesce("component_id", "least").alias("component_id"))
    out = every.select("row", "doc_id", F.col("n").alias("n_shingles"), "print").join(by_print, "print", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("row", "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs without all but one of each component: that with the least doc_id, and of rows that repeat it the first."""
    if not from_files(docs):
        docs = written(docs, "rows")
    kept = near_duplicates(docs, **options).filter("kept")
    whole = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(-1 - F.col("row"))
    row, wanted = free_name(docs, "_row"), free_name(docs, "_kept_row")
    kept = kept.groupBy(whole.alias("k")).agg(F.min("row").alias(wanted))
    rows = docs.select("*", F.monotonically_increasing_id().alias(row))
    return rows.join(kept.select(wanted), F.col(row) == F.col(wanted), "left_semi").select(*docs.columns)
