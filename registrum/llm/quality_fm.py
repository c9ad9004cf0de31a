"""Quality scores from a factorisation machine over hashed words and the structure of a text."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, id_crc, lean, need, sliced, small_batches, words

BITS = 15
WORDS = 1 << BITS
#: Upper bounds of the bins of each measure of a text's structure; the order is that of structure().
EDGES = {
    "words": (1, 5, 10, 20, 50, 100, 300, 1000, 3000, 10000),
    "distinct": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "word_length": (1.5, 2, 3, 4, 5, 6, 7, 8, 10, 15),
    "upper": (0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.6, 0.8),
    "digits": (0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4),
    "marks": (0.001, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.5),
    "symbols": (0.0005, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4),
    "lines": (0.001, 0.003, 0.006, 0.01, 0.02, 0.05, 0.1, 0.2),
    "top_word": (0.01, 0.02, 0.04, 0.06, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8),
    "repeats": (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "beyond_ascii": (0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4),
}
BASES = np.cumsum([WORDS] + [len(e) + 1 for e in EDGES.values()])
SIZE = int(BASES[-1])
UPPER, DIGITS, MARKS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?'\"-()", b"#$%&*+/<=>@[\\]^_`{|}~"
HIGH = bytes(range(128, 256))


def structure(raw: bytes, tokens: list[bytes], counts: Counter) -> tuple[float, ...]:
    n, size = len(tokens), max(1, len(raw))

    def share(of: bytes) -> float:
        return 1 - len(raw.translate(None, of)) / size if raw else 0.0

    again = sum(map(bytes.__eq__, tokens, tokens[1:])) / max(1, n - 1)
    top = max(counts.values(), default=0) / max(1, n)
    return n, len(counts) / max(1, n), sum(map(len, tokens)) / max(1, n), share(UPPER), share(DIGITS), share(MARKS), share(SYMBOLS), raw.count(b"\n") / max(1, n), top, again, share(HIGH)


def extract(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features (places, values) of a whole text: hashed distinct words, together of length 1, and a bin of each measure, of 0.5 each.
    A null text is an empty one, which has its measures' lowest bins."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    tokens = words(text)
    counts = Counter(tokens)
    bins = [int(b) + int(np.searchsorted(e, x, "right")) for b, e, x in zip(BASES, EDGES.values(), structure(raw, tokens, counts), strict=False)]
    place = np.fromiter((zlib.crc32(w) & WORDS - 1 for w in counts), "i4", len(counts))
    value = np.full(len(place), 1 / np.sqrt(max(1, len(place))), "f4")
    return np.concatenate([place, np.array(bins, "i4")]), np.concatenate([value, np.full(len(bins), 0.5, "f4")])


class Machine:
    """w0 + sum w_i x_i + sum over i < j of <v_i, v_j> x_i x_j, the last as half of the squared sum less the sum of squares."""

    def __init__(self, rank: int = 8, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w0, self.w, self.v = 0.0, np.zeros(SIZE, "f4"), r.normal(0, 0.05, (SIZE, rank)).astype("f4")

    def raw(self, place: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores before the logistic function of rows whose features begin at starts; every row has some."""
        vx = self.v[place] * value[:, None]
        s = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * ((s**2).sum(1) - np.add.reduceat((vx**2).sum(1), starts))
        return self.w0 + np.add.reduceat(self.w[place] * value, starts) + pairs, vx, s

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        starts = np.cumsum([0] + [len(p) for p, _ in rows[:-1]])
        z = self.raw(np.concatenate([p for p, _ in rows]), np.concatenate([x for _, x in rows]), starts)[0]
        return 1 / (1 + np.exp(-np.clip(z.astype("f8"), -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = 8, batch: int = 128, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> Machine:
        """Adagrad over small batches; the order is fixed by the seed."""
        r = np.random.default_rng(seed)
        g0, gw, gv = 1e-6, np.full(SIZE, 1e-6, "f4"), np.full(self.v.shape, 1e-6, "f4")
        for _ in range(epochs):
            order = r.permutation(len(rows))
            for k in range(0, len(rows), batch):
                part = [rows[i] for i in order[k : k + batch]]
                y = labels[order[k : k + batch]]
                sizes = np.array([len(p) for p, _ in part])
                place, value = np.concatenate([p for p, _ in part]), np.concatenate([x for _, x in part])
                z, vx, s = self.raw(place, value, np.cumsum(sizes) - sizes)
                g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(part)).astype("f4")
                each = np.repeat(g, sizes) * value
                used, back = np.unique(place, return_inverse=True)
                dw = np.bincount(back, each, len(used)).astype("f4") + decay * self.w[used]
                inner = each[:, None] * (np.repeat(s, sizes, axis=0) - vx)
                dv = np.stack([np.bincount(back, inner[:, f], len(used)) for f in range(inner.shape[1])], 1).astype("f4") + decay * self.v[used]
                gw[used] += dw**2
                gv[used] += dv**2
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= 0.3 * rate * dv / np.sqrt(gv[used])
                d0 = float(g.sum())
                g0 += d0**2
                self.w0 -= rate * d0 / np.sqrt(g0)
        return self


def train(docs: DataFrame, labels: DataFrame, *, target: str = "quality", folds: int = 5, held_out: int = 0, max_rows: int = 8000, **options) -> Machine:
    """Fits a machine on the labelled documents whose crc32(doc_id) mod folds is not held_out.

    max_rows bounds the labelled documents, which a hash of their ids picks from all of them. Rows of labels with a
    null id or label are passed over; a repeated id counts once, with the mean of its labels and the least of its texts.
    Without any labelled document every score is that of an untrained machine, about a half.
    """
    need(labels, "doc_id", target)
    need(docs, "doc_id", "text")
    known = labels.select(F.col("doc_id").alias("_label_id"), F.col(target).cast("double").alias("_label")).filter(F.col("_label_id").isNotNull() & F.col("_label").isNotNull())
    known = known.filter(id_crc(F.col("_label_id")) % folds != held_out).groupBy("_label_id").agg(F.avg("_label").alias("_label"))
    # At most max_rows rows: small enough to broadcast.
    picked = F.broadcast(known.orderBy(F.xxhash64("_label_id"), "_label_id").limit(max_rows))
    joined = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_label_id"))
    joined = joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("_label").alias("label"))

    def features(batches):
        for b in batches:
            got = [extract(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("label"), pa.array([p.tobytes() for p, _ in got], pa.binary()), pa.array([x.tobytes() for _, x in got], pa.binary())], names=["doc_id", "label", "place", "value"])

    with small_batches(docs.sparkSession):
        found = sorted(joined.mapInArrow(lean(features), "doc_id long, label double, place binary, value binary").collect(), key=lambda r: r.doc_id)
    m = Machine()
    if found:
        m.fit([(np.frombuffer(r.place, "i4"), np.frombuffer(r.value, "f4")) for r in found], np.array([r.label for r in found], "f4"), **options)
    return m


def with_scores(docs: DataFrame, machine: Machine, column: str = "_quality") -> DataFrame:
    """docs with a double in column (0 to 1) added; one pass over the rows, with no shuffle."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast((machine.w0, machine.w, machine.v))
    if column in docs.columns:
        raise ValueError(f"docs has a column {column}")

    def score(batches):
        m = Machine()
        m.w0, m.w, m.v = model.value
        for b in sliced(batches):
            got = m.score([extract(t) for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], names=[*b.schema.names, column])

    from pyspark.sql import types as T

    return docs.mapInArrow(lean(score), T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs. Only the text of a document enters its score."""
    m = train(docs, labels)
    scored = with_scores(docs.select("doc_id", "text"), m)
    return scored.select("doc_id", (id_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), F.col("_quality").alias("score"), (F.col("_quality") >= threshold).cast("int").alias("predicted"))
