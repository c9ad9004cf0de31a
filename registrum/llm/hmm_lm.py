"""A hidden Markov language model: Baum-Welch over all partitions, exact likelihood by the scaled forward recursion.

Observations are classes of words: each of the commonest words, and the end of a document, is a class of its own; the
other words are classed by their last three bytes. A word's probability is that of its class, from the
hidden states, times that of the word in its class, from the counts of the whole training fold with
one added. So the model has a bounded size while every word keeps its own count.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_crc, need, small_batches, word_count, words, written

COMMON, SUFFIXES, LOOKUP = 4096, 4096, 200_000
END = COMMON
CLASSES = COMMON + 1 + SUFFIXES
CELLS = 1 << 21


def suffix_class(word: bytes) -> int:
    return COMMON + 1 + zlib.crc32(word[-3:]) % SUFFIXES


def suffix_column(word: Column) -> Column:
    tail = F.when(F.length(word) > 3, F.substring(word, F.length(word) - 2, F.lit(3))).otherwise(word)
    return (F.crc32(tail) % SUFFIXES + COMMON + 1).cast("int")


@dataclass
class HMM:
    start: np.ndarray  # K
    move: np.ndarray  # K x K
    emit: np.ndarray  # CLASSES x K

    @property
    def states(self) -> int:
        return len(self.start)

    @staticmethod
    def from_counts(start: np.ndarray, move: np.ndarray, emit: np.ndarray, back: np.ndarray, prior: float = 50.0) -> HMM:
        """The states' distributions from expected counts, smoothed by the distribution back over classes."""
        k = len(start)
        e = emit + prior * back[:, None]
        m = move + 1.0 / k
        s = start + 1.0
        return HMM(s / s.sum(), m / m.sum(1, keepdims=True), e / e.sum(0))


def padded(docs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of similar length together: (places, classes by time and document, lengths, documents that reach each time)."""
    order = np.argsort([-len(d) for d in docs], kind="stable")
    k = 0
    while k < len(order):
        longest = len(docs[order[k]])
        n = min(len(order) - k, max(1, CELLS // max(1, longest)))
        part = order[k : k + n]
        lengths = np.array([len(docs[i]) for i in part])
        grid = np.zeros((longest, n), "i4")
        for j, i in enumerate(part):
            grid[: lengths[j], j] = docs[i]
        reach = np.searchsorted(-lengths, -np.arange(longest), "left")
        yield part, grid, lengths, reach
        k += n


def likelihood(m: HMM, docs: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each sequence of classes (one at least), summed over all paths of states."""
    out = np.zeros(len(docs))
    for part, grid, _, reach in padded(docs):
        total = np.zeros(len(part))
        a = m.start * m.emit[grid[0]]
        for t in range(len(grid)):
            n = reach[t]
            if t:
                a = (a[:n] @ m.move) * m.emit[grid[t, :n]]
            c = a.sum(1)
            a /= c[:, None]
            total[:n] += np.log10(c)
        out[part] = total
    return out


class Expected:
    """Expected counts of starts, moves and emissions under a model."""

    def __init__(self, m: HMM):
        self.m = m
        self.start, self.move, self.emit = np.zeros(m.states), np.zeros((m.states, m.states)), np.zeros((CLASSES, m.states))
        self.log10 = 0.0

    def add(self, docs: list[np.ndarray]) -> None:
        emit, move = self.m.emit.astype("f4"), self.m.move.astype("f4")
        first = self.m.start.astype("f4")
        for part, grid, lengths, reach in padded(docs):
            steps, n = grid.shape
            block = max(1, CELLS // n)

            def forward(lo: int, before, grid=grid, reach=reach, steps=steps, n=n, block=block):
                """Scaled forward variables and scales of a block of times, from the variables at the time before it."""
                hi = min(lo + block, steps)
                a, scale = np.zeros((hi - lo, n, self.m.states), "f4"), np.ones((hi - lo, n), "f4")
                for t in range(lo, hi):
                    r = reach[t]
                    x = (before[:r] @ move if t else first) * emit[grid[t, :r]]
                    scale[t - lo, :r] = c = x.sum(1)
                    a[t - lo, :r] = x / c[:, None]
                    before = a[t - lo]
                return a, scale

            # Of a text longer than a block the variables are kept at the blocks' ends only, and those in between are computed again.
            ends = [None]
            for lo in range(0, steps, block):
                a, scale = forward(lo, ends[-1])
                ends.append(a[-1].copy())
                self.log10 += float(np.log10(scale, dtype="f8").sum())
            b, after = np.ones((n, self.m.states), "f4"), None
            moves = np.zeros((self.m.states, self.m.states), "f4")
            total = np.zeros_like(self.move)
            for k, lo in reversed(list(enumerate(range(0, steps, block)))):
                if lo + block < steps:
                    a, scale = forward(lo, ends[k])
                for t in range(lo + len(a) - 1, lo - 1, -1):
                    if t + 1 < steps:
                        r = reach[t + 1]
                        eb = emit[grid[t + 1, :r]] * b[:r] / after[:r, None]
                        moves += a[t - lo, :r].T @ eb
                        b[:r] = eb @ move.T
                        a[t - lo, :r] *= b[:r]
                    after = scale[t - lo]
                    if t % 512 == 0:
                        total += moves
                        moves[:] = 0
                if not lo:
                    self.start += a[0].sum(0)
                at = np.arange(lo, lo + len(a))[:, None] < lengths
                seen = grid[lo : lo + len(a)][at]
                for j in range(self.m.states):
                    self.emit[:, j] += np.bincount(seen, a[:, :, j][at], CLASSES)
            self.move += (total + moves) * self.m.move


def first_model(docs: list[np.ndarray], back: np.ndarray, states: int, rounds: int, seed: int = 11) -> HMM:
    """A model from a few documents: each is drawn towards one state, then Baum-Welch."""
    r = np.random.default_rng(seed)
    emit = np.zeros((CLASSES, states))
    for d in docs:
        np.add.at(emit, (d[:, None], np.arange(states)[None, :]), r.dirichlet(np.full(states, 0.3)))
    m = HMM.from_counts(np.ones(states), np.eye(states) * 20 * max(1, len(docs)) + len(docs) / states, emit, back)
    for _ in range(rounds):
        e = Expected(m)
        e.add(docs)
        m = HMM.from_counts(e.start, e.move, e.emit, back)
    return m


def count_words(docs: DataFrame, most: int = 300_000) -> DataFrame:
    """word (binary), c: counts over all texts; each task adds up what it has and hands over at `most` distinct words."""

    def count(batches):
        def batch(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "c"])

        c: Counter = Counter()
        for b in batches:
            for text in b.column("text").to_pylist():
                c.update(words(text))
                if len(c) > most:
                    yield batch(c)
                    c = Counter()
        if c:
            yield batch(c)

    return docs.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """Of the commonest words: class and log10(c + 1); of each class: log10 of the size of its words, ones added."""

    words: list[bytes]
    classes: np.ndarray
    logs: np.ndarray
    within: np.ndarray

    def reader(self):
        places = {w: k for k, w in enumerate(self.words)}

        def read(text: str | None) -> tuple[np.ndarray, np.ndarray, Counter]:
            """The classes of a text with its end, the places of its known words, and its other words."""
            tokens = words(text)
            known = np.fromiter(map(places.get, tokens, repeat(-1)), "i4", len(tokens))
            out = np.empty(len(tokens) + 1, "i4")
            out[-1] = END
            out[:-1] = self.classes[known] if len(self.words) else 0
            other = np.flatnonzero(known < 0)
            rest = [tokens[i] for i in other]
            if rest:
                out[other] = [suffix_class(w) for w in rest]
            return out, known[known >= 0], Counter(rest)

        return read


def build_lexicon(counts: DataFrame, n_docs: int) -> tuple[Lexicon, np.ndarray, int, int]:
    """The lexicon, the distribution of classes, and the training tokens and distinct tokens with the end."""
    levels = [(r.c, r.n) for r in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(LOOKUP).collect()]
    least, n = None, 0
    for c, k in levels:  # whole levels of counts, LOOKUP words at most
        if n + k > LOOKUP:
            break
        least, n = c, n + k
    table = counts.filter(F.col("c") >= least).toArrow() if least is not None else None
    found = sorted(zip(table.column("word").to_pylist(), table.column("c").to_pylist(), strict=True), key=lambda x: (-x[1], x[0])) if table else []
    classes = np.array([k if k < COMMON else suffix_class(w) for k, (w, _) in enumerate(found)], "i4")
    size, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    total = vocabulary = 0
    for r in counts.groupBy(suffix_column(F.col("word")).alias("s")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        size[r.s], distinct[r.s] = r.c, r.n
        total, vocabulary = total + r.c, vocabulary + r.n
    for k, (w, c) in enumerate(found[:COMMON]):
        size[k] = c
        size[s := suffix_class(w)] -= c
        distinct[s] -= 1
    size[END] = n_docs
    within = np.log10(size + distinct + 1)
    within[: COMMON + 1] = 0.0  # a class of one word
    logs = np.log10(np.array([c for _, c in found], "f8") + 1)
    back = (size + 1) / (size + 1).sum()
    return Lexicon([w for w, _ in found], classes, logs, within), back, int(total + n_docs), int(vocabulary + (n_docs > 0))


def baum_welch(docs: DataFrame, m: HMM, lexicon, back: np.ndarray, buffer: int = 3_000_000) -> HMM:
    """One pass over all of docs: tasks add up expected counts, which are summed class by class, and give the next model."""
    spark, k = docs.sparkSession, m.states
    sent = spark.sparkContext.broadcast(m)
    names = [f"s{i}" for i in range(k)]

    def expect(batches):
        read, e = lexicon.value.reader(), Expected(sent.value)
        held: list[np.ndarray] = []
        for b in batches:
            held += [read(t)[0] for t in b.column("text").to_pylist()]
            if sum(map(len, held)) > buffer:
                e.add(held)
                held = []
        if held:
            e.add(held)
        used = np.flatnonzero(e.emit.any(1))
        rows = np.concatenate([e.start[None], e.move, e.emit[used]])
        at = np.concatenate([np.arange(-1 - k, 0), used])  # -1 - k: starts, then moves, then classes
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("i4")), *[pa.array(np.ascontiguousarray(rows[:, i])) for i in range(k)]], names=["at", *names])

    with small_batches(spark):
        summed = docs.select("text").mapInArrow(expect, "at int, " + ", ".join(f"{n} double" for n in names)).groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k))
    for at, *row in zip(*[summed.column(c).to_pylist() for c in ("at", *names)], strict=True):
        if at >= 0:
            emit[at] = row
        elif at == -1 - k:
            start[:] = row
        else:
            move[at + k] = row
    return HMM.from_counts(start, move, emit, back)


def seed_texts(fold: DataFrame, most: int, tokens: int) -> list[str]:
    """Whole texts of the rows of the least hashes, `most` at most, that fit into so many tokens together. Only their hashes and sizes are gathered
    before it is known which fit, so the driver never holds more."""
    sized = fold.select("text", F.xxhash64("doc_id", "text").alias("h"), (word_count(F.col("text")) + 1).alias("n"))
    room, chosen = tokens, set()
    for r in sized.select("h", "n").orderBy("h").limit(most).collect():
        if r.n <= room:
            room -= r.n
            chosen.add(r.h)
    if not chosen:
        return []
    found = sized.filter(F.col("h").isin(*chosen)).orderBy("h").limit(most).select("text", "n").collect()
    out: list[str] = []
    for r in found:
        tokens -= r.n
        if tokens < 0:  # rows that repeat a chosen one
            break
        out.append(r.text)
    return out


def score_documents(docs: DataFrame, *, folds: int = 7, held_out: int = 2, states: int = 8, passes: int = 2, seed_docs: int = 600, seed_tokens: int = 400_000, seed_rounds: int = 8) -> DataFrame:
    """Scores every row of docs with a model of the rows whose crc32(doc_id) mod folds is not held_out.

    Counts and `passes` rounds of Baum-Welch take all training rows. Only the model that the first round starts
    from comes from a bounded sample: of the seed_docs training rows of the least hashes, in that order, whole documents as long as they
    fit into seed_tokens tokens together, whatever their length. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    A null text is empty and has its end alone; a null id is hashed as an empty one; repeated rows are scored
    and learnt from each. Without training rows no token is known and the model knows uniform classes only.
    """
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    fold = docs.select("doc_id", "text").filter(id_crc(F.col("doc_id")) % folds != held_out)
    n_docs = fold.count()
    counts = written(count_words(fold), "words")
    lex, back, total, vocabulary = build_lexicon(counts, n_docs)
    lexicon = spark.sparkContext.broadcast(lex)

    m = first_model([lex.reader()(t)[0] for t in seed_texts(fold, seed_docs, seed_tokens)], back, states, seed_rounds)
    for _ in range(passes if n_docs else 0):
        m = baum_welch(fold, m, lexicon, back)

    model = spark.sparkContext.broadcast(m)
    unit = float(np.log10(total + vocabulary + 1))
    end_log, end_known = float(np.log10(n_docs + 1)), int(n_docs > 0)
    item = pa.struct([("w", pa.binary()), ("n", pa.int64())])
    schema = "row long, doc_id long, n_tokens long, n_known long, logs double, model double, rest array<struct<w: binary, n: long>>"

    def score(batches):
        lx, hmm = lexicon.value, model.value
        read = lx.reader()
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            got = likelihood(hmm, [h[2] for h in held])
            names = ["row", "doc_id", "n_tokens", "n_known", "logs", "model", "rest"]
            own = [[{"w": w, "n": n} for w, n in h[4].items()] for h in held]
            logs = [float(lx.logs[h[3]].sum()) + end_log for h in held]
            # Words in their classes: log10(c + 1) less the class's size; the other words' first part comes by the join.
            inner = [float(lx.logs[k := h[3]][lx.classes[k] > END].sum() - lx.within[h[2]].sum()) for h in held]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(item)]
            columns = [[h[0] for h in held], [h[1] for h in held], [len(h[2]) for h in held], [len(h[3]) + end_known for h in held], logs, [a + b for a, b in zip(got.tolist(), inner, strict=True)], own]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        size = 0
        for b in batches:
            for row, doc_id, text in zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                held.append((row, doc_id, *read(text)))
                size += len(held[-1][2])
                if size > 2_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    done = written(rows.mapInArrow(score, schema), "scores")
    rest = done.select("row", F.explode("rest").alias("r")).select("row", F.col("r.w").alias("word"), F.col("r.n").alias("n"))
    joined = rest.join(counts, "word", "left")
    more = joined.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("seen"))
    out = done.drop("rest").join(more, "row", "left")
    extra, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    return out.select(
        "doc_id",
        (id_crc(F.col("doc_id")) % folds == held_out).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + seen).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + extra - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("model") + extra).alias("score"),
    )
