"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, free_name, need, word_count

#: Tables with a row per source are broadcast up to so many sources; beyond, Spark joins them as it joins any table.
SOURCES = 100_000
#: Rows of a source that are put in order in one task, and the parts into which the place of a target's end is looked for until no more are left.
HELD, PARTS = 4096, 64

#: Steps of the uniform number, which has 48 bits.
STEPS = float(1 << 48)

Odds = Callable[[Column], Column]


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) that the seed and the id fix; rows of one id share it."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long").cast("double") + 0.5) / STEPS


def by_length(size: Column) -> Column:
    """Odds that prefer long documents: 3 from 1000 words on, 2 from 100 on, else 1."""
    return F.when(size >= 1000, 3).when(size >= 100, 2).otherwise(1)


def allocate(totals: DataFrame, weights: tuple[int, ...], share: tuple[int, int], copies: int) -> DataFrame:
    """Targets by source. totals: source, source_size (one row per source).

    Sources are ordered by code point, null last, and take the weights in turn. The share of all
    sizes is split by weight; no target is above copies times its source's size, and what is cut is
    split again among the rest. This level filling is solved at once: with sources in
    the order of the level that fills them, the first k are full for the least k at which
    the level of the rest does not fill another.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * copies)
    level = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    rest = level.rowsBetween(W.currentRow, W.unboundedFollowing)
    t = t.withColumn("whole", F.sum("source_size").over(W.partitionBy(F.lit(0)))).withColumn("full_before", F.coalesce(F.sum("cap").over(level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    t = t.withColumn("open_weight", F.sum("weight").over(rest)).withColumn("left", F.col("whole") * (share[0] / share[1]) - F.col("full_before"))
    holds = F.col("left") / F.col("open_weight") <= F.col("cap") / F.col("weight")
    t = t.withColumn("fill", F.min(F.when(holds, F.struct("full_before", "open_weight", "left"))).over(W.partitionBy(F.lit(0))))
    filled = F.col("weight") * F.col("fill.left") / F.col("fill.open_weight")
    return t.select("source", "source_size", F.least(F.coalesce(filled, F.col("cap").cast("double")), F.col("cap").cast("double")).alias("target"))


def ranked(m: Column, u: Column, level: Column, copies: int) -> tuple[Column, Column, Column]:
    """(certain copies, inclusion probability of one more, ranking variable) of a document of odds m."""
    expected = F.least(F.lit(float(copies)), m * level)
    whole = F.floor(expected).cast("long")
    pi = expected - whole
    return whole, pi, F.when(pi > 0, u / (1 - u) / (pi / (1 - pi)))


def taken(plan: Callable[[str], Column], doc_id: Column, size: Column, whole: Column, pi: Column, score: Column) -> Column:
    """Words that the mix takes of a document, by the row of its source in the plan."""
    budget, last_score, last_id = plan("budget"), plan("last_score"), plan("last_id")
    later_id = F.when(last_id.isNull(), F.lit(False)).otherwise(doc_id.isNull() | (doc_id > last_id))
    more = (
        F.when((pi <= 0) | (budget <= 0), 0)
        .when(last_score.isNull() | (score < last_score), size)
        .when(score > last_score, 0)
        .when(doc_id.eqNullSafe(last_id), F.least(plan("last_words"), size))
        .when(later_id, 0)
        .otherwise(size)
    )
    return (whole * size + more).cast("long")


class Mix:
    """What a mix takes of each document: a plan with a row per source, after which each row is decided on its own."""

    def __init__(self, docs: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), copies: int = 2, seed: str = "mix", weight_col: str | None = None, odds: Odds | None = None):
        need(docs, "doc_id", "text", "source")
        self.copies, self.seed, self.weight_col, self.odds = copies, seed, weight_col, odds
        ident, source, size, m, u = self.measures(docs)
        self.rows = cut(docs.select(ident.alias("doc_id"), source.alias("source"), size.alias("size"), m.alias("m"), u.alias("u")))
        totals = self.rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("m")).alias("weighed"))
        targets = allocate(totals.select("source", "source_size"), weights, share, copies)
        level = F.when(F.col("weighed") > 0, F.col("target") / F.col("weighed")).otherwise(0.0)
        plan = targets.join(totals.select(F.col("source").alias("s"), "weighed"), F.col("source").eqNullSafe(F.col("s")))
        self.plan = cut(plan.select("source", "source_size", "target", level.alias("level"), F.lit(None).cast("double").alias("capped")))
        self.few = self.plan.count() <= SOURCES
        if weight_col or odds:
            self._levels()
        self._budgets()

    def measures(self, docs: DataFrame) -> tuple[Column, Column, Column, Column, Column]:
        """doc_id, source, size, odds and uniform number of a row of docs."""
        size = word_count(docs["text"])
        m = F.lit(1)
        if self.weight_col:
            m = F.greatest(F.coalesce(docs[self.weight_col].cast("double"), F.lit(1.0)), F.lit(0.0))
        elif self.odds:
            m = self.odds(size)
        return docs["doc_id"], docs["source"], size, m, uniform(docs["doc_id"], self.seed)

    def joined(self, rows: DataFrame, plan: DataFrame) -> DataFrame:
        """rows with the columns of plan, which has a row per source."""
        plan = plan.withColumnRenamed("source", "s")
        return rows.join(F.broadcast(plan) if self.few else plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def _levels(self) -> None:
        """Raises a source's level where documents of high odds reach the most copies, so that the others make up for them. Each round
        settles at least one more value of the odds."""
        full = F.col("m") * F.col("level") >= self.copies
        while True:
            now = self.joined(self.rows, self.plan.select("source", "level")).groupBy("source").agg(F.sum(F.when(full, F.col("size")).otherwise(0)).cast("double").alias("now_capped"), F.sum(F.when(full, 0).otherwise(F.col("size") * F.col("m"))).alias("open"))
            level = F.when(F.col("open") > 0, (F.col("target") - self.copies * F.col("now_capped")) / F.col("open")).otherwise(F.col("level"))
            new = cut(self.joined(self.plan, now).select("source", "source_size", "target", level.alias("level"), F.col("now_capped").alias("capped"), (~F.col("capped").eqNullSafe(F.col("now_capped"))).alias("moved")))
            self.plan = new.drop("moved")
            if new.filter("moved").isEmpty():
                return

    def _budgets(self) -> None:
        """Finds where each source's target fills up: bucket by bucket of the ranking variable, and again within the bucket in which it does until
        that has few rows, which are put in order. So no source is sorted in one task, however many documents it has."""
        whole, pi, score = ranked(F.col("m"), F.col("u"), F.col("level"), self.copies)
        part = F.col("level") - F.floor("level")
        # About uniform in (0, 1) within a source: the score times the odds at the source's level gives back the uniform number's.
        even = F.col("score") * F.when(part > 0, part / (1 - part)).otherwise(1.0)
        r = self.joined(self.rows, self.plan.select("source", "level")).withColumns({"whole": whole, "pi": pi, "score": score})
        r = r.withColumn("v", F.least(F.nanvl(even / (1 + even), F.lit(1.0)), F.lit(1 - 1e-15))).drop("level")
        certain = r.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("certain"))
        budget = F.floor("target") - F.col("certain")
        self.plan = cut(self.joined(self.plan.drop("capped"), certain).withColumn("budget", budget).drop("certain"))
        slim = r.filter("pi > 0").select("source", "doc_id", "size", "score", "v")
        edge = self.plan.select("source", F.lit(0.0).alias("low"), F.lit(1.0).alias("high"), F.col("budget").alias("left"))
        while True:
            inside = self.joined(slim, edge).filter("v >= low and v < high")
            k = F.least(F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * PARTS), F.lit(PARTS - 1)).cast("int")
            sums = inside.groupBy("source", "low", "high", "left", k.alias("k")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
            before = F.coalesce(F.sum("words").over(W.partitionBy("source").orderBy("k").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
            step = (F.col("high") - F.col("low")) / PARTS
            found = sums.withColumn("before", before).filter("before < left and before + words >= left")
            edge = cut(found.select("source", (F.col("low") + F.col("k") * step).alias("low"), F.when(F.col("k") == PARTS - 1, F.col("high")).otherwise(F.col("low") + (F.col("k") + 1) * step).alias("high"), (F.col("left") - F.col("before")).alias("left"), "n"))
            most = edge.agg(F.max("n"), F.min(F.col("high") - F.col("low"))).first()
            edge = edge.drop("n")
            if not most[0] or most[0] <= HELD or most[1] < 1e-12:
                break
        near = self.joined(slim, edge).filter("v >= low and v < high")
        near = near.groupBy("source", "left", "score", "doc_id").agg(F.sum("size").alias("words"), F.count("*").alias("same"))
        run = W.partitionBy("source").orderBy("score", F.col("doc_id").isNull(), "doc_id")
        near = near.withColumn("upto", F.sum("words").over(run)).filter("upto >= left and upto - words < left")
        last = near.select(F.col("source").alias("l"), F.col("score").alias("last_score"), F.col("doc_id").alias("last_id"), F.expr("(left - (upto - words)) div same").alias("last_words"))
        self.plan = cut(self.plan.join(last, F.col("source").eqNullSafe(F.col("l")), "left").drop("l"))


def pareto_mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document with what the mix takes of it. Options: those of Mix.

    A document's expected copies are its odds times its source's level, at most `copies`; the level is such that they come to the source's
    target. Odds are those of weight_col (null: 1; below 0 counts as 0), or a function of the size, or all 1. Whole copies are
    certain. The rest, pi, is an inclusion probability: documents are ranked by u / (1 - u) / (pi / (1 - pi)), u uniform and
    fixed by the id, and taken in that order until the source's target is full, so the size of the sample in words is fixed; the
    last one is taken in part. Returns doc_id, source, size, source_size, target, whole (certain copies), pi, score (the ranking
    variable), taken.

    A null text has size 0, a null source is a source of its own, a null id is ranked as an empty one. Rows of
    one id and score share what is left of the target evenly. An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    mix = Mix(docs, **options)
    whole, pi, score = ranked(F.col("m"), F.col("u"), F.col("level"), mix.copies)
    out = mix.joined(mix.rows, mix.plan).withColumns({"whole": whole, "pi": pi, "score": score})
    words = taken(F.col, F.col("doc_id"), F.col("size"), F.col("whole"), F.col("pi"), F.col("score"))
    return out.select("doc_id", "source", "size", "source_size", "target", "whole", "pi", "score", words.alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them: a row per copy, with the columns of docs.

    Copies are whole: a document in which a target fills up is taken once more if at least half of it fits. A document without words is taken as
    often as its source's target holds its source's words. Each row is decided by itself with the row of its source in the plan, so no
    text is shuffled and rows of a repeated or a null id need no other row.
    """
    mix = Mix(docs, **options)
    own, plan, copy = (free_name(docs, n) for n in ("_mix_row", "_mix_plan", "_mix_copy"))
    ident, source, size, m, u = mix.measures(docs)
    rows = docs.withColumn(own, F.struct(size.alias("size"), m.alias("m"), u.alias("u")))
    sources = mix.plan.select(F.struct("*").alias(plan))
    rows = rows.join(F.broadcast(sources) if mix.few else sources, F.col("source").eqNullSafe(F.col(f"{plan}.source")))

    def of(name: str) -> Column:
        return F.col(f"{plan}.{name}")

    size = F.col(f"{own}.size")
    whole, pi, score = ranked(F.col(f"{own}.m"), F.col(f"{own}.u"), of("level"), mix.copies)
    words = taken(of, F.col("doc_id"), size, whole, pi, score)
    times = F.when(size > 0, F.round(words / size)).otherwise(F.floor(of("target") / F.greatest(of("source_size"), F.lit(1)))).cast("int")
    rows = rows.withColumn(copy, times).filter(F.col(copy) > 0)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*docs.columns)
