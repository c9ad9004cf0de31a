"""The corpus pipeline: each stage is written as Parquet and read again as the next stage's documents.

All stages but the last return the columns of documents, others that the table has as well, whatever their names. Null and empty texts have no words,
null ids and sources are values of their own, and an empty table gives an empty one; the stages say what else that means for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.llm import decontaminate, mixing, near_dedup, quality_fm, sharding
from registrum.llm.common import drop, free_name, scratch


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 go. The classifier is fitted on labelled documents among docs, of a repeated id on the least of its texts. Rows are
    judged each by its text, a null one as an empty one; without any labelled document all scores are about a half and all rows stay."""
    machine = quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name(docs, "_quality")
    return quality_fm.with_scores(docs, machine, score).filter(F.col(score) >= 0.3).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more on five-word shingles the document of the least id stays, of rows that repeat it the first,
    and one without an id only where no other is in the group. Rows without words are linked with nothing and stay."""
    return near_dedup.one_of_each(docs, shingle=5, percent=80)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which an item of the benchmark is found go, each row by its own text. Rows without words stay, as do all if the benchmark is empty."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes; a document of which it takes less than half goes. A null source is one of its own; a document without words
    is taken as often as its source's target holds its source's words. Ties in rank are broken by id."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where compaction puts each row: doc_id, shard_no, tier, shard_bytes, version, text_crc32 (of a null text as of an empty one); every row once."""
    return sharding.shard_placement(docs)


STAGES = [
    ("quality", classify),
    ("near duplicates", deduplicate),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]

#: The classifier's and the seeds' decisions cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's table is deleted when the next one's is written; the last stage has the rows in shards of its own."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        at = None
        if name != STAGES[-1][0]:
            at = scratch(spark, "stage-" + name.replace(" ", "-"))
            docs.write.parquet(at)
            docs = spark.read.parquet(at)
        if last:
            drop(spark, last)
        last = at
    return docs
