"""Sharding by size-tiered compaction over immutable Parquet shards with a versioned manifest."""

from __future__ import annotations

import json
import math
import os
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, scratch, union_all

MB = 1 << 20


@dataclass(frozen=True)
class Shard:
    name: str
    bytes: int


class Conflict(RuntimeError):
    """Another writer has committed the version."""


class ShardStore:
    """A table of Parquet shards under root, which may be in any file system that Spark reaches.

    append() writes a batch as small shards; compact() merges runs of shards of one size tier; each
    ends in commit(), which gives the manifest of the next version its name only if no other writer has; who comes
    second puts the change on top of the new version and tries again. Readers see the shards of one manifest,
    whole, and versions stay readable until expire() drops them. Files of unfinished writes
    are in no manifest. Memory on the driver is a short record per shard, never per row.
    """

    #: Times that a writer tries to come first.
    TRIES = 20

    def __init__(self, spark: SparkSession, root: str, *, target_bytes: int = 64 * MB, base_bytes: int = MB, fanout: int = 4, rows_per_shard: int = 8192, merges_per_job: int = 48):
        self.spark, self.root = spark, root.rstrip("/")
        self.target_bytes, self.base_bytes, self.fanout, self.rows_per_shard, self.merges_per_job = target_bytes, base_bytes, fanout, rows_per_shard, merges_per_job
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, at: str):
        return self._jvm.org.apache.hadoop.fs.Path(at)

    def _files(self, folder: str) -> list[Shard]:
        at = self._path(f"{self.root}/{folder}")
        if not self._fs.exists(at):
            return []
        found = [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(at)]
        return sorted((Shard(f"{folder}/{n}", b) for n, b in found if n.endswith(".parquet")), key=lambda s: s.name)

    # Manifest

    def version(self) -> int:
        at = self._path(f"{self.root}/manifest")
        if not self._fs.exists(at):
            return 0
        return max([int(n[1:]) for s in self._fs.listStatus(at) if (n := s.getPath().getName())[0] == "v"], default=0)

    def shards(self, version: int | None = None) -> list[Shard]:
        version = self.version() if version is None else version
        if not version:
            return []
        stream = self._fs.open(self._path(f"{self.root}/manifest/v{version:08d}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Shard(**x) for x in json.loads(text)["shards"]]

    def commit(self, shards: list[Shard], onto: int) -> int:
        """Makes shards the version after onto. The file is written whole under another name and then linked or renamed to its own, a step that
        fails if there is such a file: a hard link on local disks, a rename without overwriting elsewhere."""
        new = onto + 1
        last, part = self._path(f"{self.root}/manifest/v{new:08d}"), self._path(scratch(self.spark, "manifest").rsplit("/", 1)[1])
        part = self._path(f"{self.root}/manifest/.{part.getName()}")
        out = self._fs.create(part, False)
        try:
            out.write(bytearray(json.dumps({"version": new, "shards": [asdict(s) for s in shards]}).encode()))
        finally:
            out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                os.link(part.toUri().getPath(), last.toUri().getPath())
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                context.rename(self._fs.makeQualified(part), self._fs.makeQualified(last), self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except FileExistsError as e:
            raise Conflict(f"version {new} exists") from e
        except Py4JJavaError as e:
            if self._fs.exists(last):
                raise Conflict(f"version {new} exists") from e
            raise
        finally:
            self._fs.delete(part, False)
        return new

    def _rebased(self, gone: set[str], new: list[Shard]) -> int:
        """Commits the newest version without the shards gone and with the new ones. Raises Conflict if another writer has replaced one of gone."""
        for _ in range(self.TRIES):
            now = self.shards(onto := self.version())
            if not gone <= {s.name for s in now}:
                break
            try:
                return self.commit([s for s in now if s.name not in gone] + new, onto)
            except Conflict:
                continue
        raise Conflict("another writer has replaced the shards, or was always first")

    def expire(self, keep: int = 1) -> int:
        """Drops all versions but the newest `keep`, and the shards that none of those names; returns how many shards went."""
        last = self.version()
        old = range(max(1, last - keep + 1))
        kept = {s.name for v in range(max(1, last - keep + 1), last + 1) for s in self.shards(v)}
        found = [v for v in old if v and self._fs.exists(self._path(f"{self.root}/manifest/v{v:08d}"))]
        gone = {s.name for v in found for s in self.shards(v)} - kept
        for v in found:
            self._fs.delete(self._path(f"{self.root}/manifest/v{v:08d}"), False)
        for name in gone:
            self._fs.delete(self._path(f"{self.root}/{name}"), False)
        return len(gone)

    # Writes

    def append(self, batch: DataFrame) -> int:
        """Each task of the batch writes its rows as shards of rows_per_shard rows at most; there is no shuffle."""
        folder = scratch(self.spark, f"arrived-{self.version() + 1:08d}").rsplit("/", 1)[1]
        batch.write.option("maxRecordsPerFile", self.rows_per_shard).option("compression", "zstd").parquet(f"{self.root}/{folder}")
        return self._rebased(set(), self._files(folder))

    def tier(self, size: int) -> int:
        return max(0, int(math.log(max(size, 1) / self.base_bytes, self.fanout))) if size > self.base_bytes else 0

    def plan(self, shards: list[Shard]) -> list[list[Shard]]:
        """Runs to merge: shards of a tier, in order, up to the target size. A run has two shards at least; shards of half the target's
        size or more rest, and a tier with fewer than fanout shards waits."""
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if s.bytes < self.target_bytes // 2:
                tiers.setdefault(self.tier(s.bytes), []).append(s)
        runs = []
        for _, members in sorted(tiers.items()):
            if len(members) < self.fanout:
                continue
            run: list[Shard] = []
            for s in members:
                if run and sum(x.bytes for x in run) + s.bytes > self.target_bytes:
                    runs.append(run)
                    run = []
                run.append(s)
            runs.append(run)
        return [r for r in runs if len(r) > 1]

    def compact(self, schema: T.StructType) -> int:
        """Merges until no tier has a run. Each run is read and written by one task, with no shuffle; a job takes merges_per_job runs."""
        # Else a union of one-partition tables has one partition too.
        key = "spark.sql.unionOutputPartitioning"
        was = self.spark.conf.get(key, None)
        self.spark.conf.set(key, "false")
        try:
            return self._compact(schema)
        finally:
            self.spark.conf.unset(key) if was is None else self.spark.conf.set(key, was)

    def _compact(self, schema: T.StructType) -> int:
        lost = 0
        while runs := self.plan(self.shards(onto := self.version())):
            merged: list[Shard] = []
            gone: set[str] = set()
            for k in range(0, len(runs), self.merges_per_job):
                part = runs[k : k + self.merges_per_job]
                folder = scratch(self.spark, f"merged-{onto + 1:08d}-{k // self.merges_per_job:06d}").rsplit("/", 1)[1]
                union_all([self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.name}" for s in r]).coalesce(1) for r in part]).write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
                merged += self._files(folder)
                gone |= {s.name for r in part for s in r}
            try:
                self._rebased(gone, merged)
            except Conflict:  # another compaction was first: its result is looked at anew
                for s in merged:
                    self._fs.delete(self._path(f"{self.root}/{s.name}"), False)
                lost += 1
                if lost == self.TRIES:
                    raise
        return self.version()

    def read(self, schema: T.StructType, version: int | None = None) -> DataFrame:
        """The rows of a version with _shard (its name) added."""
        shards = self.shards(version)
        if not shards:
            return self.spark.createDataFrame([], schema).withColumn("_shard", F.lit(None).cast("string"))
        df = self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.name}" for s in shards])
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        return df.select(*df.columns, F.concat_ws("/", folder, F.col("_metadata.file_name")).alias("_shard"))

    def table(self, version: int | None = None) -> DataFrame:
        """shard, shard_no (by name), tier, shard_bytes."""
        rows = [(s.name, k, self.tier(s.bytes), s.bytes) for k, s in enumerate(sorted(self.shards(version), key=lambda s: s.name))]
        return self.spark.createDataFrame(rows, "shard string, shard_no int, tier int, shard_bytes long")


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def shard_documents(docs: DataFrame, root: str | None = None, **options) -> tuple[ShardStore, DataFrame]:
    """Appends docs to a store and compacts it. Returns the store and, read back from its shards, docs with
    _shard added. All columns and values are kept as they are, nulls and repeated rows too; a column of docs
    named _shard in any case is renamed to _shard_in, with more underscores in front if that is taken as well. The
    shards as they arrived stay for readers of version 1 until expire(). An empty table gives a version without rows.
    """
    spark = docs.sparkSession
    if any(c.lower() == "_shard" for c in docs.columns):
        docs = docs.withColumnRenamed("_shard", free_name(docs, "_shard_in"))
    store = ShardStore(spark, root or scratch(spark, "shards"), **options)
    store.append(docs)
    store.compact(nullable(docs.schema))
    return store, store.read(nullable(docs.schema))


def shard_placement(docs: DataFrame, **options) -> DataFrame:
    """doc_id and where compaction put it: shard_no, tier, shard_bytes, version; text_crc32 (null text: of the empty one) is of the text read back."""
    return placement(*shard_documents(docs, **options))


def placement(store: ShardStore, rows: DataFrame) -> DataFrame:
    """Of the rows read back from a store."""
    rows = rows.select("doc_id", F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), F.col("_shard"))
    out = rows.join(store.table(), F.col("_shard") == F.col("shard"))
    return out.select("doc_id", "shard_no", "tier", "shard_bytes", F.lit(store.version()).alias("version"), "text_crc32")
