"""What the operators of this folder share: words, checksums, shared folders, connected components."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z in lower case. bytes.lower() and bytes.split() touch ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def crc_of(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a temporary one in local mode; an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="registrum-")
        spark.conf.set("spark.checkpoint.dir", at)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(at)
    return at


def scratch(spark: SparkSession, name: str) -> str:
    """A new path, as a URI, under the shared folder."""
    at = shared_dir(spark)
    if "://" not in at:  # as Hadoop's default file system takes it
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        at = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
        at = "file://" + at.removeprefix("file:") if at.startswith("file:/") and not at.startswith("file://") else at
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, at: str) -> None:
    """Deletes a path of scratch() that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    with small_batches(df.sparkSession):
        return df.checkpoint()


def written(df: DataFrame, name: str, codec: str = "zstd", at: str | None = None) -> DataFrame:
    """The same rows as a Parquet table in the shared folder."""
    at = at or scratch(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.option("compression", codec).parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> Iterator[None]:
    """Bounds rows and bytes of the Arrow batches that go to Python in jobs that run inside, and then sets them back."""
    keys = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """For results that the caller computes later: bounds rows and bytes of the session's Arrow batches where they are at Spark's defaults
    (10,000 rows, 64 MB), which take hundreds of MB beside the heap. What the caller has set stays, and no result depends on it."""
    for key, default, value in (("maxRecordsPerBatch", ("10000",), str(rows)), ("maxBytesPerBatch", ("67108864b", "64MB", "64m"), size)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", default[0]) in default:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def lean(make):
    """A function for mapInArrow that hands freed memory back when a part of the table is done. Python workers wait for other tasks beside the heap,
    and what allocators keep in them counts against the executor through all stages that need no Python."""

    def run(batches):
        yield from make(batches)
        release()

    return run


def release() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def sliced(batches, rows: int = 1000):
    """Batches of so many rows at most, for functions that run in jobs of the caller."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def filesystem(uri: str):
    """A pyarrow file system and the path in it, for reads and writes on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until df has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def components(edges: DataFrame, rounds: int = 60, most: int = 1 << 20) -> DataFrame:
    """Connected components of an undirected graph by alternating large-star and small-star steps.

    edges: u, v (long); repeated edges, both directions and loops are fine. Returns node, component
    (the least node that can be reached), for each node of an edge. Every step sends a node's
    edges to the least neighbour by min() aggregates and joins, so no neighbourhood is collected. A node with more than `most`
    edges is dealt to several tasks in the joins.
    """
    cur = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    count = cur.count()
    # Steps of few rows run in few tasks; there are as many more as there are edges.
    tasks = 1 + count // 500_000
    cur, before = cur.coalesce(tasks), None

    def joined(edges: DataFrame, least: DataFrame) -> DataFrame:
        """edges (u, v) with m of u. least: k, m, n (edges of k)."""
        if count <= most:
            return edges.join(least.drop("n"), F.col("u") == F.col("k"))
        # There are at most 2 * count / most such nodes.
        hubs = least.filter(F.col("n") > most).select(F.col("k").alias("hub"), F.ceil(F.col("n") / most).cast("int").alias("parts"))
        dealt = edges.join(F.broadcast(hubs) if 2 * count // most <= 1_000_000 else hubs, F.col("u") == F.col("hub"), "left")
        dealt = dealt.select("u", "v", F.pmod(F.xxhash64("v"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
        copies = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / most).cast("int"), F.lit(1)) - 1))
        return dealt.join(least.select("k", "m", copies.alias("of")), (F.col("u") == F.col("k")) & (F.col("part") == F.col("of")))

    for _ in range(rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).coalesce(tasks)
        least = least.select(F.col("u").alias("k"), F.least("u", "m").alias("m"), "n")
        # Large star: each larger neighbour v of u is linked to the least of u and its neighbours.
        large = joined(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct().coalesce(tasks)
        # Small star: u and its smaller neighbours are linked to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("k"), "m", "n").coalesce(tasks)
        linked = joined(large, low).coalesce(tasks)
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        cur = cut(small.coalesce(tasks))
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    pairs = cur.groupBy("u").agg(F.min("v").alias("component")).coalesce(tasks)
    roots = cur.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node")).coalesce(tasks)
    return cut(pairs.select(F.col("u").alias("node"), "component").unionByName(roots.join(pairs.select(F.col("u").alias("node")), "node", "left_anti")).coalesce(tasks))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def from_files(docs: DataFrame) -> bool:
    """Whether the rows come straight from files, without a step that may give them in another order when it runs again."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    nodes = [plan]
    while nodes:
        p = nodes.pop()
        if p.nodeName() not in ("Project", "Filter") and not (p.nodeName() == "LogicalRelation" or p.nodeName().startswith("Relation")):
            return False
        if not p.deterministic():
            return False
        nodes += [p.children().apply(k) for k in range(p.children().size())]
    return True


#: A row's number is its part of the table, shifted by so many bits, and its place in the part.
PLACE_BITS = 33


def steady_splits(spark: SparkSession) -> None:
    """Fixes the number of cores by which small files are put together and large ones cut, where the session leaves it open. Spark takes the cores it has
    at the time, so a table that is read again after executors were lost or added would come in other parts."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set(key, str(cores))


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """docs with the number of each row in the column name. The numbers are those of the places in the files that docs is read from, the same ones
    however many executors there are later; rows that come from anything else are written to the shared folder first."""
    steady_splits(docs.sparkSession)
    if not from_files(docs):
        docs = written(docs, "rows")
    return docs.select("*", F.monotonically_increasing_id().alias(name))


def beside(rows: DataFrame, name: str) -> str:
    """Writes rows about numbered rows (row and whole numbers) so that a task that reads a part of the numbered table finds what is about it."""
    at = scratch(rows.sparkSession, name)
    part = F.shiftright("row", PLACE_BITS).alias("p")
    rows.select("*", part).repartition("p").sortWithinPartitions("p", "row").write.partitionBy("p").option("compression", "zstd").parquet(at)
    return at


class Beside:
    """What beside() has written about rows of one part of the table, which come in the order of their numbers. Holds what is about one part."""

    def __init__(self, at: str):
        self.at, self.part = at, None

    def _open(self, part: int) -> None:
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        fs, at = filesystem(self.at)
        found = fs.get_file_info(pafs.FileSelector(f"{at}/p={part}", allow_not_found=True))
        tables = []
        for i in sorted(x.path for x in found if x.path.endswith(".parquet")):
            with fs.open_input_file(i) as f:
                tables.append(pq.ParquetFile(f).read())
        self.part, self.table = part, None
        if tables:
            table = pa.concat_tables(tables)
            columns = {c: table.column(c).to_numpy() for c in table.column_names}
            if len(tables) > 1:
                order = np.argsort(columns["row"], kind="stable")
                columns = {c: x[order] for c, x in columns.items()}
            self.table, self.rows = columns, columns["row"]

    def of(self, row: int) -> dict | None:
        """The columns of what is about a row; None if there is nothing."""
        if (part := row >> PLACE_BITS) != self.part:
            self._open(part)
        if self.table is None:
            return None
        lo, hi = self.rows.searchsorted(row, "left"), self.rows.searchsorted(row, "right")
        return {c: x[lo:hi] for c, x in self.table.items()} if hi > lo else None


def bit_map(keys: DataFrame, column: str, least: int = 1 << 20, most: int = 1 << 30) -> bytes:
    """The low bits of a long column as a map of sixteen bits a key, a power of two between least and most: 128 MB at most, however many keys."""
    size = least
    while size < min(most, 16 * keys.count()):
        size *= 2
    place = F.col(column).bitwiseAND(F.lit(size - 1)) + 1
    parts = keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()
    out = bytearray(size // 8)
    for r in parts:
        out[(r.b - 1) * 4096 : r.b * 4096] = r.m
    return bytes(out)


def in_map(bits: bytes, keys):
    """Which of an array of 64-bit keys may be in the map; those that were put in it all are."""
    import numpy as np

    at = keys.view("u8") & np.uint64(len(bits) * 8 - 1)
    return (np.frombuffer(bits, "u1")[(at >> np.uint64(3)).astype("i8")] >> (at & np.uint64(7)).astype("u1")) & 1 > 0
