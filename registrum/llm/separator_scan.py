"""Token counts of documents in flat token files that have no index: a scan for the separator."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, filesystem, need, scratch
from .encoding import encoder, together


def write_flat(docs: DataFrame, root: str, tokenizer: str, *, pattern: str, separator: int, width: int = 2) -> DataFrame:
    """One file of ids per task, each document followed by the separator, in the order of the rows, without a header or an index.
    Returns file, place (of the document in its file), doc_id. A null text is an empty document. A file gets its name when it is whole."""
    need(docs, "doc_id", "text")
    fs, at = filesystem(root)
    fs.create_dir(at)
    end = np.array([separator], f"<u{width}")

    def write(batches):
        fs, at = filesystem(root)
        encode, task = encoder("ranked", tokenizer, width, pattern=pattern), TaskContext.get()
        name, n, out = f"{task.partitionId():06d}.ids", 0, None
        part = f"{at}/.part-{task.partitionId():06d}-{task.taskAttemptId()}"
        for b in together(batches):
            out = out or fs.open_output_stream(part, buffer_size=1 << 20)
            ids = encode(b.column("text").to_pylist())
            if any((x == end).any() for x in ids):
                raise ValueError(f"a text has the separator {separator}")
            out.write(np.concatenate([y for x in ids for y in (x, end)]))
            yield pa.RecordBatch.from_arrays([pa.array([name] * b.num_rows), pa.array(np.arange(n, n + b.num_rows)), b.column("doc_id")], names=["file", "place", "doc_id"])
            n += b.num_rows
        if out is not None:
            out.close()
            fs.move(part, f"{at}/{name}")

    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(write, "file string, place long, doc_id long"))


def scan(spark: SparkSession, root: str, *, separator: int, width: int = 2, block_bytes: int = 4 << 20) -> DataFrame:
    """Documents of all *.ids files under root: file, place, start (ids before it in the file), n_tokens without the separator.

    Blocks of the files are searched on their own, each for the places of the separator. A document that
    spans blocks is put together by a prefix scan over the blocks' counts and last separators, file by file; the rows of
    the scan are the blocks, not the documents. Ids after a file's last separator are no document.
    """
    from pyarrow import fs as pafs

    fs, at = filesystem(root)
    found = [(i.base_name, i.size) for i in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)) if i.base_name.endswith(".ids")]
    schema = "file string, block int, count long, last long, ends array<long>"
    files = spark.createDataFrame(found, "file string, size long")
    step = block_bytes // width * width
    blocks = files.filter("size > 0").select("file", F.explode(F.sequence(F.lit(0), F.expr(f"cast((size - 1) div {step} as int)"))).alias("block"))
    total = sum(-(-s // step) for _, s in found)

    def search(batches):
        fs, at = filesystem(root)
        for b in batches:
            for name, k in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), strict=True):
                with fs.open_input_file(f"{at}/{name}") as f:
                    f.seek(k * step)
                    ids = np.frombuffer(f.read(step), f"<u{width}")
                ends = np.flatnonzero(ids == separator) + k * (step // width)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int32()), pa.array([len(ends)], pa.int64()), pa.array([int(ends[-1]) if len(ends) else None], pa.int64()), pa.array([ends.tolist()], pa.list_(pa.int64()))], schema=pa.schema([("file", pa.string()), ("block", pa.int32()), ("count", pa.int64()), ("last", pa.int64()), ("ends", pa.list_(pa.int64()))]))

    hits = cut(blocks.repartition(max(1, min(total, 10_000))).mapInArrow(search, schema))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    stitched = hits.select("file", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"), (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("begin"))
    starts = F.concat(F.array("begin"), F.transform(F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))), lambda x: x + 1))
    docs = hits.filter("count > 0").join(stitched, ["file", "block"]).select("file", "base", F.posexplode(F.arrays_zip(starts.alias("s"), F.col("ends").alias("e"))).alias("k", "d"))
    return docs.select("file", (F.col("base") + F.col("k")).alias("place"), F.col("d.s").alias("start"), (F.col("d.e") - F.col("d.s")).alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, *, pattern: str, separator: int, root: str | None = None) -> DataFrame:
    """doc_id, file, place, start, n_tokens of each row of docs, from flat files that are written and scanned."""
    root = root or scratch(docs.sparkSession, "flat")
    names = write_flat(docs, root, tokenizer, pattern=pattern, separator=separator)
    return names.join(scan(docs.sparkSession, root, separator=separator), ["file", "place"]).select("doc_id", "file", "place", "start", "n_tokens")
