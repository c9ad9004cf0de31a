"""Token ids in files of separately compressed documents with one shared zstandard dictionary.

A file, all numbers little-endian: "TKZ1"; sha256 of the dictionary (32 bytes); width of an id in
bytes (u32); one zstandard frame per document, in ascending doc_id order, null last; then the index: doc_id
(i64 each), null flags (u8 each), ids of all documents before each one in the file and after the last
(u64), offsets of the frames and the end of the last (u64); then a trailer: documents (u64),
offset of the index (u64), "TKZ1". One document is read with the trailer, the index and its frame alone.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, drop, filesystem, need, scratch, small_batches, written
from .encoding import encoder, together

MAGIC = b"TKZ1"
SLICE = 8 << 20


def train_dictionary(docs: DataFrame, path: str, width: int, end_id: int, *, documents: int = 2000, chars: int = 8 << 20, size: int = 64 << 10) -> bytes:
    """A dictionary from a bounded sample of whole documents: those of the least hashes, `documents` at most, in that order as long as they
    fit into `chars` characters together. It changes the size of the files only: every text is stored whole."""
    import zstandard

    h = F.xxhash64("doc_id", "text")
    texts = docs.filter("text <> ''").select("doc_id", "text", h.alias("h"), F.length("text").alias("n"))
    bar, room = None, chars
    for r in texts.select("h", "n").orderBy("h").limit(documents).collect():
        room -= r.n
        if room < 0:
            break
        bar = r.h
    if bar is None:
        return b""
    picked = texts.filter(F.col("h") <= bar).orderBy("h").limit(documents).select("text").collect()
    end = np.array([end_id], f"<u{width}").tobytes()
    ids = [x.tobytes() + end for x in encoder("tokenizers", path, width)([r.text for r in picked])]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, ids)) // 8 + 512), ids).as_bytes()
    except zstandard.ZstdError:  # too few documents to train on: the ids of the last of them, as raw content
        return b"".join(ids)[-size:]


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


class Writer:
    """One file, of frames made elsewhere."""

    def __init__(self, out, raw: bytes, width: int):
        self.out = out
        self.doc_ids, self.nulls, self.starts, self.offsets = array("q"), bytearray(), array("Q", [0]), array("Q")
        head = MAGIC + hashlib.sha256(raw).digest() + struct.pack("<I", width)
        out.write(head)
        self.at = len(head)

    def add(self, doc_id: int | None, n: int, frame: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + n)
        self.offsets.append(self.at)
        self.out.write(frame)
        self.at += len(frame)

    def close(self) -> None:
        self.out.write(np.array(self.doc_ids, "<i8").tobytes() + bytes(self.nulls) + np.array(self.starts, "<u8").tobytes() + np.array([*self.offsets, self.at], "<u8").tobytes())
        self.out.write(struct.pack("<QQ", len(self.doc_ids), self.at) + MAGIC)
        self.out.close()


class Reader:
    def __init__(self, file, raw: bytes):
        import zstandard

        self.file, d = file, _dictionary(raw)
        self.decompress = (zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()).decompress
        head = file.read(40)
        if head[:4] != MAGIC or head[4:36] != hashlib.sha256(raw).digest():
            raise ValueError("not a token file of this dictionary")
        (self.width,) = struct.unpack("<I", head[36:])
        file.seek(file.size() - 20)
        n, at = struct.unpack("<QQ", (tail := file.read(20))[:16])
        if tail[16:] != MAGIC:
            raise ValueError("the file has no trailer")
        file.seek(at)
        index = file.read(n * 9 + (n + 1) * 16)
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.nulls = np.frombuffer(index, "u1", n, n * 8).astype(bool)
        self.starts = np.frombuffer(index, "<u8", n + 1, n * 9)
        self.offsets = np.frombuffer(index, "<u8", n + 1, n * 9 + (n + 1) * 8)

    def frames(self) -> Iterator[tuple[int, bytes]]:
        """(place, ids) of all documents, reading slices of the file."""
        n, k = len(self.doc_ids), 0
        while k < n:
            j = max(k + 1, int(np.searchsorted(self.offsets, self.offsets[k] + SLICE, "right")) - 1)
            base = int(self.offsets[k])
            self.file.seek(base)
            data = self.file.read(int(self.offsets[j]) - base)
            for i in range(k, j):
                yield i, self.decompress(data[int(self.offsets[i]) - base : int(self.offsets[i + 1]) - base])
            k = j

    def get(self, doc_id: int) -> list[np.ndarray]:
        """The ids of each document of this id; only their frames are read."""
        known = len(self.doc_ids) - int(self.nulls.sum())
        lo, hi = (int(np.searchsorted(self.doc_ids[:known], doc_id, s)) for s in ("left", "right"))
        out = []
        for i in range(lo, hi):
            self.file.seek(int(self.offsets[i]))
            out.append(np.frombuffer(self.decompress(self.file.read(int(self.offsets[i + 1] - self.offsets[i]))), f"<u{self.width}"))
        return out


def frames(docs: DataFrame, tokenizer: str, raw: bytes, *, end_id: int, width: int, level: int = 3) -> DataFrame:
    """doc_id, n (ids with the end id), frame (the compressed ids) of each row of docs, in tasks of the table's own parts."""
    end = np.array([end_id], f"<u{width}")

    def make(batches):
        import zstandard

        d, encode = _dictionary(raw), encoder("tokenizers", tokenizer, width)
        compress = (zstandard.ZstdCompressor(level=level, dict_data=d) if d else zstandard.ZstdCompressor(level=level)).compress
        for held in together(batches):
            ids = [np.concatenate([x, end]) for x in encode(held.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([held.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([compress(x.tobytes()) for x in ids], pa.binary())], names=["doc_id", "n", "frame"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(make, "doc_id long, n long, frame binary")


def write_store(docs: DataFrame, root: str, tokenizer: str, *, end_id: int = 2, width: int = 2, file_bytes: int = 256 << 20, file_docs: int = 1 << 20) -> list[tuple[str, int, int]]:
    """Writes the files of docs (doc_id, text). Returns (path, documents, ids) per file, in the order of ids; the same list is in root/manifest.

    Documents are encoded and compressed where they are read; the frames, not the texts, are dealt by ranges of doc_id, where rows of one id
    or without an id may be many ranges, and sorted. A task writes files of file_bytes bytes and file_docs documents at most, one
    document apart, so no index grows with the table. Files of a task that failed are in no manifest. A null text is stored as an
    empty one, which still has its end id. Rows of one id are all kept.
    """
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    raw = train_dictionary(docs, tokenizer, width, end_id)
    fs, at = filesystem(root)
    fs.create_dir(at)
    with fs.open_output_stream(f"{at}/dictionary") as f:
        f.write(raw)
    kept = scratch(spark, "frames")
    made = written(frames(docs, tokenizer, raw, end_id=end_id, width=width), "frames", "none", kept)

    def write(batches):
        fs, at = filesystem(root)
        task, w, done = TaskContext.get(), None, []

        def close():
            w.close()
            done.append((task.partitionId(), len(done), name, len(w.doc_ids), w.starts[-1]))

        for b in batches:
            for doc_id, n, frame in zip(*[b.column(c).to_pylist() for c in ("doc_id", "n", "frame")], strict=True):
                if w is not None and (w.at >= file_bytes or len(w.doc_ids) >= file_docs):
                    close()
                    w = None
                if w is None:
                    name = f"ids-{task.partitionId():06d}-{len(done):04d}-{task.taskAttemptId()}"
                    w = Writer(fs.open_output_stream(f"{at}/{name}", buffer_size=1 << 20), raw, width)
                w.add(doc_id, n, frame)
        if w is not None:
            close()
        if done:
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)], names=["part", "k", "name", "documents", "ids"])

    order = F.col("doc_id").asc_nulls_last()
    dealt = made.repartitionByRange(order, F.xxhash64("frame")).sortWithinPartitions(order, "frame")
    with small_batches(spark):
        done = dealt.mapInArrow(write, "part int, k int, name string, documents long, ids long").collect()
    drop(spark, kept)
    files = [(f"{root}/{r.name}", r.documents, r.ids) for r in sorted(done, key=lambda r: (r.part, r.k))]
    with fs.open_output_stream(f"{at}/manifest") as f:
        f.write(json.dumps([{"file": p.rsplit("/", 1)[1], "documents": d, "ids": n} for p, d, n in files]).encode())
    return files


def read_store(spark: SparkSession, root: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """doc_id, start (ids before the document in all files), n_tokens, ids_crc32 of the ids as unsigned 32-bit integers, read from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    rows, base = [], 0
    for path, _, n in files:
        rows.append((path, base))
        base += n
    if not rows:
        return spark.createDataFrame([], schema)

    def read(batches):
        fs, at = filesystem(root)
        with fs.open_input_stream(f"{at}/dictionary") as f:
            raw = f.read()
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True):
                with fs.open_input_file(filesystem(path)[1]) as f:
                    r = Reader(f, raw)
                    n, sums = np.zeros(len(r.doc_ids), "i8"), np.zeros(len(r.doc_ids), "i8")
                    for i, ids in r.frames():
                        x = np.frombuffer(ids, f"<u{r.width}")
                        n[i], sums[i] = len(x), zlib.crc32(x.astype("<u4"))
                    start = base + np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
                yield pa.RecordBatch.from_arrays([pa.array(r.doc_ids, mask=r.nulls), pa.array(start.astype("i8")), pa.array(n), pa.array(sums)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return cut(spark.createDataFrame(rows, "path string, base long").repartition(len(rows)).mapInArrow(read, schema))


def store_ids(docs: DataFrame, tokenizer: str, *, root: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes docs as a store of token files and reads all of it back."""
    root = root or scratch(docs.sparkSession, "ids")
    return read_store(docs.sparkSession, root, write_store(docs, root, tokenizer, end_id=end_id))
