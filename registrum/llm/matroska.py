"""Media columns: Matroska files with one 8-bit audio track, written, and parsed to tables of packets."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, need, sliced, written

# Element ids of the Matroska specification (RFC 9559) and of EBML (RFC 8794).
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1

#: Samples a second, so that a frame of 512 samples lasts 64 ms.
RATE, FRAME, LACED, BLOCKS = 8000, 512, 8, 32
NO_LACE, XIPH, FIXED, EBML_LACE = 0, 1, 2, 3
LACES = {NO_LACE: "none", XIPH: "xiph", FIXED: "fixed", EBML_LACE: "ebml"}


def vint(n: int, least: int = 1) -> bytes:
    """A size of variable length; all ones of a length mean an unknown size and are not used for a known one."""
    size = least
    while n >= (1 << 7 * size) - 1:
        size += 1
    return (n | 1 << 7 * size).to_bytes(size, "big")


def element(ident: int, data: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(data)) + data


def number(ident: int, n: int) -> bytes:
    return element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def read_vint(data, at: int, keep: bool = False) -> tuple[int | None, int]:
    """(value, next place); None for an unknown size. keep: with the length's bit, as ids are."""
    first = data[at]
    if not first:
        raise ValueError(f"no element at byte {at}")
    size = 9 - first.bit_length()
    n = int.from_bytes(data[at : at + size], "big")
    if at + size > len(data):
        raise ValueError("the file ends within a number")
    if keep:
        return n, at + size
    n ^= 1 << 7 * size
    return (None if n == (1 << 7 * size) - 1 else n), at + size


def lace(frames: list[bytes], kind: int) -> bytes:
    """Sizes of the frames of a block, and the frames."""
    if kind == NO_LACE:
        return frames[0]
    head = bytes([len(frames) - 1])
    if kind == XIPH:
        head += b"".join(b"\xff" * (len(f) // 255) + bytes([len(f) % 255]) for f in frames[:-1])
    elif kind == EBML_LACE and len(frames) > 1:
        head += vint(len(frames[0]))
        for a, b in zip(frames, frames[1:-1], strict=False):
            d = len(b) - len(a)
            size = 1
            while abs(d) >= (1 << 7 * size - 1) - 1:
                size += 1
            head += (d + (1 << 7 * size - 1) - 1 | 1 << 7 * size).to_bytes(size, "big")
    return head + b"".join(frames)


def mux(payload: bytes) -> bytes:
    """A file that holds payload, whose length is a multiple of 64, as 8-bit samples of one track."""
    frames = [payload[k : k + FRAME] for k in range(0, len(payload), FRAME)]
    info = element(INFO, number(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)) + element(MUXING_APP, b"registrum") + element(WRITING_APP, b"registrum"))
    audio = element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", float(RATE))) + number(CHANNELS, 1) + number(BIT_DEPTH, 8))
    tracks = element(TRACKS, element(TRACK_ENTRY, number(TRACK_NUMBER, 1) + number(TRACK_UID, zlib.crc32(payload) + 1) + number(TRACK_TYPE, 2) + number(FLAG_LACING, 1) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio))
    parts, at, cues = [info, tracks], len(info) + len(tracks), []
    for c in range(0, len(frames), LACED * BLOCKS):
        begin = c * FRAME * 1000 // RATE
        blocks = [number(TIMESTAMP, begin)]
        for k in range(c, min(c + LACED * BLOCKS, len(frames)), LACED):
            group = frames[k : k + LACED]
            kind = NO_LACE if len(group) == 1 else FIXED if len(group[-1]) == FRAME else EBML_LACE
            time = k * FRAME * 1000 // RATE - begin
            blocks.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", time, 0x80 | kind << 1) + lace(group, kind)))
        parts.append(element(CLUSTER, b"".join(blocks)))
        cues.append((begin, at))
        at += len(parts[-1])
    parts.append(element(CUES, b"".join(element(CUE_POINT, number(CUE_TIME, t) + element(CUE_TRACK_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER_POSITION, p))) for t, p in cues)))
    head = number(EBML_VERSION, 1) + number(EBML_READ_VERSION, 1) + number(EBML_MAX_ID, 4) + number(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + number(DOC_TYPE_VERSION, 4) + number(DOC_TYPE_READ_VERSION, 2)
    return element(EBML, head) + element(SEGMENT, b"".join(parts))


@dataclass
class Parsed:
    """packets: (track, time in ns, offset, size, keyframe, laces' kind); cues: (time in ns, track, offset of the cluster in the file)."""

    doc_type: str = ""
    scale: int = 1_000_000
    duration: float | None = None
    tracks: list[dict] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    packets: list[tuple[int, int, int, int, bool, int]] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)


def children(data, at: int, end: int, siblings: frozenset[int] = frozenset()) -> Iterator[tuple[int, int, int]]:
    """(id, begin, end) of the elements in data[at:end]. An element of unknown size ends at the next of siblings or at end."""
    while at < end:
        ident, k = read_vint(data, at, keep=True)
        size, k = read_vint(data, k)
        if size is None:
            stop = k
            while stop < end:
                other, j = read_vint(data, stop, keep=True)
                if other in siblings:
                    break
                n, j = read_vint(data, j)
                stop = end if n is None else j + n
        else:
            stop = k + size
        if stop > end:
            raise ValueError(f"the element at byte {at} is longer than what holds it")
        yield ident, k, stop
        at = stop


def real(data: bytes) -> float:
    return struct.unpack(">f" if len(data) == 4 else ">d", data)[0] if data else 0.0


def uint(data: bytes) -> int:
    return int.from_bytes(data, "big")


def laced(data, at: int, end: int, kind: int) -> Iterator[tuple[int, int]]:
    """(offset, size) of the frames of a block whose frames' sizes begin at at."""
    if kind == NO_LACE:
        yield at, end - at
        return
    count, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == FIXED:
        if (end - at) % count:
            raise ValueError("a block's frames are not of one size")
        sizes = [(end - at) // count] * count
    elif kind == XIPH:
        for _ in range(count - 1):
            n = 0
            while data[at] == 255:
                n, at = n + 255, at + 1
            sizes.append(n + data[at])
            at += 1
    else:
        for k in range(count - 1):
            width = 9 - data[at].bit_length()
            n, at = read_vint(data, at)
            sizes.append(n if not k else sizes[-1] + n - ((1 << 7 * width - 1) - 1))
    if len(sizes) < count:
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("a block's frames are longer than the block")
    for n in sizes:
        yield at, n
        at += n


TOP = frozenset((INFO, TRACKS, CLUSTER, CUES, SEGMENT, EBML))


def parse(data: bytes) -> Parsed:
    """The packets, tracks and cues of a file. Elements that are not known are passed over; sizes of segments and
    clusters may be unknown. Raises ValueError where the bytes are no such file."""
    out = Parsed()
    for ident, a, b in children(data, 0, len(data)):
        if ident == EBML:
            out.doc_type = next((data[x:y].decode("ascii").rstrip("\0") for i, x, y in children(data, a, b) if i == DOC_TYPE), "matroska")
        elif ident == SEGMENT:
            _segment(data, a, b, out)
    if out.doc_type not in ("matroska", "webm"):
        raise ValueError("not a Matroska file")
    return out


def _segment(data, begin: int, end: int, out: Parsed) -> None:
    lasts: dict[int, int] = {}
    for ident, a, b in children(data, begin, end, TOP):
        if ident == INFO:
            for i, x, y in children(data, a, b):
                if i == TIMESTAMP_SCALE:
                    out.scale = uint(data[x:y])
                elif i == DURATION:
                    out.duration = real(data[x:y])
        elif ident == TRACKS:
            for i, x, y in children(data, a, b):
                if i == TRACK_ENTRY:
                    t: dict = {"type": 0, "codec": "", "rate": None, "bits": None}
                    for j, p, q in children(data, x, y):
                        if j == TRACK_NUMBER:
                            t["number"] = uint(data[p:q])
                        elif j == TRACK_TYPE:
                            t["type"] = uint(data[p:q])
                        elif j == CODEC_ID:
                            t["codec"] = data[p:q].decode("ascii").rstrip("\0")
                        elif j == AUDIO:
                            for n, u, v in children(data, p, q):
                                if n == SAMPLING_FREQUENCY:
                                    t["rate"] = real(data[u:v])
                                elif n == BIT_DEPTH:
                                    t["bits"] = uint(data[u:v])
                    out.tracks.append(t)
        elif ident == CLUSTER:
            out.clusters.append(a)
            time = 0
            for i, x, y in children(data, a, b, TOP):
                if i == TIMESTAMP:
                    time = uint(data[x:y])
                elif i == SIMPLE_BLOCK:
                    _block(data, x, y, time, out, lasts, None)
                elif i == BLOCK_GROUP:
                    inner = list(children(data, x, y))
                    for j, p, q in inner:
                        if j == BLOCK:
                            _block(data, p, q, time, out, lasts, all(n != 0xFB for n, _, _ in inner))
        elif ident == CUES:
            for i, x, y in children(data, a, b):
                if i == CUE_POINT:
                    time = 0
                    for j, p, q in children(data, x, y):
                        if j == CUE_TIME:
                            time = uint(data[p:q])
                        elif j == CUE_TRACK_POSITIONS:
                            got = {n: uint(data[u:v]) for n, u, v in children(data, p, q)}
                            out.cues.append((time * out.scale, got.get(CUE_TRACK, 0), begin + got.get(CUE_CLUSTER_POSITION, 0)))


def _block(data, at: int, end: int, cluster: int, out: Parsed, lasts: dict[int, int], key: bool | None) -> None:
    track, at = read_vint(data, at)
    time, flags = struct.unpack_from(">hB", data, at)
    kind, ns = flags >> 1 & 3, (cluster + time) * out.scale
    rate = next((t["rate"] for t in out.tracks if t.get("number") == track and t["codec"].startswith("A_PCM")), None)
    for offset, size in laced(data, at + 3, end, kind):
        out.packets.append((track, ns, offset, size, bool(flags & 0x80) if key is None else key, kind))
        if rate:  # frames of a lace follow each other
            ns += round(size * 1e9 / rate)
    lasts[track] = ns


def payload_of(data: bytes, parsed: Parsed, track: int = 1) -> bytes:
    return b"".join([data[o : o + n] for t, _, o, n, _, _ in parsed.packets if t == track])


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % 64 if raw else 64)


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text (null: empty) as a Matroska file, in a table in the shared folder."""
    need(docs, "doc_id", "text")

    def pack(batches):
        for b in batches:
            got = [padded(x) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([n for n, _ in got], pa.int64()), pa.array([mux(p) for _, p in got], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, "doc_id long, n_bytes long, media binary"), "media")


def packets(media: DataFrame) -> DataFrame:
    """The packet table of a media column: doc_id, packet, track, time_ns, byte_offset, byte_size, keyframe, lacing. A null or broken file has no packets."""

    def unpack(batches):
        for b in batches:
            rows = []
            for doc_id, data in zip(b.column("doc_id").to_pylist(), b.column("media").to_pylist(), strict=True):
                try:
                    found = parse(data).packets if data else []
                except (ValueError, IndexError, struct.error):
                    found = []
                rows += [(doc_id, k, *p[:5], LACES[p[5]]) for k, p in enumerate(found)]
            names = ["doc_id", "packet", "track", "time_ns", "byte_offset", "byte_size", "keyframe", "lacing"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return media.select("doc_id", "media").mapInArrow(unpack, "doc_id long, packet int, track int, time_ns long, byte_offset long, byte_size long, keyframe boolean, lacing string")


def feature(data: bytes, parsed: Parsed, payload: bytes) -> str:
    """Counts of the container, and the mean and the energy of the samples."""
    x = np.frombuffer(payload, "u1")
    lacing = "+".join(sorted({LACES[p[5]] for p in parsed.packets}))
    right = sum(o in {c for c in parsed.clusters} for o in (_body(data, p) for _, _, p in parsed.cues))
    mean, square = (int(x.sum(dtype=np.int64)), int((x.astype(np.uint32) ** 2).sum(dtype=np.int64))) if len(x) else (0, 0)
    return f"packets={len(parsed.packets)};clusters={len(parsed.clusters)};cues={right}/{len(parsed.cues)};lacing={lacing};ms={len(x) * 1000 // RATE};sum={mean};energy={square}"


def _body(data: bytes, at: int) -> int:
    """Where the content of the element at at begins."""
    return read_vint(data, read_vint(data, at, keep=True)[1])[1]


def described(data: bytes | None) -> tuple:
    """payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of one file."""
    if data is None:
        return (None,) * 6
    own = len(data), hashlib.sha256(data).hexdigest()
    try:
        parsed = parse(data)
        payload = payload_of(data, parsed)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *own, feature(data, parsed, payload)
    except (ValueError, IndexError, struct.error):
        return None, None, None, *own, None


def features(media: DataFrame) -> DataFrame:
    """What a media table holds, from its stored bytes: the payload's length and checksums, the file's, and the features. A null file has null for
    all of them; one that cannot be parsed, cut short or not of this format, has its own length and checksum and null for the rest."""

    def read(batches):
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for b in sliced(batches):
            rows = [described(data) for data in b.column("media").to_pylist()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *columns], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    bounded_batches(media.sparkSession)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(read, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
