"""ISO media containers: write payloads as samples, walk boxes, index keyframes.

``pack`` stores bytes as a track of raw 8-bit audio (``raw ``), 64 bytes a
sample, 64 samples a chunk, the first of each chunk a sync sample.  ``probe_media``
reads any such file by its box structure: it walks nested boxes, decodes the
sample tables (stts, stsc, stsz or stz2, stco or co64, stss) and those of movie
fragments (trex, tfhd, trun) and returns codec, duration and the byte ranges of
keyframes of every track.  It never decodes a payload.

Cases: a null text is an empty one, and an empty text one unit of zero bytes;
a media value that is null or not a well-formed container has no tracks and says
why in ``error``, and so does one whose boxes nest too deep, or whose tables tell of
more samples than the file has bytes or of samples outside it (no count is trusted
before memory is taken for it); external data references are not followed; repeated rows give repeated results, equal texts equal
files; an empty table an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, slices, table, text_or_empty

UNIT = 64
SAMPLES_PER_CHUNK = 64
TIMESCALE = 8000
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"mvex", b"moof", b"traf", b"udta"}


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


MATRIX = struct.pack(">9I", 1 << 16, 0, 0, 0, 1 << 16, 0, 0, 0, 1 << 30)


def padded(payload: bytes) -> bytes:
    """Zero bytes up to a positive multiple of the unit."""
    return payload + bytes(-len(payload) % UNIT if payload else UNIT)


def pack(payload: bytes) -> bytes:
    """A container of the padded payload; equal payloads give equal bytes."""
    data = padded(payload)
    samples = len(data) // UNIT
    chunks = -(-samples // SAMPLES_PER_CHUNK)
    duration = len(data)
    wide = duration >= 1 << 31
    last = samples - (chunks - 1) * SAMPLES_PER_CHUNK
    runs = [(1, SAMPLES_PER_CHUNK)] if chunks > 1 or last == SAMPLES_PER_CHUNK else []
    if last != SAMPLES_PER_CHUNK:
        runs.append((chunks, last))
    starts = np.arange(chunks, dtype=np.int64)
    time = struct.pack(">QQIQ" if wide else ">IIII", 0, 0, TIMESCALE, duration)
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, TIMESCALE << 16))
    ftyp = box(b"ftyp", b"qt  ", struct.pack(">I", 0), b"qt  ", b"isom")

    def moov(first: int) -> bytes:
        offsets = first + starts * (SAMPLES_PER_CHUNK * UNIT)
        places = full(b"co64", struct.pack(">I", chunks), offsets.astype(">u8").tobytes()) if wide else full(b"stco", struct.pack(">I", chunks), offsets.astype(">u4").tobytes())
        stbl = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">III", 1, samples, UNIT)),
            full(b"stss", struct.pack(">I", chunks), (starts * SAMPLES_PER_CHUNK + 1).astype(">u4").tobytes()),
            full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", a, b, 1) for a, b in runs)),
            full(b"stsz", struct.pack(">II", UNIT, samples)),
            places,
        )
        dinf = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
        mdia = box(b"mdia", full(b"mdhd", time, struct.pack(">HH", 0x55C4, 0), version=wide), full(b"hdlr", bytes(4), b"soun", bytes(13)), box(b"minf", full(b"smhd", bytes(4)), dinf, stbl))
        shown = struct.pack(">QQIIQ" if wide else ">IIIII", 0, 0, 1, 0, duration)
        tkhd = full(b"tkhd", shown, bytes(8), struct.pack(">hhhH", 0, 0, 0x100, 0), MATRIX, bytes(8), version=wide, flags=3)
        mvhd = full(b"mvhd", time, struct.pack(">IH", 1 << 16, 0x100), bytes(10), MATRIX, bytes(24), struct.pack(">I", 2), version=wide)
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    head = 16 if len(data) + 8 >= 1 << 32 else 8
    first = len(ftyp) + len(moov(0)) + head
    return ftyp + moov(first) + box(b"mdat", data)


@dataclass
class Track:
    """One track: ``sizes``, ``offsets`` and ``sync`` (numbers of the sync samples; None: all) of its samples; ``times`` are runs of (samples, duration)."""

    id: int = 0
    codec: str = ""
    handler: str = ""
    timescale: int = 0
    duration: int = 0
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    sync: np.ndarray | None = None
    times: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), dtype=np.int64))


#: Boxes that hold boxes nest this deep at most; standard files need nine levels.
MOST_DEPTH = 32


def walk(data: memoryview) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    """(path, first byte of the box, first of its body, end) of each box, parents before children."""
    open_boxes: list[tuple[tuple[bytes, ...], int, int]] = [((), 0, len(data))]  # path, next child, end
    while open_boxes:
        path, start, end = open_boxes.pop()
        if start >= end:
            continue
        if end - start < 8:
            raise ValueError("bytes after the last box")
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if end - start < 16:
                raise ValueError("box header is cut off")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError(f"box {kind!r} leaves its parent")
        here = (*path, kind)
        yield here, start, start + head, start + size
        open_boxes.append((path, start + size, end))
        if kind in CONTAINERS:
            if len(here) >= MOST_DEPTH:
                raise ValueError("boxes are nested too deep")
            open_boxes.append((here, start + head, start + size))


class Fields:
    """Reads big-endian numbers of a box one after the other, never beyond its end."""

    def __init__(self, data: memoryview, at: int, end: int) -> None:
        self.data, self.at, self.end = data, at, end

    def many(self, kind: str, n: int) -> np.ndarray:
        size = n * np.dtype(kind).itemsize
        if self.at + size > self.end:
            raise ValueError("a table is cut off")
        out = np.frombuffer(self.data, kind, n, self.at)
        self.at += size
        if kind == ">u8" and n and out.max() >= 1 << 63:
            raise ValueError("a number is too large")
        return out.astype(np.int64)

    def u32(self) -> int:
        return int(self.many(">u4", 1)[0])

    def u64(self) -> int:
        return int(self.many(">u8", 1)[0])


def equal_sizes(n: int, each: int, total: int) -> np.ndarray:
    """Sizes of n samples of one size, if a file of ``total`` bytes can hold them."""
    if n * max(each, 1) > total:
        raise ValueError("more samples than bytes")
    return np.full(n, each, dtype=np.int64)


def check_range(offsets: np.ndarray, sizes: np.ndarray, total: int) -> None:
    if int(sizes.sum()) > total:
        raise ValueError("samples are longer than the file")
    if len(sizes) and (int(offsets.min()) < 0 or int(offsets.max()) > total or int((offsets + sizes).max()) > total):
        raise ValueError("a sample is outside the file")


def place_samples(track: Track, tables: dict[bytes, np.ndarray], total: int) -> None:
    """Sizes, offsets and sync samples of a track from its sample tables."""
    if not all(k in tables for k in (b"stsz", b"stco", b"stsc")):
        raise ValueError("a track has no sample table")
    sizes, chunks, runs = tables[b"stsz"], tables[b"stco"], tables[b"stsc"].reshape(-1, 3)
    n, first = len(sizes), runs[:, 0]
    if len(runs) and (first[0] != 1 or (np.diff(first) <= 0).any()):
        raise ValueError("runs of chunks are out of order")
    # The samples of each chunk: those of the last run that begins at it or before.
    per = runs[np.searchsorted(first, np.arange(1, len(chunks) + 1), side="right") - 1, 1] if len(runs) and len(chunks) else np.zeros(len(chunks), dtype=np.int64)
    if (per > n).any() or per.sum() != n:
        raise ValueError("chunks and samples disagree")
    begin = np.cumsum(per) - per
    lead = np.cumsum(sizes) - sizes
    in_chunk = np.repeat(np.arange(len(chunks)), per)
    track.sizes, track.offsets = sizes, chunks[in_chunk] + lead - lead[np.minimum(begin, max(n - 1, 0))][in_chunk] if n else lead
    check_range(track.offsets, sizes, total)
    track.times = tables.get(b"stts", np.zeros(0, dtype=np.int64)).reshape(-1, 2)
    if b"stss" in tables:
        track.sync = tables[b"stss"] - 1
        if len(track.sync) and (track.sync.min() < 0 or track.sync.max() >= n):
            raise ValueError("a sync sample is no sample")


class Fragments:
    """Samples of movie fragments, run by run."""

    NOT_SYNC = 0x10000

    def __init__(self, total: int) -> None:
        self.total = total
        self.defaults: dict[int, tuple[int, int, int]] = {}  # of each track: duration, size, flags
        self.runs: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.samples = 0

    def trex(self, f: Fields) -> None:
        f.u32()
        track, _, duration, size, flags = (f.u32() for _ in range(5))
        self.defaults[track] = (duration, size, flags)

    def tfhd(self, f: Fields, moof: int) -> None:
        flags, self.track = f.u32() & 0xFFFFFF, f.u32()
        self.moof = moof
        duration, size, sample_flags = self.defaults.get(self.track, (0, 0, 0))
        self.base = f.u64() if flags & 1 else moof
        if flags & 2:
            f.u32()
        self.duration = f.u32() if flags & 8 else duration
        self.size = f.u32() if flags & 0x10 else size
        self.flags = f.u32() if flags & 0x20 else sample_flags
        self.next = self.base

    def trun(self, f: Fields) -> None:
        flags, n = f.u32() & 0xFFFFFF, f.u32()
        start = self.base + int(np.int32(np.uint32(f.u32()))) if flags & 1 else self.next
        first = f.u32() if flags & 4 else None
        columns = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
        if not columns:
            equal_sizes(n, self.size, self.total)
        each = f.many(">u4", n * len(columns)).reshape(n, -1) if columns else np.zeros((n, 0), dtype=np.int64)
        column = lambda bit, default: each[:, columns.index(bit)] if bit in columns else np.full(n, default, dtype=np.int64)
        sizes, sample_flags = column(0x200, self.size), column(0x400, self.flags)
        if first is not None and n and 0x400 not in columns:
            sample_flags[0] = first
        offsets = start + np.cumsum(sizes) - sizes
        check_range(offsets, sizes, self.total)
        self.samples += n
        if self.samples > self.total:
            raise ValueError("more samples than bytes")
        self.next = start + int(sizes.sum())
        self.runs.setdefault(self.track, []).append((sizes, offsets, (sample_flags & self.NOT_SYNC) == 0, column(0x100, self.duration)))

    def add_to(self, track: Track) -> None:
        runs = self.runs.get(track.id)
        if not runs:
            return
        sizes, offsets, sync, times = (np.concatenate(x) for x in zip(*runs, strict=True))
        n = len(track.sizes)
        before = np.arange(n) if track.sync is None else track.sync
        track.sync = None if sync.all() and len(before) == n else np.concatenate([before, n + np.flatnonzero(sync)])
        track.sizes, track.offsets = np.concatenate([track.sizes, sizes]), np.concatenate([track.offsets, offsets])
        track.times = np.concatenate([track.times, np.stack([np.ones(len(times), dtype=np.int64), times], axis=1)])
        if not track.duration:
            track.duration = int((track.times[:, 0] * track.times[:, 1]).sum())


def parse(blob: bytes) -> list[Track]:
    """The tracks of a container, those of fragments included, with sizes and file offsets of all samples."""
    data, total = memoryview(blob), len(blob)
    tracks: list[Track] = []
    tables: list[dict[bytes, np.ndarray]] = []
    fragments, moof = Fragments(total), 0
    for path, start, a, b in walk(data):
        kind, f = path[-1], Fields(data, a, b)
        inside = bool(tracks) and b"trak" in path
        if kind == b"trak":
            tracks.append(Track())
            tables.append({})
        elif kind == b"tkhd" and inside:
            wide = f.u32() >> 24
            f.many(">u4", 4 if wide else 2)
            tracks[-1].id = f.u32()
        elif kind == b"mdhd" and inside:
            wide = f.u32() >> 24
            f.many(">u4", 4 if wide else 2)
            tracks[-1].timescale, tracks[-1].duration = f.u32(), f.u64() if wide else f.u32()
        elif kind == b"hdlr" and inside and b"mdia" in path:
            f.many(">u4", 2)
            tracks[-1].handler = f.many("u1", 4).astype(np.uint8).tobytes().decode("latin-1")
        elif kind == b"stsd" and inside:
            f.u32()
            if f.u32():
                f.u32()
                tracks[-1].codec = f.many("u1", 4).astype(np.uint8).tobytes().decode("latin-1")
        elif kind in (b"stts", b"stss", b"stsc") and inside:
            f.u32()
            tables[-1][kind] = f.many(">u4", {b"stts": 2, b"stss": 1, b"stsc": 3}[kind] * f.u32())
        elif kind in (b"stco", b"co64") and inside:
            f.u32()
            tables[-1][b"stco"] = f.many(">u4" if kind == b"stco" else ">u8", f.u32())
        elif kind == b"stsz" and inside:
            f.u32()
            each, n = f.u32(), f.u32()
            tables[-1][kind] = equal_sizes(n, each, total) if each else f.many(">u4", n)
        elif kind == b"stz2" and inside:
            f.u32()
            bits, n = f.u32() & 0xFF, f.u32()
            if bits not in (4, 8, 16):
                raise ValueError("sizes of an odd number of bits")
            raw = f.many("u1", -(-n // 2)) if bits == 4 else f.many("u1" if bits == 8 else ">u2", n)
            tables[-1][b"stsz"] = np.stack([raw >> 4, raw & 15], axis=1).reshape(-1)[:n] if bits == 4 else raw
        elif kind == b"trex":
            fragments.trex(f)
        elif kind == b"moof":
            moof = start
        elif kind == b"tfhd" and b"traf" in path:
            fragments.tfhd(f, moof)
        elif kind == b"trun" and b"traf" in path:
            if not hasattr(fragments, "track"):
                raise ValueError("a run of samples has no track")
            fragments.trun(f)
    if not tracks:
        raise ValueError("no track")
    for track, found in zip(tracks, tables, strict=True):
        place_samples(track, found, total)
        fragments.add_to(track)
    return tracks


def keyframes(track: Track) -> np.ndarray:
    """Byte ranges (offset, length) of sync samples; ranges that touch are one."""
    at = np.arange(len(track.sizes)) if track.sync is None else track.sync
    if len(at) == 0:
        return np.zeros((0, 2), dtype=np.int64)
    start, size = track.offsets[at], track.sizes[at]
    new = np.r_[True, start[1:] != start[:-1] + size[:-1]]
    first = np.flatnonzero(new)
    return np.stack([start[first], np.add.reduceat(size, first)], axis=1)


def samples(blob: bytes, track: Track) -> bytes:
    """The track's bytes, put together from its sample table."""
    if len(track.sizes) == 0:
        return b""
    new = np.r_[True, track.offsets[1:] != track.offsets[:-1] + track.sizes[:-1]]
    first = np.flatnonzero(new)
    return b"".join(blob[o : o + n] for o, n in zip(track.offsets[first].tolist(), np.add.reduceat(track.sizes, first).tolist(), strict=True))


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the container of each document's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            raw = b.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([pack(x) for x in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, media binary")


TRACK = "struct<id: long, codec: string, handler: string, timescale: long, duration: long, n_samples: long, keyframes: array<struct<offset: long, length: long>>>"
DIGEST = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"


def probe_media(media: DataFrame, column: str = "media", keep: tuple[str, ...] = ("doc_id", "n_bytes"), digests: bool = True) -> DataFrame:
    """The index of each container: its tracks, or an error (and digests of the stored samples of its first track)."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.select(*keep).schema)

    def one(blob: bytes | None) -> dict:
        try:
            if blob is None:
                raise ValueError("null")
            found = parse(blob)
        except (ValueError, struct.error, IndexError, OverflowError) as e:
            return {"error": str(e) or type(e).__name__}
        out: dict = {"tracks": [{"id": t.id, "codec": t.codec, "handler": t.handler, "timescale": t.timescale, "duration": t.duration, "n_samples": len(t.sizes), "keyframes": [{"offset": a, "length": n} for a, n in keyframes(t).tolist()]} for t in found]}
        if digests:
            data = samples(blob, found[0])
            out |= {"payload_bytes": len(data), "payload_sha256": hashlib.sha256(data).hexdigest(), "tail_crc32": zlib.crc32(data[-UNIT:]), "media_bytes": len(blob), "media_sha256": hashlib.sha256(blob).hexdigest()}
        return out

    long = pa.int64()
    frame = pa.struct([("offset", long), ("length", long)])
    track = pa.struct([("id", long), ("codec", pa.string()), ("handler", pa.string()), ("timescale", long), ("duration", long), ("n_samples", long), ("keyframes", pa.list_(frame))])
    kinds = [("tracks", pa.list_(track)), ("error", pa.string())]
    if digests:
        kinds += [("payload_bytes", long), ("payload_sha256", pa.string()), ("tail_crc32", long), ("media_bytes", long), ("media_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, column):
            found = [one(x) for x in b.column(len(keep)).to_pylist()]
            cols = [pa.array([x.get(k) for x in found], kind) for k, kind in kinds]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *cols], [*keep, *(k for k, _ in kinds)])

    return media.select(*keep, column).mapInArrow(run, ", ".join([kept, f"tracks array<{TRACK}>, error string", *[DIGEST] * digests]))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = materialize(store_media(table(spark, sf_dir, "documents")), "media")
    first = F.get("tracks", F.lit(0))
    found = probe_media(media).withColumns({c: first[c] for c in ("codec", "handler", "timescale", "duration", "n_samples", "keyframes")})
    ranges = F.transform("keyframes", lambda k: F.concat_ws("+", k["offset"].cast("string"), k["length"].cast("string")))
    feature = F.concat_ws(";", "codec", "handler", "timescale", "duration", "n_samples", F.size("keyframes").cast("string"), F.md5(F.concat_ws(",", ranges)))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "codec", "duration", "n_samples", "keyframes")
