import hashlib
import random
import struct
import zlib

import pytest

from rivulet.llm import media, queries


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4096, 4097, 300_001])
def test_round_trip(n):
    data = bytes(i % 251 for i in range(n))
    blob = media.pack(data)
    (track,) = media.parse(blob)
    assert media.samples(blob, track) == media.padded(data)
    assert (track.codec, track.handler, track.duration, track.times.tolist()) == ("raw ", "soun", len(media.padded(data)), [[len(media.padded(data)) // 64, 64]])
    frames = media.keyframes(track)
    assert len(frames) == -(-len(media.padded(data)) // 4096)
    first = int(frames[0][0])
    assert blob[first : first + 64] == media.padded(data)[:64] and media.pack(data) == blob


def test_other_layouts():
    """Sizes of their own, 64-bit offsets, no sync table, media before the index, boxes to the end of the file."""
    samples = [b"aa", b"bbb", b"c", b"dddd"]
    ftyp, mdat = media.box(b"ftyp", b"isom"), media.box(b"mdat", b"aabbb", b"..", b"cdddd")
    at = len(ftyp) + 8
    stbl = media.box(
        b"stbl",
        media.full(b"stsd", struct.pack(">I", 1), media.box(b"avc1", bytes(8))),
        media.full(b"stts", struct.pack(">5I", 2, 3, 10, 1, 20)),
        media.full(b"stsc", struct.pack(">4I", 1, 1, 2, 1)),
        media.full(b"stsz", struct.pack(">6I", 0, 4, 2, 3, 1, 4)),
        media.full(b"co64", struct.pack(">IQQ", 2, at, at + 7)),
    )
    mdhd = media.full(b"mdhd", struct.pack(">QQIQ", 0, 0, 1000, 50), bytes(4), version=1)
    moov = media.box(b"moov", media.box(b"trak", media.box(b"mdia", mdhd, media.full(b"hdlr", bytes(4), b"vide", bytes(13)), media.box(b"minf", stbl))))
    blob = ftyp + mdat + moov + struct.pack(">I4s", 0, b"free") + b"to the end"
    (track,) = media.parse(blob)
    assert media.samples(blob, track) == b"".join(samples)
    assert (track.codec, track.handler, track.timescale, track.duration, track.times.tolist()) == ("avc1", "vide", 1000, 50, [[3, 10], [1, 20]])
    assert media.keyframes(track).tolist() == [[at, 5], [at + 7, 5]]


def test_malformed(spark):
    good = media.pack(b"x" * 100)
    bad = [None, b"", b"abc", good[:50], good[:200], good[:-10], good.replace(b"stsz", b"xxxx"), b"\x00\x00\x00\x04ftyp"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate([good, *bad])], "doc_id long, media binary")
    rows = {r.doc_id: r for r in media.probe_media(df, keep=("doc_id",)).collect()}
    assert rows[0].error is None and rows[0].tracks[0].codec == "raw "
    assert all(rows[i].error and rows[i].tracks is None for i in range(1, len(bad) + 1))


def nested(n):
    out = b""
    for _ in range(n):
        out = media.box(b"moov", out)
    return out


def trak(number, kind, *tables, codec=b"avc1", handler=b"vide"):
    tkhd = media.full(b"tkhd", struct.pack(">IIII", 0, 0, number, 0), bytes(60))
    mdhd = media.full(b"mdhd", struct.pack(">IIII", 0, 0, 600, kind), bytes(4))
    stbl = media.box(b"stbl", media.full(b"stsd", struct.pack(">I", 1), media.box(codec, bytes(8))), *tables)
    return media.box(b"trak", tkhd, media.box(b"mdia", mdhd, media.full(b"hdlr", bytes(4), handler, bytes(13)), media.box(b"minf", stbl)))


def table(name, *numbers):
    return media.full(name, struct.pack(f">{len(numbers)}I", *numbers))


def one_chunk(at, sizes, *more):
    return [table(b"stts", 1, len(sizes), 10), table(b"stsc", 1, 1, len(sizes), 1), table(b"stsz", 0, len(sizes), *sizes), table(b"stco", 1, at), *more]


def test_two_tracks():
    data = bytes(range(40))
    blob = media.box(b"mdat", data) + media.box(b"moov", trak(1, 40, *one_chunk(8, [4, 6, 10], table(b"stss", 2, 1, 3))), trak(2, 20, *one_chunk(28, [8, 12]), codec=b"mp4a", handler=b"soun"))
    video, sound = media.parse(blob)
    assert (video.id, video.codec, video.handler, video.duration) == (1, "avc1", "vide", 40)
    assert (sound.id, sound.codec, sound.handler, sound.duration) == (2, "mp4a", "soun", 20)
    assert media.keyframes(video).tolist() == [[8, 4], [18, 10]] and media.keyframes(sound).tolist() == [[28, 20]]
    assert media.samples(blob, video) == data[:20] and media.samples(blob, sound) == data[20:]


def test_compact_sizes():
    for bits, packed in ((4, b"\x34\x50"), (8, b"\x03\x04\x05"), (16, b"\0\x03\0\x04\0\x05")):
        stz2 = media.full(b"stz2", struct.pack(">II", bits, 3), packed)
        blob = media.box(b"mdat", b"aaabbbbccccc") + media.box(b"moov", trak(1, 9, table(b"stsc", 1, 1, 3, 1), stz2, table(b"stco", 1, 8)))
        assert media.parse(blob)[0].sizes.tolist() == [3, 4, 5]


def test_fragments():
    """Samples of two fragments: defaults of the movie, of the fragment, and a row for each; a run that goes on where the last ended."""
    empty = [table(b"stts", 0), table(b"stsc", 0), table(b"stsz", 0, 0), table(b"stco", 0)]
    moov = media.box(b"moov", trak(7, 0, *empty), media.box(b"mvex", table(b"trex", 7, 1, 5, 4, 0x10000)))

    def moof(at):
        first = media.full(b"trun", struct.pack(">IiI", 2, at, 0), flags=5)  # an own first flag: a keyframe
        second = media.full(b"trun", struct.pack(">I", 2), struct.pack(">6I", 9, 3, 0, 8, 5, 0x10000), flags=0x700)
        return media.box(b"moof", table(b"mfhd", 1), media.box(b"traf", media.full(b"tfhd", struct.pack(">I", 7), flags=0x20000), first, second))

    size = len(moof(0))
    blob = moov + moof(size + 8) + media.box(b"mdat", b"0123456789abcdef") + moof(size + 8) + media.box(b"mdat", b"ABCDEFGHIJKLMNOP")
    (track,) = media.parse(blob)
    begin = [len(moov) + size + 8, len(moov) + 2 * size + 32]
    assert track.sizes.tolist() == [4, 4, 3, 5] * 2 and track.duration == 2 * (5 + 5 + 9 + 8)
    assert media.samples(blob, track) == b"0123456789abcdefABCDEFGHIJKLMNOP"
    assert media.keyframes(track).tolist() == [[begin[0], 4], [begin[0] + 8, 3], [begin[1], 4], [begin[1] + 8, 3]]


def test_hostile_files(spark):
    moov = lambda *tables: media.box(b"mdat", bytes(40)) + media.box(b"moov", trak(1, 9, *tables))
    ok = one_chunk(8, [4, 6])
    huge = 0xFFFFFFFF
    bad = [
        nested(1500),
        moov(table(b"stts", huge, 1, 1), *ok[1:]),
        moov(ok[0], table(b"stsc", 1, 1, huge, 1), *ok[2:]),
        moov(ok[0], table(b"stsc", 1, 0, 2, 1), *ok[2:]),
        moov(ok[0], table(b"stsc", 2, 2, 2, 1, 1, 2, 1), *ok[2:]),
        moov(*ok[:2], table(b"stsz", 1, huge), ok[3]),
        moov(*ok[:2], table(b"stsz", 0, huge), ok[3]),
        moov(*ok[:3], table(b"stco", 1, huge)),
        moov(*ok[:3], media.full(b"co64", struct.pack(">IQ", 1, 1 << 63))),
        moov(*ok, table(b"stss", 1, 3)),
        moov(table(b"stsc", 1, 1, 30, 1), table(b"stsz", 0, 30, *[39] * 30), table(b"stco", 30, *[8] * 30)),
        moov(*ok) + media.box(b"moof", media.box(b"traf", table(b"trun", huge))),
        moov(*ok) + media.box(b"moof", media.box(b"traf", table(b"tfhd", 1), media.full(b"trun", struct.pack(">I", huge)))),
    ]
    fine = moov(table(b"stts", 1, huge, huge), *ok[1:])  # one run, however many samples it tells of
    df = spark.createDataFrame(list(enumerate([fine, *bad])), "doc_id long, media binary")
    rows = {r.doc_id: r for r in media.probe_media(df, keep=("doc_id",)).collect()}
    assert rows[0].error is None
    assert [i for i in range(1, len(bad) + 1) if not rows[i].error or rows[i].tracks] == []


def test_damaged_bytes_end_in_an_error_or_an_index():
    rng = random.Random(9)
    files = [media.pack(b"x" * 700), media.box(b"mdat", bytes(40)) + media.box(b"moov", trak(1, 40, *one_chunk(8, [4, 6], table(b"stss", 1, 1))))]
    for k in range(4000):
        blob = bytearray(files[k % 2])
        for _ in range(rng.randint(1, 4)):
            blob[rng.randrange(len(blob))] = rng.choice([0, 1, 0x7F, 0x80, 0xFF, rng.randrange(256)])
        try:
            for t in media.parse(bytes(blob)):
                media.keyframes(t)
                assert len(media.samples(bytes(blob), t)) == t.sizes.sum()
        except (ValueError, struct.error, IndexError, OverflowError):
            pass


def test_op3(spark, odd, empty, data):
    got = media.probe_media(media.store_media(odd)).collect()
    want = sorted((repr(r.doc_id), len((r.text or "").encode()), hashlib.sha256(media.padded((r.text or "").encode())).hexdigest()) for r in odd.collect())
    assert sorted((repr(r.doc_id), r.n_bytes, r.payload_sha256) for r in got) == want
    assert media.probe_media(media.store_media(empty)).count() == 0
    rows = {r.doc_id: r for r in queries.QUERIES["op3_media_columns"](spark, data).collect()}
    stored = {r.doc_id: bytes(r.media) for r in media.store_media(spark.read.parquet(f"{data}/documents.parquet")).collect()}
    for d in spark.read.parquet(f"{data}/documents.parquet").collect():
        raw, r, blob = d.text.encode(), rows[d.doc_id], stored[d.doc_id]
        p = raw + bytes(-len(raw) % 64 if raw else 64)
        first, kept = mdat(blob)
        assert kept == p
        frames = [(first + k, 64) for k in range(0, len(p), 4096)]
        assert [tuple(k) for k in r.keyframes] == frames
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(blob), hashlib.sha256(blob).hexdigest())
        ranges = hashlib.md5(",".join(f"{a}+{n}" for a, n in frames).encode()).hexdigest()
        assert r.feature == f"raw ;soun;8000;{len(p)};{len(p) // 64};{len(frames)};{ranges}"


def mdat(blob):
    """(where the body of the box mdat begins, its bytes), by a plain walk over the outermost boxes."""
    at = 0
    while at < len(blob):
        size, kind = struct.unpack_from(">I4s", blob, at)
        if kind == b"mdat":
            return at + 8, blob[at + 8 : at + size]
        at += size
    return None
