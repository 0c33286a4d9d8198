"""Tokenizing, token files, packing and prefix counts against the tokenizers' libraries."""

import itertools
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivulet.llm import near_duplicates, packing, queries, token_counts, token_files, words

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ALPHABET = [*"abc AB  \n\t'sStdmrevl.,!<|%12 éÉñüßÀ’—€ªº²  \u0085​▁", "'s", "'ve", "'ll", " 's", "日本", "İ", "é", "K", "<|endoftext|>", "ſ", "Ω", "\x00", "<s>", "</s>", "the", "ing"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize(("path", "cut"), [(BYTE, "byte"), (WORD, "word")])
def test_encoder_equals_library(path, cut, monkeypatch):
    enc, library = words.Encoder(path, cut), Tokenizer.from_file(path)
    some = [*texts(3000, 1), "a" * 3000, " " * 700, "", "word " * 5000]
    monkeypatch.setattr(words, "MOST_WORDS", 300)  # the memo is emptied now and then
    got = [x for k in range(0, len(some), 200) for x in enc.encode(some[k : k + 200])]
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in some]
    assert enc.encode([]) == []


def test_prefix_counts_equal_library():
    c, library = token_counts.PrefixCounter(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    some = texts(400, 2)
    for t, d in zip(some, c.count(some), strict=True):
        counts = token_counts.counts(d.tobytes())
        assert counts.tolist() == [len(library.encode(t[:i])) for i in range(len(t) + 1)]
        for budget in (0, 3, 1000):
            n = token_counts.longest_prefix(d.tobytes(), budget)
            assert counts[n] <= budget and (counts[n + 1 :] > budget).all()


def test_a_model_that_normalizes_is_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "normalize", lambda self, text: text.lower())
    with pytest.raises(ValueError, match="changes texts"):
        token_counts.PrefixCounter(PIECE)


def by_row(frame, columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def test_op8(spark, odd, empty, data):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    found = token_counts.answer_budgets(token_counts.prefix_counts(odd, PIECE), 4096)
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in odd.collect()]
    assert by_row(found, ["doc_id", "n_bytes", "n_tokens"]) == sorted(want, key=repr)
    assert token_counts.answer_budgets(token_counts.prefix_counts(empty, PIECE), 1).count() == 0
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.QUERIES["op8_token_counts"](spark, data).collect()}
    for d in docs:
        n = len(library.encode(d.text or ""))
        assert (rows[d.doc_id].n_tokens, rows[d.doc_id].over_limit) == (n, n > 4096)


@pytest.mark.parametrize("ids", [[1] * 101, [1, 1, 2] * 50, [5], [7, 7], list(range(300)) * 9, [3, 4] * 400 + [4, 3] * 400, [70_000, 99_999, 70_000] * 70])
def test_repair_round_trip(ids):
    a = np.array(ids, dtype=np.uint32)
    blob = token_files.write_file([None, 4], [a, a[::-1].copy()], 100_000)
    f = token_files.TokenFile(blob)
    assert f.doc_ids == [None, 4] and (f.document(0) == a).all() and (f.document(1) == a[::-1]).all()
    assert [x.tolist() for x in f.documents()] == [a.tolist(), a[::-1].tolist()]
    assert (f.lengths == f.grammar.lengths).all() and all(n >= 2 for n in f.lengths)
    if len(ids) > 100 and len(set(ids)) < 50:
        assert f.n_symbols < len(ids) / 4
    rng = random.Random(3)
    for _ in range(60):
        x, y = rng.randint(0, len(a)), rng.randint(0, len(a) + 5)
        assert (f.window(0, x, y) == a[x:y]).all()
    with pytest.raises(ValueError, match="damaged"):
        token_files.TokenFile(blob[:-1] + bytes([blob[-1] ^ 1]))
    with pytest.raises(ValueError, match="not below"):
        token_files.write_file([1], [a], int(a.max()))


def test_repair_runs_until_no_pair_is_frequent():
    rng = np.random.default_rng(5)
    docs = [rng.zipf(1.3, 3000).clip(max=400).astype(np.uint16) for _ in range(20)]
    _, symbols, last = token_files.repair(np.concatenate(docs), np.cumsum([len(d) for d in docs]) - 1, 401)
    pairs = Counter()
    for own in np.split(symbols, last[:-1] + 1):
        for run in [list(g) for _, g in itertools.groupby(zip(own[:-1].tolist(), own[1:].tolist(), strict=True))]:
            pairs[run[0]] += (len(run) + 1) // 2 if run[0][0] == run[0][1] else len(run)
    assert max(pairs.values()) < token_files.LEAST_COUNT and len(symbols) < 40_000


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_packed_bits(bits):
    x = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    for n in (0, 1, 2, 63, 64, 65, 1000):
        raw = token_files.pack_bits(x[:n], bits)
        packed = np.frombuffer(raw, dtype="<u8")
        assert len(raw) == token_files.packed_bytes(n, bits)
        assert (token_files.unpack_bits(packed, 0, n, bits) == x[:n]).all()
        assert (token_files.unpack_bits(packed, n // 3, n // 2, bits) == x[n // 3 : n // 2]).all()


def test_files_of_another_vocabulary(spark, odd):
    """Ids up to 50,256, more than the 49,408 of the query's vocabulary, and an end id beyond 16 bits."""
    library = Tokenizer.from_file(BYTE)
    rare = spark.createDataFrame([(i, library.decode([50_000 + i, 50_255 - i] * 3)) for i in range(40)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(rare)
    for end in (50_256, 70_000):
        files = token_files.with_starts(token_files.write_token_files(docs, BYTE, "byte", end, rows_per_bucket=16))
        got = token_files.read_token_files(files).collect()
        crc = lambda t, end=end: zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, end], dtype="<u4").tobytes())
        assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == sorted((str(r.doc_id), crc(r.text)) for r in docs.collect())


def test_op2(spark, odd, empty, data):
    library = Tokenizer.from_file(WORD)
    files = token_files.with_starts(token_files.write_token_files(odd, WORD, shard_ids=5000, rows_per_bucket=3))
    got = sorted(token_files.read_token_files(files).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])[:-1]].tolist()
    ids = [-(1 << 62) if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    crc = lambda t: zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes())
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == sorted((str(r.doc_id), crc(r.text)) for r in odd.collect())
    assert token_files.read_token_files(token_files.with_starts(token_files.write_token_files(empty, WORD))).count() == 0
    at = 0
    rows = {r.doc_id: r for r in queries.QUERIES["op2_token_files"](spark, data).collect()}
    for d in spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect():
        n = len(library.encode(d.text or "", add_special_tokens=False).ids) + 1
        assert (rows[d.doc_id].start, rows[d.doc_id].n_tokens, rows[d.doc_id].ids_crc32) == (at, n, crc(d.text))
        at += n


def test_buckets_ascend_and_split_a_hot_id(make_docs):
    import pyarrow as pa

    from rivulet.llm.common import Buckets, bucket_bounds

    rows = [(None, "n")] * 90 + [(i, "x") for i in range(100)] + [(50, f"text {k}") for k in range(200)] + [(70, "equal")] * 200
    bounds = bucket_bounds(make_docs(rows), "doc_id", 20)
    found = Buckets(bounds).of(pa.array([i for i, _ in rows], pa.int64()), [t for _, t in rows])
    ids = {}
    for b, (i, _) in zip(found.tolist(), rows, strict=True):
        ids.setdefault(b, []).append(-1 if i is None else i)
    assert all(max(ids[a]) <= min(ids[b]) for a, b in zip(sorted(ids), sorted(ids)[1:], strict=False))
    assert max(ids) <= len(bounds) and max(map(len, ids.values())) < 60


def test_a_million_rows_without_id_are_dealt_evenly(spark):
    rows = spark.range(1_000_000).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, "one text").otherwise(F.col("id").cast("string")).alias("text"))
    dealt = packing.tokenized(rows, BYTE, "byte", 0, 20_000).groupBy("bucket").count().collect()
    assert len(dealt) >= 48 and sum(r["count"] for r in dealt) == 1_000_000 and max(r["count"] for r in dealt) < 40_000


def test_bounds_of_a_sample(spark, monkeypatch):
    from rivulet.llm import common

    monkeypatch.setattr(common, "BOUND_SAMPLE", 2000)
    bounds = common.bucket_bounds(spark.range(50_000).withColumnRenamed("id", "doc_id"), "doc_id", 5000)
    assert len(bounds) == 9 and all(abs(b - 5000 * (i + 1)) < 4000 for i, b in enumerate(bounds.tolist()))


def brute(position, penalty, size):
    f = [0] + [10**9] * (len(position) - 1)
    for j in range(1, len(position)):
        f[j] = min(f[i] + size - (position[j] - position[i]) + penalty[j] for i in range(j) if position[j] - position[i] <= size)
    return f[-1]


def test_cuts_are_optimal():
    rng = random.Random(4)
    for _ in range(200):
        size = rng.randint(3, 30)
        position = np.cumsum([0] + [rng.randint(1, size) for _ in range(rng.randint(1, 25))])
        penalty = np.array([rng.choice([0, 2, 9]) for _ in position])
        found = [0, *packing.cuts(position, penalty, size)]
        gaps = np.diff(position[found])
        assert (gaps <= size).all() and found[-1] == len(position) - 1
        assert (size - gaps).sum() + penalty[found[1:]].sum() == brute(position.tolist(), penalty.tolist(), size)


def check_pieces(pieces, ids_of):
    """Each id in one piece, sequences full without gaps; returns the share of tokens in all windows."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids_of)
    for doc, own in by_doc.items():
        at, ids = 0, ids_of[doc]
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], dtype="<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    return sum(p.length for p in pieces) / 1024 / len(by_sequence)


def test_op7(spark, odd, empty, data, make_docs, monkeypatch):
    library = Tokenizer.from_file(BYTE)
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 0]
    once = odd.where("doc_id is null or doc_id <> 4")
    check_pieces(packing.pack_documents(once, BYTE, rows_per_bucket=4).collect(), {r.doc_id: ids(r.text) for r in once.collect()})
    repeated = packing.pack_documents(odd, BYTE).collect()
    assert sum(p.length for p in repeated) == sum(len(ids(r.text)) for r in odd.collect())
    assert packing.pack_documents(empty, BYTE).count() == 0
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    fill = check_pieces(queries.QUERIES["op7_packing"](spark, data).collect(), {r.doc_id: ids(r.text) for r in docs})
    assert fill > 0.95


def test_packer_carries_over_blocks(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 3000)
    rng = np.random.default_rng(1)
    ends = np.zeros(1 << 16, dtype=bool)
    ends[:30] = True
    docs = [(i, rng.integers(0, 500, rng.integers(1, 6000)).astype(np.uint16)) for i in range(40)]
    packer, rows = packing.Packer(ends), []
    for i, x in docs:
        rows += packer.add(i, x)
    rows += packer.pack(last=True)

    class P:
        def __init__(self, r):
            self.doc_id, self.start, self.length, self.ids_crc32, self.doc_tokens, self.sequence_id, self.offset = r

    assert check_pieces([P(r) for r in rows], {i: x.tolist() for i, x in docs}) > 0.9


def test_the_memo_is_bounded_by_bytes_too(monkeypatch):
    monkeypatch.setattr(words, "MOST_BYTES", 4000)
    asked = []
    memo = words.Memo(lambda w: asked.append(w) or [len(w)], "<u4")

    def ask(*found):
        chars = np.frombuffer(" ".join(found).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        size = np.array([len(w) for w in found])
        start = np.cumsum(size + 1) - size - 1
        values, count = memo.values(chars, start, start + size)
        assert values.tolist() == size.tolist() and set(count.tolist()) == {1}

    ask("a", "bb", "a", "\ud800", "\U0001f600x", "bb")
    ask("bb", "a", "ccc")
    assert asked == ["a", "bb", "\ud800", "\U0001f600x", "ccc"]
    ask("x" * 2000, "a")
    assert memo.held > 4000 and asked[5:] == ["x" * 2000]
    ask("a", "x" * 300)
    assert memo.held < 4000 and asked[6:] == ["a", "x" * 300]


def test_the_memo_keeps_common_words(monkeypatch):
    monkeypatch.setattr(words, "MOST_WORDS", 40)
    asked = []
    memo = words.Memo(lambda w: asked.append(w) or [len(w)] * (len(w) % 3), "<u2")
    for batch in range(200):
        found = ["the", "word", "again", *(f"rare{'x' * (batch % 5)}{batch}n{k}" for k in range(6))]
        chars = np.frombuffer(" ".join(found).encode("latin-1"), dtype=np.uint8)
        size = np.array([len(w) for w in found])
        start = np.cumsum(size + 1) - size - 1
        values, count = memo.values(chars, start, start + size)
        assert values.tolist() == [len(w) for w in found for _ in range(len(w) % 3)] and count.tolist() == [len(w) % 3 for w in found]
        assert len(memo.index) <= 40 + 9 and memo.held == 4 * sum(map(len, memo.index)) + 2 * int(memo.offset[len(memo.index)])
    assert len(asked) == len(set(asked)) == 3 + 200 * 6


def test_rounds_that_replace_few_symbols(monkeypatch):
    rng = np.random.default_rng(4)
    ids, last = rng.zipf(1.3, 30_000).clip(max=700).astype(np.uint32), np.unique(np.r_[rng.integers(0, 30_000, 500), 29_999])
    ids[5_000:9_000] = 3
    found = []
    for few in (0, 3, 16, 1 << 40):  # from the first round on symbols stay at their places; never
        monkeypatch.setattr(token_files, "FEW", few)
        found.append(token_files.repair(ids, last, 1000))
        assert all((a == b).all() for a, b in zip(found[0], found[-1], strict=True))
        rules, symbols, ends = found[-1]
        flat = token_files.Grammar(rules, 1000)
        assert flat.expand(symbols).tolist() == ids.tolist()
        assert (np.cumsum([len(flat.expand(s)) for s in np.split(symbols, ends[:-1] + 1)]) - 1 == last).all()


def test_pairs_that_share_a_mark_and_rules_by_levels(monkeypatch):
    rng = np.random.default_rng(3)
    ids, last = rng.zipf(1.3, 60_000).clip(max=900).astype(np.uint32), np.arange(99, 60_000, 100)
    wide = token_files.repair(ids, last, 1000)
    looked, real = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *k, **n: looked.append(np.size(v)) or real(a, v, *k, **n))
    assert all((a == b).all() for a, b in zip(wide, token_files.repair(ids, last, 1000), strict=True))
    assert sum(looked) < 20_000  # only pairs that share a mark are looked for, not every place
    monkeypatch.undo()
    monkeypatch.setattr(token_files, "MARK_BITS", 5)
    assert all((a == b).all() for a, b in zip(wide, token_files.repair(ids, last, 1000), strict=True))
    deep, long = token_files.depths(wide[0], 1000)
    for k, (a, b) in enumerate(wide[0].tolist()):
        assert deep[k] == 1 + max(deep[s - 1000] if s >= 1000 else 0 for s in (a, b)) and long[k] == sum(long[s - 1000] if s >= 1000 else 1 for s in (a, b))
    assert [x.tolist() for x in token_files.depths(np.zeros((0, 2), dtype=np.uint32), 5)] == [[], []]
    with pytest.raises(ValueError, match="later"):
        token_files.depths(np.array([[1, 6], [1, 2]], dtype=np.uint32), 5)


def test_other_operators_drop_the_tokenizers_of_a_worker(spark):
    class Rows:
        """Gives back the function that its rows would be mapped by."""

        sparkSession = spark
        select = repartition = sortWithinPartitions = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    for run in (near_duplicates.sign(Rows()), near_duplicates.compared(Rows(), 0.8)):
        words.encoder(BYTE, "byte").encode(["some words"])
        token_counts.counter(PIECE)
        assert list(run(iter(()))) == []
        assert not words.ENCODERS and not token_counts.COUNTERS
    assert words.encoder(BYTE, "byte").encode(["some words"])[0].tolist() == Tokenizer.from_file(BYTE).encode("some words").ids


@pytest.mark.parametrize(("name", "cut"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_encoding_takes_little_memory(name, cut):
    """Of texts without code points beyond 255, which take a byte each, at most 40 bytes of arrays a character."""
    enc = words.Encoder(public_tokenizers.path(name), cut)
    texts = [" ".join(f"Wörter{k % 97} und {k % 89}, l'été" for k in range(2000)) for _ in range(20)]
    assert words.code_points(texts)[0].itemsize == 1 and words.code_points(["a", "日"])[0].itemsize == 4
    found = enc.encode(texts)
    tracemalloc.start()
    try:
        enc.encode(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 * sum(map(len, texts))
    # The same texts beside one with wide characters are encoded alike.
    assert all((a == b).all() for a, b in zip(enc.encode([*texts, "日本"]), found, strict=False))


@pytest.mark.parametrize(("path", "cut"), [(BYTE, "byte"), (WORD, "word")])
def test_one_byte_texts_are_encoded_as_by_the_library(path, cut):
    enc, library, rng = words.Encoder(path, cut), Tokenizer.from_file(path), random.Random(3)
    letters = [c for c in ALPHABET if all(ord(x) < 256 for x in c)] + [chr(c) for c in range(128, 256)]
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert words.code_points(some)[0].itemsize == 1
    assert [g.tolist() for g in enc.encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]
