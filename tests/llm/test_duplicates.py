"""Lines, near-duplicates and benchmark leaks against brute force."""

import importlib
import itertools
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import decontamination, line_dedup, near_duplicates, queries
from rivulet.llm.shingles import shingles, units
from rivulet.operators import storage
from rivulet.operators.components import components

from .conftest import LONG, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


BLANKS = " \t\v\f\r"


def kept_lines(docs, min_chars=20, edits=1):
    """(doc_id, text) -> kept text, by comparing all lines."""
    first, order = {}, sorted({(d.doc_id is not None, d.doc_id or 0, d.text) for d in docs if d.text is not None}, key=lambda k: k[:2])
    for k in order:
        for n, line in enumerate(k[2].split("\n")):
            if line.strip(BLANKS):
                first.setdefault(line, (k, n))
    place = {line: i for i, line in enumerate(first)}
    gone = set()
    lines = [x for x in first if len(x) >= min_chars] if edits else []
    for a, b in itertools.combinations(lines, 2):
        if abs(len(a) - len(b)) <= 1 and distance(a, b) <= 1:
            gone.add(max(a, b, key=place.get))
    return {(d.doc_id, d.text): None if d.text is None else "\n".join(x for n, x in enumerate(d.text.split("\n")) if not x.strip(BLANKS) or (x not in gone and first[x] == ((d.doc_id is not None, d.doc_id or 0, d.text), n))) for d in docs}


def edited(rng, line):
    i, c = rng.randrange(len(line) + 1), rng.choice("abcé ")
    return rng.choice([line[:i] + c + line[i:], line[:i] + line[i + 1 :], line[:i] + c + line[i + 1 :]])


@pytest.mark.parametrize("block", [512, 7])
def test_lines_equal_brute_force(make_docs, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng = random.Random(block)
    pool = [prose(i, rng.randint(3, 12)) for i in range(25)] + ["aaaaaaaaaaaaaaaaaaaaaaaa", "abababababababababababab"]
    for _ in range(60):
        pool.append(edited(rng, rng.choice(pool)))
    pool += ["short", "shorx", "", "  ", "\t", " \t\r"]
    docs = make_docs([(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))) for i in range(40)])
    want = kept_lines(docs.collect())
    got = line_dedup.line_dedup(docs).collect()
    assert {(r.doc_id, r.text) for r in got} == {(i, t) for (i, _), t in want.items()}
    assert sum(r.rv_kept_ for r in got) < sum(r.rv_lines_ for r in got)
    exact = line_dedup.line_dedup(docs, max_edits=0).collect()
    assert {(r.doc_id, r.text) for r in exact} == {(i, t) for (i, _), t in kept_lines(docs.collect(), edits=0).items()}
    with pytest.raises(ValueError, match="max_edits"):
        line_dedup.line_dedup(docs, max_edits=2)


def test_odd_lines(odd, empty):
    out = line_dedup.line_dedup(odd)
    assert out.columns == [*odd.columns, "rv_lines_", "rv_kept_"] and out.count() == odd.count()
    rows = out.collect()
    assert all(r.rv_doc is None and r["id.x"] is None for r in rows)
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert [(r.text, r.rv_lines_, r.rv_kept_) for r in rows if r.doc_id == 4 and r.rv_lines_ == 2] == [("same text", 2, 1)] * 2
    assert [r.text for r in rows if r.doc_id == 5] == [LONG]
    assert line_dedup.line_dedup(empty).count() == 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_many_documents_of_one_id_stay_apart(spark, doc_id):
    # Lines of three hashes share nothing; eight digits of a hash would collide 50 times among so many documents.
    line = F.concat_ws(" ", *[F.sha1(F.concat(F.lit(salt), F.col("id").cast("string"))) for salt in "abc"])
    docs = spark.range(100_000).select(F.lit(doc_id).cast("long").alias("doc_id"), line.alias("text"))
    out = line_dedup.line_dedup(docs)
    found = out.agg(F.count("*"), F.countDistinct("text"), F.sum("rv_lines"), F.sum("rv_kept")).first()
    assert tuple(found) == (100_000,) * 4
    assert out.join(docs, "text", "left_anti").count() == 0


def test_candidates_by_shuffle(make_docs, monkeypatch):
    rng = random.Random(11)
    pool = [prose(i, 8) for i in range(12)]
    pool += [edited(rng, rng.choice(pool)) for _ in range(30)]
    docs = make_docs([(i, "\n".join(rng.choice(pool) for _ in range(4))) for i in range(30)])
    want = {(r.doc_id, r.text) for r in line_dedup.line_dedup(docs).collect()}
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    assert {(r.doc_id, r.text) for r in line_dedup.line_dedup(docs).collect()} == want


def test_names_that_are_taken(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x"), (2, "a b", 6, "y")], "doc_id long, text string, rv_kept int, `a.b` string")
    assert sorted(map(tuple, line_dedup.line_dedup(docs, added=("n", "k")).collect())) == [(1, "a b", 5, "x", 1, 1), (2, "", 6, "y", 1, 0)]


def test_op1_equals_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{data}/documents.parquet')")
    want = con.execute(queries.ORACLE_SQL["op1_line_dedup"]).fetchall()
    got = queries.QUERIES["op1_line_dedup"](spark, data).collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("name", ["op4_near_duplicates", "op6_decontamination"])
def test_queries_equal_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, data)
    assert got.columns == columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_no_array_is_made_twice(make_docs):
    docs = make_docs([(1, "a line of more than twenty characters\nanother one")])
    lines = line_dedup.distinct_lines(docs, 20)
    found, _ = line_dedup.candidates(docs, lines)
    for df in (lines, found, line_dedup.variants(found)):
        # Spark filters by the size of an exploded array, which makes it once more, unless the explode is an outer one.
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" in plan and "size(" not in plan


def test_block_keys_of_bytes_equal_those_of_characters(spark):
    lines = [(x,) for x in ("short", "x" * 20, "twenty or more characters of one byte each", "ab" * 700, "c" * 1025, "d" * 5000)]
    df = spark.createDataFrame(lines, "line string").select("line", F.length("line").alias("len"), F.col("line").cast("binary").alias("raw"))
    length = F.col("len")
    keys = [*line_dedup.half_keys(length), *line_dedup.half_keys(length - 1), *[line_dedup.key_at(length, F.lit(q)) for q in range(24)]]
    shown = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    by_bytes, by_text = df.select("line", *shown).collect(), df.withColumn("raw", F.lit(None).cast("binary")).select("line", *shown).collect()
    assert by_bytes == by_text and len({k for r in by_bytes for k in r[1:5]}) == 24


def test_line_dedup_runs_no_python(odd):
    plan = line_dedup.line_dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def sets_of(texts):
    h, n, _, _ = shingles(texts)
    e, owner = units(h, n)
    return [set(x.tolist()) for x in np.split(e, np.searchsorted(owner, np.arange(1, len(texts))))]


def classes(rows, threshold=0.8):
    """Least (doc_id, text) of each row's class, by all pairs."""
    rows = [(i, t or "") for i, t in rows]
    sets, up = sets_of([t for _, t in rows]), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if (rows[a][1] and rows[a][1] == rows[b][1]) or (both and both / (len(sets[a]) + len(sets[b]) - both) >= threshold):
            a, b = sorted((find(a), find(b)), key=lambda x: rows[x][0])
            up[b] = a
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_signatures_estimate_weighted_similarity():
    a, b = prose(1, 300), prose(1, 300)[:-700] + prose(2, 90)
    texts = [a, b, a + " " + a, "one two three four five", ""]
    h, n, _, _ = shingles(texts)
    e, owner = units(h, n)
    best = near_duplicates.signatures(e, owner, len(texts))
    assert np.isfinite(best[:4]).all() and np.isinf(best[4]).all()
    sets = sets_of(texts)
    for x, y in ((0, 1), (0, 2), (1, 2)):
        j = len(sets[x] & sets[y]) / len(sets[x] | sets[y])
        assert abs((best[x] == best[y]).mean() - j) < 0.25
    doc_by_doc = [near_duplicates.signatures(e[owner == i], np.zeros((owner == i).sum(), dtype=np.int64), 1) for i in range(4)]
    assert all((doc_by_doc[i][0] == best[i]).all() for i in range(4))


@pytest.mark.parametrize("block", [768, 4])
def test_near_duplicates_equal_brute_force(make_docs, block):
    rng = random.Random(9)
    rows, n = [], itertools.count()
    for group in range(8):
        words = prose(100 + group, rng.choice([6, 40, 150, 400]), words=3000).split()
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, len(words) // 20])):
                copy[rng.randrange(len(copy))] = f"x{rng.random()}"
            rows.append((next(n), " ".join(copy)))
    rows += [(next(n), t) for t in ("a b", "A, b!", "a c", "!!!", "!!!", "", None, "the same five words here the same five words here")]
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(make_docs(rows), block_nodes=block).collect()}
    assert got == classes(rows)


def test_a_shared_passage_does_not_compare_all_pairs(spark, make_docs, monkeypatch):
    """Unlike documents that a band throws together on their common passage; a few copies among them are found."""
    passage = prose(1, 60, words=5000)
    docs = [(d, f"{passage} {prose(1000 + d, 60, words=50_000)}") for d in range(300)]
    docs += [(1000 + d, docs[d][1] + " more words here") for d in range(0, 300, 30)]
    frame = make_docs(docs)
    made, compared = [], near_duplicates.compared

    def counted(blocks, threshold):
        sides = blocks.groupBy("band", "key", "i", "j").agg(F.sum((F.col("side") % 2).cast("long")).alias("l"), F.sum((F.col("side") >= 2).cast("long")).alias("r"))
        made.append(sides.agg(F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0))).first()[0])
        return compared(blocks, threshold)

    monkeypatch.setattr(near_duplicates, "compared", counted)
    found = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame, block_nodes=8).collect()}
    assert found == {i: i - 1000 if i >= 1000 else i for i, _ in docs}
    plain = list(made)
    made.clear()
    monkeypatch.setattr(near_duplicates, "parted", lambda marked, elements: marked.drop("size"))
    assert {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame, block_nodes=8).collect()} == found
    assert made[0] == plain[0] and made[1] > 1.5 * plain[1]


def test_a_bucket_of_two_blocks_is_compared_at_once(make_docs, monkeypatch):
    """Without a look at all its nodes before, and without a link lost between its blocks."""
    rng, rows = random.Random(5), [(100, prose(7, 60, words=5000)), (101, None), (102, "")]
    for d in range(14):
        words = prose(8, 60, words=5000).split()
        for _ in range(d // 6):
            words[rng.randrange(len(words))] = f"x{d}"
        rows.append((d, " ".join([*words, f"y{d}"])))
    rows += [(20, rows[5][1]), (20, rows[5][1]), (None, rows[6][1])]
    monkeypatch.setattr(near_duplicates, "alike", lambda *args: pytest.fail("a bucket of two blocks was taken for a large one"))
    found = {(r.doc_id, r.class_id) for r in near_duplicates.near_duplicates(make_docs(rows), block_nodes=9).collect()}
    want = classes([(-1 if d is None else d, t) for d, t in rows])
    assert found == {(None if d == -1 else d, None if c == -1 else c) for d, c in want.items()} and len(want) > len(set(want.values()))


def test_odd_near_duplicates(odd, empty):
    rows = near_duplicates.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.class_id for r in rows if r.doc_id == 4} == {4} and len({r.class_th for r in rows if r.doc_id == 4}) == 2
    assert [r.class_id for r in rows if r.doc_id is None] == [None]
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_op4_on_data(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.class_id for r in queries.QUERIES["op4_near_duplicates"](spark, data).collect()}
    assert got == classes([tuple(d) for d in docs])


def test_components(spark):
    links = [(i, i + 1) for i in range(40) if i % 10 != 9] + [(100, i) for i in range(101, 130)] + [(5, 5), (129, 60), (60, 50)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: i // 10 * 10 for i in range(40)}, **dict.fromkeys([50, 60, *range(100, 130)], 50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_round_of_components_shuffles_little(spark, monkeypatch):
    made, write = [], storage.materialize

    def counted(df, name):
        made.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(df, name)

    monkeypatch.setattr(importlib.import_module("rivulet.operators.components"), "materialize", counted)
    links = spark.range(64).selectExpr("id AS a", "id + 1 AS b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.root for r in components(links).collect()} == {0}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert made[0] == 1 and max(made[1:]) <= 9  # with a branch of the plan that is used twice counted twice


def words_of(text):
    return re.findall(r"[^\x00-\x20\x7f!-/:-@\[-`{-~]+", (text or "").lower())


def word_runs(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def leaks(docs, items, threshold=0.8):
    """All documents against all items, by sets of word tuples."""
    out, own = set(), [(d, words_of(t)) for d, t in docs]
    for i, t in items:
        words = words_of(t)
        want = word_runs(words, min(5, len(words))) if words else set()
        out |= {(d, i) for d, x in own if want and len(word_runs(x, min(5, len(words))) & want) / len(want) >= threshold}
    return out


def test_leaks_equal_brute_force(spark, make_docs):
    rng = random.Random(3)
    items = [(i, prose(500 + i, n)) for i, n in enumerate([4, 5, 6, 9, 15, 30, 59, 200, 900])] + [(20, None), (21, ""), (22, prose(503, 9))]
    docs = []
    for d in range(30):
        words = prose(900 + d, rng.choice([0, 20, 300, 5000]), words=5000).split()
        for _ in range(rng.choice([0, 1, 2])):
            copy = (rng.choice(items)[1] or "").split()
            if copy and rng.random() < 0.5:
                copy[rng.randrange(len(copy))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = copy
        docs.append((d, " ".join(words).upper() if d % 5 == 0 else " ".join(words)))
    docs += [(40, None), (41, items[8][1])]
    frame = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, u int")
    found = decontamination.contamination(make_docs(docs), frame).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaks(docs, items) and len(found) > 8
    assert any(r.item_id == 0 for r in found)
    assert decontamination.contamination(make_docs(docs), frame.limit(0)).count() == 0


def test_odd_leaks(spark, odd, empty):
    items = spark.createDataFrame([(1, " ".join(LONG.split()[20_000:20_030])), (2, "no id here, but words and lines"), (2, "twice the same id, another text")], "item_id long, text string")
    found = decontamination.contamination(odd, items).collect()
    assert sorted((str(r.doc_id), r.item_id, r.containment) for r in found) == [("5", 1, 1.0), ("None", 2, 1.0)]
    assert decontamination.contamination(empty, items).count() == 0


def test_items_without_id_are_found(spark, make_docs):
    item, other = prose(601, 30), prose(602, 30)
    docs = make_docs([(1, prose(603, 50) + " " + item), (None, other), (3, prose(604, 50))])
    items = spark.createDataFrame([(None, item), (None, other), (7, item)], "item_id long, text string")
    found = decontamination.contamination(docs, items).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.containment) for r in found) == [("1", "7", 1.0), ("1", "None", 1.0), ("None", "None", 1.0)]


def test_items_of_few_words(spark, make_docs):
    items = [(1, "secret answer is forty"), (2, "Zebra!"), (3, "two words"), (4, "?")]
    docs = [(1, prose(1, 30) + " the secret answer is forty, " + prose(2, 30)), (2, "secret answer was forty"), (3, "zebra"), (4, "words two"), (5, "is it two, words: zebra"), (6, "?")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(make_docs(docs), frame).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaks(docs, items) == {(1, 1), (3, 2), (5, 2), (5, 3)}


def test_a_passage_of_all_items_makes_no_candidates(spark, make_docs, monkeypatch):
    opening = prose(1, 16)
    items = [(i, f"{opening} {prose(100 + i, 34, words=5000)}") for i in range(60)]
    docs = [(d, f"{opening} {prose(1000 + d, 200, words=5000)}") for d in range(100)] + [(500, prose(3, 50) + " " + items[7][1])]
    counts, found = [], decontamination.candidates

    def counted(sketches, keys):
        out = found(sketches, keys)
        counts.append(out.count())
        return out

    monkeypatch.setattr(decontamination, "candidates", counted)
    got = decontamination.contamination(make_docs(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks(docs, items) == {(500, 7)}
    assert counts[0] <= 3  # an opening and one word more may occur twice by chance; all pairs would be 6,060


def test_items_of_shared_passages_alone(spark, make_docs):
    """Items that are made up of one another's passages keep no shingle to themselves, and are found all the same."""
    parts = [prose(i, 20, words=5000) for i in range(6)]
    items = [(i, f"{parts[i % 6]} {parts[(i + 1 + i // 6) % 6]}") for i in range(18)]
    docs = [(d, f"{prose(50 + d, 40, words=5000)} {items[d][1]} {prose(90 + d, 40, words=5000)}") for d in range(18)]
    found = decontamination.contamination(make_docs(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaks(docs, items)


def test_size_classes():
    for n in range(1, 3000):
        u = decontamination.size_class(n)
        assert n <= u and (n <= 3 or u < 1.55 * n)
    assert len({decontamination.size_class(n) for n in range(1, 3000)}) < 25


def test_op6_on_data(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries.QUERIES["op6_decontamination"](spark, data).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == Counter(leaks(docs, items))
