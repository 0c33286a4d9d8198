"""Line deduplication over a corpus, exact and within one edit, in DataFrame operations.

A line goes if its text occurs earlier, or if a text that occurs earlier is
within the edit bound (Levenshtein distance over characters) and both have at
least ``min_chars``.  Earlier means a lesser (doc_id, text hash, line number); of
the hash, eight digits order the documents of one doc_id, and all 64 bits tell them
apart.  Lines of ASCII white space alone always stay.  What counts is the text that
occurs earlier, whether or not it stays itself: of numbered lines, each within an
edit of one before, the first stays.

Deletion neighbourhood: two lines are one edit apart if deleting at most one
character from each gives the same string.  To emit few variants of long lines,
deletion works twice.  First a line is cut into blocks (two, or of about 512
characters) and keyed by all it has but one block, for its own length and for
one character less; an edit lies in some block, so lines one edit apart share
such a key.  Only lines that share a key with another text go on; two lines that
have a key to themselves are a pair.  In larger groups the block in question is
keyed by each string that deleting one character of it leaves, and texts with equal
keys are joined through the earliest of them, so a group of n costs n rows.  Each
pair found is verified by its edit distance.

Cases: a null text has no lines and stays null; rows equal in doc_id and text
are one document and get the same result; rows of one doc_id (or of none) with
other texts are documents of their own; a document may lose all its lines and then
has an empty text; null doc_ids come first; other columns stay as they are, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, fresh, materialize, table

MIN_CHARS = 20
BLOCK = 512
#: Candidates up to this many (some 40 bytes each) are sent to all tasks; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


#: A place is one number, so that the least of many is found by hash aggregation: the document's
#: code, eight digits of its text's hash, and ten of the line number.  The whole hash goes beside it.
LINE = Decimal(10**10)
DOC = Decimal(10**18)
#: ASCII white space but the line feed, which ends a line.
BLANKS = " \t\v\f\r"


def text_code() -> Column:
    """64 bits that tell apart the documents of one doc_id."""
    return F.xxhash64(F.col("text").cast("string"))


def document_place() -> Column:
    """The place of a document's line 0; ascends with doc_id, null first."""
    code = F.coalesce(F.col("doc_id").cast("long").cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1)), F.lit(Decimal(0)))
    digits = F.pmod(text_code(), F.lit(10**8)).cast("decimal(18,0)")
    return (code.cast("decimal(20,0)") * F.lit(DOC) + digits * F.lit(LINE)).cast("decimal(38,0)")


def is_blank(line: Column) -> Column:
    return F.ltrim(line, F.lit(BLANKS)) == ""


def line_of(at: Column) -> Column:
    return (at % F.lit(LINE)).cast("int")


def document_of(at: Column) -> Column:
    return (at - at % F.lit(LINE)).cast("decimal(38,0)")


def block_count(length: Column) -> Column:
    return F.greatest(F.lit(2), F.ceil(length / BLOCK)).cast("int")


def bound(length: Column, blocks: Column, j: Column) -> Column:
    return F.floor(length.cast("long") * j / blocks).cast("int")


def ends_key(seen: Column, j: Column, left: Column | None, right: Column | None) -> Column:
    """Hash of ``line`` without what lies between its first ``left`` and its last ``right`` characters (None: none of them).

    ``raw`` has the bytes of a line of one-byte characters, null for others.  Bytes are cut without
    a walk over the characters before them, and their hash is that of the equal string.
    """
    none, mark, most = F.lit(""), F.lit("|"), F.col("len")
    of_bytes = [none if left is None else F.substring("raw", F.lit(1), left), mark, none if right is None else F.substring("raw", most - right + 1, most)]
    of_text = [none if left is None else F.substring("line", F.lit(1), left), mark, none if right is None else F.substring("line", most - right + 1, most)]
    return F.when(F.col("raw").isNotNull(), F.xxhash64(seen, j, *of_bytes)).otherwise(F.xxhash64(seen, j, *of_text))


def key_at(length: Column, q: Column) -> Column:
    """The q-th block key of a line: first those of its own length, then those of one less."""
    own = q < block_count(length)
    seen = F.when(own, length).otherwise(length - 1)
    j = F.when(own, q).otherwise(q - block_count(length))
    n = block_count(seen)
    return F.when(j < n, ends_key(seen, j, bound(seen, n, j), seen - bound(seen, n, j + 1)))


def half_keys(seen: Column) -> list[Column]:
    """The two block keys of a line seen as ``seen`` long, if that makes two blocks."""
    half = F.floor(seen / 2).cast("int")
    return [ends_key(seen, F.lit(0), None, seen - half), ends_key(seen, F.lit(1), half, None)]


def all_lines(docs: DataFrame) -> DataFrame:
    """``at``, ``th``, ``line`` and ``len`` of all lines but those of white space alone."""
    # A document's place is found below the explode, once, and its text does not go through it.  So is
    # a line's length: counting characters again in each expression would cost more than all the rest.
    lines = F.transform(F.split(F.col("text").cast("string"), "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("len")))
    found = docs.select(document_place().alias("doc"), text_code().alias("th"), lines.alias("lines")).select("doc", "th", F.posexplode_outer("lines").alias("line_no", "l")).select("doc", "th", "line_no", "l.line", "l.len")
    return found.where(~is_blank(F.col("line"))).select((F.col("doc") + F.col("line_no").cast("decimal(10,0)")).cast("decimal(38,0)").alias("at"), "th", "line", "len")


def distinct_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Where each text of a line occurs first, and its block keys, four a row (null for short lines).

    ``part`` counts a line's rows; all but very long lines have one.
    """
    length = F.col("len")

    def four(part: Column, keys: list[Column]) -> Column:
        return F.struct(part.alias("part"), *[k.alias(f"k{i}") for i, k in enumerate(keys)])

    none = four(F.lit(0), [F.lit(None).cast("long")] * 4)
    halves = four(F.lit(0), [*half_keys(length), *half_keys(length - 1)])
    total = block_count(length) + block_count(length - 1)
    many = F.transform(F.sequence(F.lit(0), F.ceil(total / 4).cast("int") - 1), lambda c: four(c, [key_at(length, 4 * c + i) for i in range(4)]))
    parts = F.when(length < min_chars, F.array(none)).when(block_count(length) == 2, F.array(halves)).otherwise(many)
    raw = F.when(F.octet_length("line") == length, F.col("line").cast("binary"))
    spread = all_lines(docs).select("at", "th", "line", "len", raw.alias("raw"))
    spread = spread.select("at", "th", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), parts.alias("parts"))
    # Explodes are outer ones here: before others Spark filters by the size of the array, and so makes each array once more.
    spread = spread.select("h1", "h2", "at", "th", F.explode_outer("parts").alias("p")).select("h1", "h2", "at", "th", "p.*")
    # The text stays behind: equal lines have equal keys, so any row's will do.
    first = [F.min("at").alias("least"), F.min_by("th", "at").alias("th"), *[F.first(f"k{i}").alias(f"k{i}") for i in range(4)]]
    return spread.groupBy("h1", "h2", "part").agg(*first).select(F.col("least").alias("at"), "th", "part", "k0", "k1", "k2", "k3")


def candidates(docs: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the lines that share a block key with another text, by number: ``id``, ``key``, how many share it, the line,
    how it was seen, and the block's text; and where each number is).

    Numbers ascend with places.
    """
    each = F.array(*[F.struct((F.col("part") * 4 + i).alias("p"), F.col(f"k{i}").alias("key")) for i in range(4)])
    spread = lines.select("at", "th", F.explode(each).alias("k")).select("at", "th", "k.*").where("key is not null")
    shared = spread.groupBy("key").agg(F.count("*").alias("shared")).where("shared > 1")
    found = materialize(spread.join(shared, "key"), "shared-blocks")
    ids = materialize(found.select("at", "th").distinct().orderBy("at", "th").withColumn("id", F.monotonically_increasing_id()), "candidate-places")
    placed = found.join(ids, ["at", "th"]).select(document_of(F.col("at")).alias("doc"), "th", F.struct(line_of(F.col("at")).alias("line_no"), "id", "p", "key", "shared").alias("f"))
    by_doc = placed.groupBy("doc", "th").agg(F.collect_list("f").alias("found"))
    if found.count() <= BROADCAST_ROWS:
        by_doc = F.broadcast(by_doc)
    rows = docs.select(document_place().alias("doc"), text_code().alias("th"), F.split(F.col("text").cast("string"), "\n").alias("all")).join(by_doc, ["doc", "th"])
    line = lambda f: F.get("all", f["line_no"])
    one = rows.select(F.explode_outer(F.transform("found", lambda f: F.struct(*[f[c].alias(c) for c in ("id", "p", "key", "shared")], line(f).alias("line"), F.length(line(f)).alias("len")))).alias("c")).select("c.*")
    size = F.col("len")
    own = F.col("p") < block_count(size)
    seen = F.when(own, size).otherwise(size - 1)
    j = F.when(own, F.col("p")).otherwise(F.col("p") - block_count(size))
    first, after = bound(seen, block_count(seen), j), seen - bound(seen, block_count(seen), j + 1)
    out = one.select("id", "key", "shared", "line", own.alias("short"), F.substring(F.col("line"), first + 1, size - first - after).alias("block"), (size - first - after).alias("n"))
    return out.dropDuplicates(["id", "key"]), ids


def variants(found: DataFrame) -> DataFrame:
    """Keys of the deletion neighbourhood.

    kind 0: the block as it is; 1: without one character, of lines one longer
    (equal to a block of kind 0); 2: without the character at one place (equal
    to others of kind 2 that differ at that place alone).
    """
    block, key = F.col("block"), F.col("key")
    n = F.col("n")

    def without(i: Column, kind: int) -> Column:
        left, right = F.substring(block, F.lit(1), i), F.substring(block, i + 2, n)
        place = F.when(F.col("short"), i).otherwise(F.lit(-1))
        return F.struct(F.xxhash64(key, place, F.concat(left, right)).alias("variant"), F.lit(kind).alias("kind"))

    each = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    whole = F.array(F.struct(F.xxhash64(key, F.lit(-1), block).alias("variant"), F.lit(0).alias("kind")))
    all_keys = F.when(F.col("short"), F.concat(whole, F.transform(each, lambda i: without(i, 2)))).otherwise(F.transform(each, lambda i: without(i, 1)))
    # An outer explode, see ``distinct_lines``; a line with nothing to leave out has no key.
    return found.select("id", F.explode_outer(all_keys).alias("v")).select("id", "v.variant", "v.kind").where("variant is not null")


def near_copies(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``at`` and ``th`` of first occurrences that have an earlier line within one edit."""
    found, ids = candidates(docs, lines)
    found = materialize(found, "candidate-lines")
    # Two lines that have a key to themselves are one pair; in larger groups variants tell the pairs.
    two = found.where("shared = 2").groupBy("key").agg(F.max("id").alias("id"), F.min("id").alias("head")).where("head < id").select("id", "head")
    keyed = variants(found.where("shared > 2"))
    least = [F.min(F.when(F.col("kind") == k, F.col("id"))).alias(f"id{k}") for k in range(3)]
    groups = keyed.groupBy("variant").agg(F.count("*").alias("n"), *least).where("n > 1")
    # The earliest partner of each kind: a kept block's is a longer line, a longer line's is the block itself.
    head = F.when(F.col("kind") == 0, F.col("id1")).when(F.col("kind") == 1, F.col("id0")).otherwise(F.col("id2"))
    pairs = keyed.join(groups, "variant").select("id", head.alias("head")).where(F.col("head") < F.col("id")).unionByName(two).distinct()
    texts = found.select("id", "line").dropDuplicates(["id"])
    both = pairs.join(texts, "id").join(texts.select(F.col("id").alias("head"), F.col("line").alias("kept")), "head")
    return ids.join(both.where(F.levenshtein("line", "kept", 1) >= 0).select("id").distinct(), "id").select("at", "th")


def line_dedup(docs: DataFrame, max_edits: int = 1, min_chars: int = MIN_CHARS, added: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and two columns more: its numbers of lines before and after.

    These are named ``added``, or ``rv_lines`` and ``rv_kept`` with an underscore for each column of that name that is there.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    before, after = added or fresh(docs.columns, "rv_lines", "rv_kept")
    doc, th, found, stay = fresh([*docs.columns, before, after], "rv_doc", "rv_th", "rv_found", "rv_stay")
    if max_edits == 0:
        first = distinct_lines(docs, 1 << 30).select("at", "th")
    else:
        lines = materialize(distinct_lines(docs, min_chars), "lines")
        first = lines.where("part = 0").select("at", "th").join(near_copies(docs, lines), ["at", "th"], "left_anti")
    kept = first.groupBy(document_of(F.col("at")).alias(doc), F.col("th").alias(th)).agg(F.collect_list(line_of(F.col("at"))).alias(found))
    # Lines are split below the join, so each text is split once and crosses it once.
    rows = docs.withColumns({doc: document_place(), th: text_code(), "text": F.split(F.col("text").cast("string"), "\n")})
    both = rows.join(kept, [doc, th], "left")
    numbers = F.coalesce(found, F.array().cast("array<int>"))
    blank = F.filter(F.sequence(F.lit(0), F.size("text") - 1), lambda i: is_blank(F.get("text", i)))
    out = both.withColumn(stay, F.when(F.col("text").isNotNull(), F.array_sort(F.concat(numbers, blank))))
    return out.select(
        *[F.array_join(F.transform(stay, lambda i: F.get("text", i)), "\n").alias(c) if c == "text" else column(c) for c in docs.columns],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("text")).cast("long").alias(before),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(stay)).cast("long").alias(after),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("rv_lines").alias("n_lines"), F.col("rv_kept").alias("n_kept"), F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


OP1_SQL = """
WITH occurrence AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents
), first AS (
  SELECT line, min(doc_id * 1000000 + line_no) AS pos, length(line) AS n FROM occurrence WHERE ltrim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY line
), half AS (
  SELECT line, pos, n, l, side, CASE side WHEN 0 THEN left(line, l // 2) ELSE right(line, l - l // 2) END AS part
  FROM first, (VALUES (0), (1)) s(side), (VALUES (0), (1)) d(less), LATERAL (SELECT n - less AS l) WHERE n >= 20
), gone AS (
  SELECT DISTINCT b.line FROM half a JOIN half b ON a.l = b.l AND a.side = b.side AND a.part = b.part AND a.pos < b.pos AND a.line <> b.line AND abs(a.n - b.n) <= 1 WHERE levenshtein(a.line, b.line) <= 1
), kept AS (
  SELECT pos FROM first WHERE line NOT IN (SELECT line FROM gone)
), flagged AS (
  SELECT o.doc_id, o.line_no, o.line, ltrim(o.line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) = '' OR k.pos IS NOT NULL AS stays FROM occurrence o LEFT JOIN kept k ON k.pos = o.doc_id * 1000000 + o.line_no
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (stays)::BIGINT AS n_kept, md5(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (stays), '')) AS kept_md5
FROM flagged GROUP BY doc_id
"""
