"""A training corpus from ``documents``, stage by stage.

Each stage takes the documents that its predecessor kept, as a Parquet table in
the shared folder, and all but the last return the columns of ``documents``:

1. language: documents without letters, or of no language that the network is
   fairly sure of, go.
2. lines: lines that occur earlier in the corpus (but for one edit) are taken
   out; documents that lose all their lines go.
3. near_duplicates: of each class of near-duplicates the first document stays.
4. decontamination: documents that contain a benchmark item go.
5. packing: the rest are packed into windows of 1024 tokens.

Null texts are rejected by the first stage.  Rows equal in doc_id and text are
one document to all stages, and the third keeps one of them.  Other columns go
along, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.common import TABLES, column, drop_tables, fresh, materialize, table
from rivulet.llm.decontamination import contamination
from rivulet.llm.language import UNKNOWN, learn, predict
from rivulet.llm.line_dedup import line_dedup
from rivulet.llm.near_duplicates import near_duplicates, text_hash
from rivulet.llm.packing import pack_documents

LEAST_SCORE = 0.4


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lang, score = fresh(docs.columns, "rv_lang", "rv_score")
    found = predict(docs, learn(docs), added=(lang, score))
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*map(column, docs.columns))


def keep_first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lines, kept = fresh(docs.columns, "rv_lines", "rv_kept")
    out = line_dedup(docs, added=(lines, kept)).where((F.col(kept) > 0) | (F.col(lines) == 0))
    return out.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else column(c) for c in docs.columns])


def matching(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows whose doc_id and text hash are (left_semi) or are not (left_anti) found."""
    d, t = fresh(docs.columns, "rv_d", "rv_t")
    f = found.select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    return docs.join(f, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (text_hash() == F.col(t)), how)


def keep_first_of_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    first = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("th") == F.col("class_th")))
    kept = matching(docs, first, "left_semi")
    # Rows equal in doc_id and text are one document; of these, the first by their other columns stays.
    h, n = fresh(docs.columns, "rv_h", "rv_n")
    others = [column(c) for c in docs.columns if c not in ("doc_id", "text")]
    nth = F.row_number().over(Window.partitionBy("doc_id", h).orderBy(*(others or ["doc_id"])))
    return kept.withColumn(h, text_hash()).withColumn(n, nth).where(F.col(n) == 1).select(*map(column, docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return matching(docs, contamination(docs, table(spark, sf_dir, "benchmark")), "left_anti").select(*map(column, docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", keep_languages),
    ("lines", keep_first_lines),
    ("near_duplicates", keep_first_of_class),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: A trained network, sketches and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = len(TABLES)
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        # What the stage itself wrote is not read any more; its result and its predecessors' stay.
        result = TABLES.pop()
        drop_tables(spark, before)
        TABLES.append(result)
    return docs
