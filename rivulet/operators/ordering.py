"""Row numbers and running sums in a global order, without one task that sees all rows.

Rows are put into buckets that ascend with the order; the bounds come from a
sample chosen by a hash of the order columns, so they are the same whenever the
plan runs.  Windows run inside buckets; what lies before a bucket comes from a
table with one row for each.  There are at most ``MOST_BUCKETS`` buckets: so many
bounds come to the driver and go into the plan, where a row finds its bucket by
binary search.  Beyond ``MOST_BUCKETS * ROWS_PER_BUCKET`` rows buckets grow; a window
streams over a sorted bucket, which may be on disk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS_PER_BUCKET = 200_000
MOST_BUCKETS = 1024
SAMPLES_PER_BUCKET = 64


def bounds(df: DataFrame, order: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> list:
    """Values of the order columns that part the buckets, ascending and distinct: one less than there are buckets, at most."""
    n = df.count()
    buckets = min(MOST_BUCKETS, -(-n // rows_per_bucket))
    if buckets < 2:
        return []
    every = max(1, n // (buckets * SAMPLES_PER_BUCKET))
    # Rows of equal values are taken once, so the sample has a bounded size whatever its values.
    sample = df.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0).distinct().select(F.struct(*order).alias("k"))
    part = F.ntile(buckets).over(Window.orderBy("k"))
    rows = sample.select("k", part.alias("part")).groupBy("part").agg(F.min("k").alias("k")).where("part > 1").orderBy("part").collect()
    return [r["k"] for r in rows]


def bucket(df: DataFrame, order: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> Column:
    """The number of bounds below or at a row."""
    schema = df.select(F.struct(*order).alias("k")).schema["k"].dataType
    found = bounds(df, order, rows_per_bucket)
    if not found:
        return F.lit(0)
    literal = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields, strict=True)]) for r in found])
    key, n = F.struct(*order), len(found)
    steps = F.array(*[F.lit(1 << i) for i in range(n.bit_length() - 1, -1, -1)])

    def go_on(at: Column, step: Column) -> Column:
        """``at`` bounds are known to be at most the key; are ``step`` more?"""
        return F.when((at + step <= n) & (F.get(literal, at + step - 1) <= key), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), go_on)


def with_row_number(df: DataFrame, order: list[str], name: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with a number from 0 in the order of ``order`` (which should leave no ties)."""
    b = bucket(df, order, rows_per_bucket)
    local = F.row_number().over(Window.partitionBy("rv_bucket").orderBy(*order))
    before = F.sum("rv_n").over(Window.orderBy("rv_bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = df.select(b.alias("rv_bucket")).groupBy("rv_bucket").agg(F.count("*").alias("rv_n"))
    offsets = counts.select("rv_bucket", F.coalesce(before, F.lit(0)).alias("rv_before"))
    rows = df.withColumn("rv_bucket", b).withColumn("rv_local", local).join(offsets, "rv_bucket")
    return rows.select(*df.columns, (F.col("rv_before") + F.col("rv_local") - 1).cast("long").alias(name))


def with_run_number(df: DataFrame, order: list[str], value: Column, name: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with the number, from 0, of the run of equal ``value`` that a row is in."""
    b = bucket(df, order, rows_per_bucket)
    rows = df.withColumns({"rv_bucket": b, "rv_value": value})
    window = Window.partitionBy("rv_bucket").orderBy(*order)
    last = rows.groupBy("rv_bucket").agg(F.max_by("rv_value", F.struct(*order)).alias("rv_last"))
    lead = last.select("rv_bucket", F.lag("rv_last").over(Window.orderBy("rv_bucket")).alias("rv_lead"), F.row_number().over(Window.orderBy("rv_bucket")).alias("rv_nth"))
    marked = rows.withColumns({"rv_prev": F.lag("rv_value").over(window), "rv_first": F.row_number().over(window) == 1}).join(lead, "rv_bucket")
    before = F.when(F.col("rv_first"), F.col("rv_lead")).otherwise(F.col("rv_prev"))
    start = (F.col("rv_first") & (F.col("rv_nth") == 1)) | ~before.eqNullSafe(F.col("rv_value"))
    marked = marked.withColumn("rv_start", start.cast("long"))
    total = marked.groupBy("rv_bucket").agg(F.sum("rv_start").alias("rv_n"))
    offset = total.select("rv_bucket", F.coalesce(F.sum("rv_n").over(Window.orderBy("rv_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("rv_before"))
    running = F.sum("rv_start").over(window.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("rv_run", running).join(offset, "rv_bucket").select(*df.columns, (F.col("rv_before") + F.col("rv_run") - 1).cast("long").alias(name))
