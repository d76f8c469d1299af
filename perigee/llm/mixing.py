"""Mixing sources to target weights by hash thresholds.

Every document has a fixed hash. For each source a threshold is sought below which documents
are taken (once more), such that the words taken meet the source's target. The threshold
comes from nested histograms: words are summed by source and hash bucket, the bucket in which
the target falls is refined with the next bits of the hash, and so on. Documents are never
sorted, and from the second histogram on only those of the boundary buckets are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.session import work_table

WORD = "[^\\x20\\x09-\\x0D]+"
BITS = 16
LEVELS = 3
HASH_DIGITS = BITS * LEVELS // 4


def word_count(text: Column) -> Column:
    """Number of words of a text; none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """48 bits that depend on the id only, or on the text if there is no id."""
    key = F.coalesce(doc_id.cast("string"), text, F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, HASH_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target of each source, given (source, source_size).

    Sources in code point order, null last, take the weights in turn and share `share` times
    all sizes. A target stops at `most` times its source's size, and what is over goes to the
    others by weight until none is above. There is one row per source, and they meet in one task.
    """
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = (position % len(weights)).cast("int")
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1))
    weighed = weighed.withColumn("full", F.col("source_size") * F.lit(float(most)))
    # Sources fill up in order of size by weight; the first that does not fill up sets the level of the rest.
    order = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(
        F.sum("full").over(before), F.lit(0.0)
    )
    levels = weighed.withColumn("level", left / F.sum("weight").over(after))
    open_level = F.when(F.col("full") > F.col("level") * F.col("weight"), F.col("level"))
    level = F.first(open_level, ignorenulls=True).over(everything)
    target = F.coalesce(F.least(level * F.col("weight"), F.col("full")), F.col("full"))
    return levels.select("source", "source_size", target.alias("target"))


def source_thresholds(
    sized: DataFrame, weights: Sequence[float], share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """For each source: source_size, target, `copies` that every document is taken, and the hash `threshold`
    below which a document is taken once more. `sized` has source, size and hash.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = targets.withColumn("copies", copies.cast("long")).select(
        "*",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("threshold"),
        F.lit(True).alias("open"),
    )
    state, rows = work_table(state, "mix-targets"), sized
    for level in range(LEVELS):
        width = 1 << BITS * (LEVELS - 1 - level)
        inside = rows.alias("d").join(
            state.filter("open").select("source", F.col("threshold").alias("low"), "budget").alias("s"),
            F.col("d.source").eqNullSafe(F.col("s.source"))
            & F.col("hash").between(F.col("low"), F.col("low") + ((width << BITS) - 1)),
        )
        rows = inside.select("d.source", "hash", "size", "low", "budget")
        if level:
            rows = work_table(rows, "mix-boundary")
        state = work_table(_refined(state, rows, width, last=level == LEVELS - 1), "mix-level")
        rows = rows.select("source", "hash", "size") if level else sized
    return state.select("source", "source_size", "target", "copies", "threshold")


def _refined(state: DataFrame, rows: DataFrame, width: int, last: bool) -> DataFrame:
    """Move each source's threshold to the start of the bucket in which its budget falls."""
    bucket = F.floor((F.col("hash") - F.col("low")) / F.lit(width)).cast("long")
    sums = rows.groupBy("source", bucket.alias("bucket")).agg(
        F.sum("size").alias("words"), F.first("budget").alias("budget")
    )
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    over = F.col("upto") > F.col("budget")
    found = (
        sums.withColumn("upto", upto)
        .groupBy("source")
        .agg(
            F.min(F.when(over, F.col("bucket"))).alias("boundary"),
            F.min_by("words", F.when(over, F.col("bucket"))).alias("words"),
            F.max(F.when(~over, F.col("upto"))).alias("taken"),
        )
        .alias("f")
    )
    step = F.col("boundary")
    left = F.col("budget") - F.coalesce(F.col("taken"), F.lit(0))
    if last:  # one hash value is left: it is taken if that comes nearer to the target
        step = step + F.when(left >= F.col("words") / F.lit(2.0), 1).otherwise(0)
    end = F.lit(width << BITS)
    moved = F.col("threshold") + F.coalesce(step * F.lit(width), end)
    return state.alias("s").join(found, F.col("s.source").eqNullSafe(F.col("f.source")), "left").select(
        "s.source",
        "source_size",
        "target",
        "copies",
        F.when(F.col("open"), left).otherwise(F.col("budget")).alias("budget"),
        F.when(F.col("open"), moved).otherwise(F.col("threshold")).alias("threshold"),
        (F.col("open") & F.col("boundary").isNotNull()).alias("open"),
    )


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """`docs` (doc_id, text, source and any others) with size, source_size, target, copies and taken.

    `copies` is how often the mix takes the document (0 to `most`, rounded up), `taken` the words that makes.
    The decision depends on the id alone (on the text where the id is null), so reruns agree
    and rows with one id are taken alike. A null text has size 0; a null source is a source.
    An empty table gives an empty one; columns of `docs` with the names added here are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    size, key = word_count(F.col("text")), document_hash(F.col("doc_id"), F.col("text"))
    sized = work_table(docs.select("source", size.alias("size"), key.alias("hash")), "mix-sizes")
    thresholds = source_thresholds(sized, weights, share, most).alias("t")
    joined = (
        docs.withColumns({"__size": size, "__hash": key})
        .alias("d")
        .join(thresholds, F.col("d.source").eqNullSafe(F.col("t.source")))
    )
    extra = F.when((F.col("d.__hash") < F.col("t.threshold")) & (F.col("t.copies") < F.lit(most)), 1).otherwise(0)
    copies = F.col("t.copies") + extra
    return joined.select(
        *(f"d.`{name}`" for name in docs.columns),
        F.col("d.__size").alias("size"),
        "t.source_size",
        "t.target",
        copies.alias("copies"),
        (copies * F.col("d.__size")).alias("taken"),
    )


def op1_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 12))::BIGINT AS h
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, source_size * 2.0::DOUBLE AS full_size,
    ([3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT]
      AS weight
  FROM sources),
levels AS (
  SELECT *,
    ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(full_size) OVER (ORDER BY full_size / weight, source ASC NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
    / sum(weight) OVER (ORDER BY full_size / weight, source ASC NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
open_level AS (SELECT min_by(level, full_size / weight) AS level FROM levels WHERE full_size > level * weight),
targets AS (
  SELECT source, source_size,
    coalesce(least((SELECT level FROM open_level) * weight, full_size), full_size) AS target
  FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM targets),
hashes AS (SELECT source, h, sum(size) AS words FROM sized GROUP BY source, h),
running AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM hashes),
chosen AS (
  SELECT r.source, r.h, b.source_size, b.target, b.copies + CASE
      WHEN r.upto <= b.target - b.copies * b.source_size THEN 1
      WHEN r.upto - r.words <= b.target - b.copies * b.source_size
        AND b.target - b.copies * b.source_size - (r.upto - r.words) >= r.words / 2.0::DOUBLE THEN 1
      ELSE 0 END AS copies
  FROM running r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size, c.source_size, c.target, (d.size * c.copies)::BIGINT AS taken
FROM sized d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""
