"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Every document draws the key -ln(u) / w from a hash u of its id and its quality weight w; the smallest keys come
first. A source's target holds whole epochs of the source first; the rest is filled in key order up to the budget,
the last document in part. Prefix sums run in two levels: keys are cut into buckets of a few thousand documents, the
buckets are summed, and only the one bucket per source that the budget falls into is sorted.

Defined results: null text has size 0 and is taken 0 times; null source is a source of its own, after all others;
an empty table gives no rows; repeated rows are documents of their own; ties of the key go to the smaller doc_id,
then the smaller size; other columns of the input are ignored. Sources without words have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, sized, written

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DOCS = 4000


def quality_weight(size: Column, chars: Column) -> Column:
    """Between 0.1 and 1: the nearer a text's characters per word are to 6, the likelier it is taken."""
    return F.greatest(F.lit(0.1), 1.0 / (1.0 + F.abs(chars.cast("double") / F.greatest(size, F.lit(1)).cast("double") - 6.0) / 4.0))


def targets(sized_docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, docs, target. Water filling in closed form: with sources ordered by
    most * size / weight, those before some point are at their limit and the others share what is left by weight."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = sized_docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"), F.avg("weight").alias("mean_weight"))
    per = per.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("ratio", F.col("source_size") * F.lit(most) / F.col("w"))
    everything = Window.partitionBy()
    upto = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
    per = per.withColumn("before", F.sum(F.col("source_size") * F.lit(most)).over(upto) - F.col("source_size") * F.lit(most))
    per = per.withColumn("left_w", F.sum("w").over(everything) - F.sum("w").over(upto) + F.col("w"))
    per = per.withColumn("level", (F.col("total") - F.col("before")) / F.col("left_w"))
    # While a source is at its limit the level rises with the next one; from there on it doesn't.
    per = per.withColumn("level", F.max("level").over(everything))
    return per.select("source", "source_size", "docs", "mean_weight", F.least(F.col("source_size") * F.lit(most), F.col("level") * F.col("w")).cast("double").alias("target"))


def mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken (and the columns named in keep) of every document."""
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    draw = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    base = docs.select("doc_id", "source", size.alias("size"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), *keep)
    base = base.withColumn("weight", quality_weight(F.col("size"), F.col("chars")))
    base = written(base.select("doc_id", "source", "size", "weight", (-F.log(draw) / F.col("weight")).alias("key"), *keep), "mix")
    per = written(targets(base, weights, share, most), "targets")
    per = per.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    per = per.withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    per_b = sized(per, 64)
    buckets = F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_DOCS))
    part = F.least(buckets - 1, F.floor((1.0 - F.exp(-F.col("key") * F.col("mean_weight"))) * buckets)).cast("long")
    rows = base.withColumnRenamed("source", "src").join(per_b, F.col("src").eqNullSafe(F.col("source"))).withColumn("bucket", part).drop("src")
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    sums = written(sums.select(F.col("source").alias("src"), F.col("bucket").alias("bkt"), "before", "words"), "buckets")
    rows = rows.join(sized(sums, 64), F.col("source").eqNullSafe(F.col("src")) & (F.col("bucket") == F.col("bkt")))
    inside = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    order = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", *keep).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = rows.where(inside).withColumn("prior", F.col("before") + F.sum("size").over(order) - F.col("size"))
    cut = cut.withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("prior"))).cast("long")).drop("prior")
    whole = rows.where(~inside).withColumn("more", F.when(F.col("before") + F.col("words") <= F.col("rest"), F.col("size")).otherwise(F.lit(0)).cast("long"))
    out = whole.unionByName(cut)
    return out.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("more")).cast("long").alias("taken"), *keep)


def op5_source_mix(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


SQL = r"""
WITH base AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, COALESCE(length(text), 0) AS chars,
         (('0x' || substr(md5('mix:' || COALESCE(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents
), keyed AS (
  SELECT *, -ln(u) / greatest(0.1, 1.0 / (1.0 + abs(chars::DOUBLE / greatest(size, 1)::DOUBLE - 6.0) / 4.0)) AS k FROM base
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM keyed GROUP BY source
), ranked AS (
  SELECT *, source_size * 2.0::DOUBLE / w AS ratio, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total,
         (sum(source_size) OVER o)::DOUBLE * 2.0::DOUBLE - source_size * 2.0::DOUBLE AS before,
         sum(w) OVER () - sum(w) OVER o + w AS left_w
  FROM named WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), leveled AS (
  SELECT *, max((total - before) / left_w) OVER () AS level FROM ranked
), target AS (
  SELECT source, source_size, least(source_size * 2.0::DOUBLE, level * w) AS target FROM leveled
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM target
), drawn AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs, round(p.target - p.epochs * p.source_size)::BIGINT AS rest,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - d.size AS prior
  FROM keyed d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - prior)))::BIGINT AS taken FROM drawn
"""
