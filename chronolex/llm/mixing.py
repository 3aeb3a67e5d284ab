"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1]. The integral of its share gives the
words it must deliver by t; a document copy whose words lie at the source's cumulative position u is due at the
t where that cumulative demand reaches u. Documents are range-sorted by this position: by that of the first copy in the
query, which has one row a document, and by that of every copy in the pipeline's stage.

Sums over a source run in two levels, so a source with a third of all rows is not one task: buckets of a
hash order are summed first, then rows within a bucket. A bucket with more than CROWD rows holds an id that very many rows repeat, or
null ids; it is cut by id, size and a salt, as rows alike in id and size are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolex.llm.common import cut, documents, words_count

#: Weights that sources take in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Times a source's size at which its target stops, and copies of a document at most.
MOST = 3
#: Hash buckets of each source for two-level sums, in hexadecimal digits; rows of a bucket that is cut further, and salts of its rows.
DIGITS = 4
CROWD = 1 << 17
SALTS = 256
#: Slope of the schedule: a source's weight runs from 1 + SLOPE to 1 - SLOPE of its mean, or the reverse for every other one.
SLOPE = 0.5


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size -> also place, weight, target: shares of all words by weight, none above `most` times its size.

    The excess over a stop is reshared by weight until none is above. That fixed point has one level L with
    target = min(most * size, weight * L): in order of most * size / weight, the sources up to some place stop and
    the others share what is left by weight. One row a source, so the sort is of sources, not of documents.
    """
    places = Window.orderBy(F.col("source").asc_nulls_last())
    table = sizes.withColumn("place", F.row_number().over(places) - 1)
    table = table.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    table = table.withColumn("stop", most * F.col("source_size").cast("double")).withColumn("ratio", F.col("stop") / F.col("weight"))
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    table = table.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    # the first source in that order that does not stop fixes the level for all after it
    level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))).over(every)["level"]
    table = table.withColumn("final", level)
    target = F.when(F.col("final").isNull() | (F.col("ratio") <= F.col("final")), F.col("stop")).otherwise(F.col("weight") * F.col("final"))
    return table.withColumn("target", target).select("source", "source_size", "place", "weight", "target")


def due(u: Column, place: Column, slope: float = SLOPE) -> Column:
    """The t at which the cumulative demand of a source reaches the share u of its target.

    The schedule is w(t) = 1 + s - 2 s t with s = slope for even places and -slope for odd ones; its integral
    (1 + s) t - s t^2 is inverted in closed form.
    """
    s = F.when(place % 2 == 0, F.lit(slope)).otherwise(F.lit(-slope))
    root = F.sqrt(F.greatest((1 + s) * (1 + s) - 4 * s * u, F.lit(0.0)))
    return F.least(F.greatest(((1 + s) - root) / (2 * s), F.lit(0.0)), F.lit(1.0))


def curriculum(df: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", carry: bool = False, crowd: int = CROWD) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken and position (and `row` with carry).

    In an order by md5 of the id, the documents up to the fractional part of target / source_size get one copy more
    than the others; the one that straddles it gets it if its middle lies before, so taken words miss the target by at
    most half a document. position is the due time of the first copy, null without copies. Null sources are one
    source, null ids sort first, documents without words have size 0 and take nothing. Reruns agree; rows alike in id and
    size are interchangeable. An empty table gives an empty result.
    """
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    cols = [F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), digest.alias("digest")]
    base = df.select(*cols, *([F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []))
    # one key for a source, null too, so that rows stay where the window put them when they meet their bucket
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    base = base.withColumn("bucket", F.substring("digest", 1, DIGITS)).withColumn("key", key).withColumn("tie", F.monotonically_increasing_id())
    if not carry:  # sums and rows both read these, so that words are counted once
        base = cut(base)
    crowded = cut(base.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > crowd).select("key", "bucket"))  # rows / crowd at most
    if not crowded.isEmpty():
        salt = F.lpad(F.pmod(F.xxhash64("tie"), F.lit(SALTS)).cast("string"), 3, "0")
        finer = F.concat("digest", F.when(F.col("id").isNull(), "0").otherwise("1"), F.lpad(F.col("size").cast("string"), 12, "0"), salt)
        base = base.join(F.broadcast(crowded.withColumn("cut_further", F.lit(True))), ["key", "bucket"], "left")
        base = base.withColumn("bucket", F.when(F.col("cut_further"), finer).otherwise(F.col("bucket"))).drop("cut_further")
    sums = base.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sizes = sums.groupBy("source").agg(F.sum("bucket_size").cast("long").alias("source_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sums.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).cast("long")).drop("bucket_size")
    buckets = buckets.withColumnRenamed("source", "s").join(targets(sizes), F.col("s").eqNullSafe(F.col("source"))).drop("s").withColumn("key", key).drop("source")
    within = Window.partitionBy("key", "bucket").orderBy("digest", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("start_in", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(buckets, ["key", "bucket"])
    start = (F.col("bucket_start") + F.col("start_in")).cast("double")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("whole", F.floor(share)).withColumn("extra_until", (share - F.floor(share)) * F.col("source_size"))
    copies = (F.col("whole") + (start + F.col("size") / 2 < F.col("extra_until")).cast("long")).cast("long")
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long")).withColumn("u", F.when(F.col("source_size") > 0, start / F.col("source_size")))
    return rows.select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        F.when(F.col("copies") > 0, F.round(due(F.col("u") / F.col("copies"), F.col("place")), 6)).alias("position"),
        *([F.col("place"), F.col("u"), F.col("row")] if carry else []),
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum(documents(spark, sf_dir), words_count(F.col("text")))
    mixed = mixed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
    return mixed.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken", "copies", "position")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it, range-sorted by training position.

    Copy k of c passes over the source once more, so its words lie at (k + u) / c of the source's demand.
    """
    mixed = curriculum(docs, words_count(F.col("text")), carry=True).where("copies > 0")
    copies = mixed.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))
    copies = copies.withColumn("at", due((F.col("k") + F.col("u")) / F.col("copies"), F.col("place")))
    return copies.repartitionByRange("at", "doc_id").sortWithinPartitions("at", "doc_id").select("row.*")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), p AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s
), w AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight, 3.0::DOUBLE * source_size AS stop FROM p
), r AS (
  SELECT *, stop / weight AS ratio FROM w
), l AS (
  SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE
             - coalesce(sum(stop) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r
), f AS (
  SELECT l.*, (SELECT arg_min(level, (ratio, place)) FROM l WHERE ratio > level) AS final FROM l
), t AS (
  SELECT source, source_size, place, CASE WHEN final IS NULL OR ratio <= final THEN stop ELSE weight * final END AS target FROM f
), c AS (
  SELECT doc_id, size, source_size, target, place, target / source_size AS share,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, CASE WHEN size > 0 THEN CAST(floor(share) AS BIGINT) + CASE WHEN start + size / 2.0::DOUBLE < (share - floor(share)) * source_size THEN 1 ELSE 0 END ELSE 0 END AS copies,
         CASE WHEN place % 2 = 0 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END AS sl FROM c
)
SELECT doc_id, size, source_size, round(target, 4) AS target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies,
  CASE WHEN copies > 0 THEN round(least(greatest(((1 + sl) - sqrt(greatest((1 + sl) * (1 + sl) - 4 * sl * (start / source_size / copies), 0.0))) / (2 * sl), 0.0), 1.0), 6) END AS position
FROM k
"""
