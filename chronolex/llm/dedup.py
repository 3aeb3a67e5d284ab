"""Exact dedup by content sort, with DataFrame operations only.

Sampled splitters deal normalised texts out by range; an external sort places equal texts next to each
other and neighbours are compared in full. The range key is bounded: the first characters of the normalised
text, its SHA-256 and a salt, so the sampled splitters stay small however long texts are. Texts whose copies
hold more than one of PARTS parts of all bytes, of which there are fewer than PARTS, are sorted apart from the
others and spread over as many salts as they hold parts; the first rows of a text's salts, fewer than 2 PARTS
rows in all, then meet. All other texts are settled where the sort puts them, so whole rows are exchanged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolex.llm.common import cut, documents

#: Parts of all bytes; a text whose copies hold more than one is spread over several ranges.
PARTS = 4096
#: Bytes that count for a row besides its text.
ROW_BYTES = 64
#: Characters of the normalised text that lead the sort key.
LEAD = 24
#: ASCII white space other than the space.
SPACES = "\t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty. Only texts with adjacent spaces need a pattern."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def frequent(keyed: DataFrame, parts: int) -> DataFrame:
    """(key, salts) of the texts whose copies hold more than one of `parts` parts of all bytes: fewer than `parts` rows."""
    total = keyed.agg(F.sum("bytes")).first()[0] or 0
    sums = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    held = F.col("bytes") * F.lit(parts) / F.lit(max(total, 1))
    return cut(sums.where((F.col("n") > 1) & (held > 1)).select("key", F.ceil(held).cast("long").alias("salts")))


def in_runs(keyed: DataFrame, norm: Column | None = None) -> DataFrame:
    """Content sort: adds rn (place in the run of equal texts, of one salt if there are salts), head (its first id) and n (its rows).

    norm gives the normalised text from columns that the exchange keeps, where the text itself is not to be exchanged twice.
    """
    keyed = keyed.select("*", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), F.substring("norm", 1, LEAD).alias("lead"))
    if norm is not None:
        keyed = keyed.drop("norm")
    ranges = ["lead", "sha", *(["salt"] if "salt" in keyed.columns else [])]
    dealt = keyed.repartitionByRange(*ranges)
    if norm is not None:
        dealt = dealt.withColumn("norm", norm)
    order = [F.col(c) for c in (*ranges, "norm")]
    in_order = Window.partitionBy(*order).orderBy(F.col("id").asc_nulls_last())
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return dealt.sortWithinPartitions(*order, F.col("id").asc_nulls_last()).select(
        *[c for c in dealt.columns if c not in ("lead", "norm")],
        F.row_number().over(in_order).alias("rn"), F.first("id").over(whole).alias("head"), F.count(F.lit(1)).over(whole).alias("n"),
    )


def split(df: DataFrame, id_col: str, text_col: str, parts: int, rows: bool) -> tuple[DataFrame, DataFrame | None]:
    """(rows of most texts, rows of frequent texts or None if there are none) with id, norm (and `row`); frequent texts also have a salt."""
    text = F.col(f"`{text_col}`")
    base = df.select(
        F.col(f"`{id_col}`").alias("id"), normalised(text).alias("norm"), (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + ROW_BYTES).cast("long").alias("bytes"),
        *([F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if rows else []),
    ).withColumn("key", F.xxhash64("norm"))
    kept = ["id", "norm", *(["row"] if rows else [])]
    hot = frequent(base, parts)
    if hot.isEmpty():
        return base.select(*kept), None
    hot = F.broadcast(hot)  # fewer than `parts` rows
    salt = F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt")
    return base.join(hot, "key", "left_anti").select(*kept), base.join(hot, "key").select(*kept, salt)


def content_sort_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; equal means identical after each run of white space became one space.
    The smallest id stays; of repeated rows with that id, one is kept. A null id sorts last.
    An empty table gives an empty result; other columns of df are not used, so their names cannot clash.
    """
    most, hot = split(df, id_col, text_col, parts, rows=False)
    out = in_runs(most).select("id", F.col("head").alias("keep_id"), F.col("n").alias("group_size"), (F.col("rn") == 1).alias("kept"), "sha")
    if hot is not None:
        runs = cut(in_runs(hot))  # rows without text: both uses below read these, so that texts are exchanged once
        same = Window.partitionBy("sha")
        heads = runs.where("rn = 1").select(  # fewer than 2 * parts rows
            "sha", "salt",
            F.min("head").over(same).alias("keep_id"), F.sum("n").over(same).alias("group_size"),
            F.first("salt").over(same.orderBy(F.col("head").asc_nulls_last(), "salt")).alias("keep_salt"),
        )
        kept = (F.col("rn") == 1) & (F.col("salt") == F.col("keep_salt"))
        out = out.unionByName(runs.join(F.broadcast(heads), ["sha", "salt"]).select("id", "keep_id", "group_size", kept.alias("kept"), "sha"))
    return out.withColumnsRenamed({"id": id_col, "sha": "text_sha256"})


def content_sort_kept(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS) -> DataFrame:
    """The rows of df that content_sort_dedup keeps, with all columns of df whatever their names."""
    most, hot = split(df, id_col, text_col, parts, rows=True)
    norm = normalised(F.col("row").getField(text_col))
    out = in_runs(most, norm).where("rn = 1").select("row")
    if hot is not None:
        first = Window.partitionBy("sha").orderBy(F.col("head").asc_nulls_last(), "salt")
        heads = in_runs(hot, norm).where("rn = 1").withColumn("k", F.row_number().over(first))  # fewer than 2 * parts rows
        out = out.unionByName(heads.where("k = 1").select("row"))
    return out.select("row.*")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort_dedup(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of equal texts stays."""
    return content_sort_kept(docs)


OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), w AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id) AS rn
  FROM n
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM w
"""
