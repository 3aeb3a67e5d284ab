"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.session import shared_folder

#: ASCII white space of the contracts: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes that one Arrow batch may hold, so that a batch of long texts stays in memory and one of numbers is no small change.
ARROW_ROWS, ARROW_BYTES = 8192, 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by rows and bytes; texts vary from one word to megabytes."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage through a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def few(df: DataFrame) -> DataFrame:
    """A table of a few numbers a row in one partition for each core, so that the next exchange writes few files."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def sweep(spark: SparkSession) -> None:
    """Lets Spark remove the exchange files of earlier rounds now.

    It removes them when the driver's garbage collector finds their plans unused, which a driver with a large heap does
    late; an iterative operator would fill the executors' disks meanwhile.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def words_count(text: Column) -> Column:
    """Number of words in the sense of WORD; null or blank text has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def held_out(doc_id: Column) -> Column:
    """The fold that classifiers never learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
