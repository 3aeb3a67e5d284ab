"""What a run has done: counts by state, ratios of rows, and throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_counts(units: DataFrame, split: str = "parent_id") -> DataFrame:
    """One row: units by status, those that others were split from, and the workers that hold one. units has unit_id, status, claimed_by and parent_id.

    A unit that was split no longer counts by its status.
    """
    parents = units.where(F.col(split).isNotNull()).select(F.col(split).alias("unit_id")).distinct().withColumn("was_split", F.lit(True))
    rows = units.join(parents, "unit_id", "left").withColumn("whole", F.col("was_split").isNull())
    count = lambda state: F.count_if(F.col("whole") & (F.col("status") == state)).alias(state)
    workers = F.count_distinct(F.when(F.col("whole") & (F.col("status") == "processing"), F.col("claimed_by"))).alias("workers")
    return rows.agg(*[count(s) for s in ("pending", "processing", "completed", "failed")], F.count_if("was_split").alias("split"), workers)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is no whole: what a filter kept, or how much a pivot expanded."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def throughput(files: DataFrame, seconds: float) -> DataFrame:
    """One row over files (bytes, error): done, failed, seconds a file, files an hour and mebibytes a second."""
    ok = F.count_if(F.col("error").isNull())
    each = F.when(ok > 0, F.lit(float(seconds)) / ok).otherwise(F.lit(0.0))
    return files.agg(
        ok.alias("done"), F.count_if(F.col("error").isNotNull()).alias("failed"), each.alias("seconds_a_file"),
        F.when(each > 0, 3600 / each).otherwise(F.lit(0.0)).alias("files_an_hour"),
        (F.coalesce(F.sum("bytes"), F.lit(0)) / (1 << 20) / float(seconds) if seconds > 0 else F.lit(0.0)).alias("mebibytes_a_second"),
    )
