"""Stage control: what a job has to do again, which files a table has taken in, and sinks."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.operators.ngrams import merge_sum

MODES = ("restart", "resume", "reprocess")


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _hadoop(spark, path)
    return files.exists(where)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of all files below a folder, by the folder's own file system."""
    where, files = _hadoop(spark, path)
    out, found = [], files.listFiles(where, True)
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen()))
    return out


def remove(spark: SparkSession, path: str) -> bool:
    where, files = _hadoop(spark, path)
    return files.delete(where, True)


def open_table(spark: SparkSession, path: str, mode: str = "r") -> DataFrame | None:
    """A table to read (`r`; a missing one is an error), to add to (`rw`; None if there is none yet) or to begin anew (`w`; what is there goes)."""
    if mode not in ("r", "rw", "w"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "w":
        remove(spark, path)
        return None
    if not exists(spark, path):
        if mode == "r":
            raise FileNotFoundError(path)
        return None
    return spark.read.parquet(path)


def run_stage(spark: SparkSession, build, path: str, mode: str = "resume", partition_by: str | None = None, plan: str | None = None) -> DataFrame:
    """Writes build() to path and reads it back; resume keeps a table that a whole earlier run committed.

    restart and reprocess write it anew; restart also drops the saved plan (`save_plan`), so that work is cut anew too, while reprocess keeps it.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "restart" and plan is not None:
        Path(plan).unlink(missing_ok=True)
    if mode != "resume" or not exists(spark, f"{path}/_SUCCESS"):
        out = build()
        if partition_by:
            out = out.repartition(partition_by).sortWithinPartitions(*[c for c in (partition_by, "ngram") if c in out.columns])
        writer = out.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.parquet(path)


LEDGER = "file string, intake long"


def ledger_rows(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's (file, intake) rows, none before the first intake."""
    return spark.read.schema(LEDGER).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], LEDGER)


def taken_files(spark: SparkSession, ledger: str) -> DataFrame:
    """Names of the files that were taken in, in order."""
    return ledger_rows(spark, ledger).select("file").distinct().orderBy("file")


def ingest(spark: SparkSession, files: DataFrame, read, table: str, ledger: str) -> int:
    """Takes in the files that the ledger lacks, files without rows too; returns their number.

    Rows go to a folder of their own, and the ledger's rows, which name that folder, are the commit: rows of an intake that broke off
    before it are not read by `taken_in`, and the next intake writes over them.
    """
    done = ledger_rows(spark, ledger)
    left = files.join(done.select(F.col("file").alias("filename")), "filename", "left_anti")
    names = [r["url"] for r in left.select("url").collect()]  # a listing has a few thousand files at most
    if names:
        intake = (done.agg(F.max("intake")).first()[0] or 0) + 1
        read(names).write.mode("overwrite").parquet(f"{table}/intake={intake}")
        files.where(F.col("url").isin(names)).select(F.col("filename").alias("file"), F.lit(intake).cast("long").alias("intake")).distinct().coalesce(1).write.mode("append").parquet(ledger)
    return len(names)


def taken_in(spark: SparkSession, table: str, ledger: str) -> DataFrame:
    """The rows of all committed intakes."""
    rows = spark.read.parquet(table)
    whole = ledger_rows(spark, ledger).select("intake").distinct()
    return rows.join(F.broadcast(whole), rows["intake"] == whole["intake"], "left_semi").drop("intake")  # one row an intake


def joined_shards(spark: SparkSession, shards: list[str]) -> DataFrame:
    """Shards that were written apart as one table with each n-gram and year once. A shard without its commit mark is an error, so none is lost unseen."""
    broken = [s for s in shards if not exists(spark, f"{s}/_SUCCESS")]
    if broken:
        raise RuntimeError(f"shards that were not written whole: {broken}")
    return merge_sum(spark.read.parquet(*shards))


def reconcile(expected: DataFrame, written: DataFrame, key: str) -> None:
    """Raises if a key that was to be written is missing."""
    missing = expected.select(key).distinct().join(written.select(key).distinct(), key, "left_anti").count()
    if missing:
        raise RuntimeError(f"{missing} of the expected {key} values were not written")


def write_whitelist(vocabulary: DataFrame, path: str, separator: str = "\t", column: str = "ngram") -> int:
    """token and total as text in rank order, into a temporary file that replaces path at once. The vocabulary is bounded by its top_k."""
    folder = Path(path).parent
    folder.mkdir(parents=True, exist_ok=True)
    n = 0
    with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
        for n, row in enumerate(vocabulary.orderBy(F.desc("total"), F.asc(column)).toLocalIterator(), 1):
            f.write(f"{row[column]}{separator}{row['total']}\n")
    os.replace(f.name, path)
    return n


def compact(df: DataFrame, path: str, key: str = "ngram") -> None:
    """Rewrites a table as few files with ranges of keys, sorted."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_sentences(df: DataFrame, path: str) -> None:
    """One sentence a line, tokens between spaces."""
    df.select(F.concat_ws(" ", "tokens").alias("value")).write.mode("overwrite").text(path)


def archive(spark: SparkSession, path: str, target: str, level: int = 3) -> None:
    """A densely packed copy of a table, for keeping; `restore` unpacks it. What stands at the target goes."""
    spark.read.parquet(path).write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).parquet(target)


def restore(spark: SparkSession, archived: str, path: str) -> DataFrame:
    """Unpacks an archived table. A table at the path is an error."""
    spark.read.parquet(archived).write.mode("error").parquet(path)
    return spark.read.parquet(path)


def archive_path(stub: str, path: str, source_stub: str) -> str:
    """Where a table is kept: the same place below the archive's stub as below the source's."""
    if not path.startswith(source_stub.rstrip("/") + "/"):
        raise ValueError(f"{path} is not below {source_stub}")
    return stub.rstrip("/") + path[len(source_stub.rstrip("/")) :]


def save_plan(path: str, plan: dict) -> None:
    """Writes a plan (boundaries of work and how they came about) at once."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=Path(path).parent, delete=False, encoding="utf-8") as f:
        f.write(json.dumps(plan, indent=2, sort_keys=True))
    os.replace(f.name, path)


def load_plan(path: str) -> dict | None:
    return json.loads(Path(path).read_text()) if Path(path).exists() else None


def plans(folder: str) -> list[str]:
    """Names of the saved plans of a folder."""
    return sorted(p.stem for p in Path(folder).glob("*.json"))


def clear_plans(folder: str, name: str | None = None) -> int:
    """Removes one saved plan, or all; returns how many went."""
    gone = [p for p in Path(folder).glob("*.json") if name in (None, p.stem)]
    for p in gone:
        p.unlink()
    return len(gone)
