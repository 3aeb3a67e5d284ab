"""Saved yearly vectors, evaluation results and gold sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.operators.training import SETTINGS, parse_name
from chronolex.plans.stages import exists, listing

VECTORS = "model string, word string, vector array<float>"
SETTING_TYPES = "weight_by string, vector_size int, window int, min_count int, approach string, epochs int"
RESULTS = f"model string, year int, {SETTING_TYPES}, similarity_score double, analogy_score double"
#: Bytes under which a saved model cannot be whole.
LEAST_BYTES = 1000


def save_vectors(models: DataFrame, path: str, mode: str = "append") -> None:
    """Writes (model, word, vector) with a folder for each model, so that one model is read alone. No rows are an error."""
    if models.limit(1).isEmpty():
        raise ValueError("there are no vectors to save")
    rows = models.select("model", "word", F.col("vector").cast("array<float>").alias("vector"))
    rows.repartition("model").sortWithinPartitions("model", "word").write.mode(mode).partitionBy("model").parquet(path)


def load_vectors(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    """Saved vectors with the year and settings that their model's name states; of one model alone if it is named. A missing path is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    rows = spark.read.schema(VECTORS).parquet(path)
    rows = rows if model is None else rows.where(F.col("model") == model)
    if model is not None and rows.limit(1).isEmpty():
        raise FileNotFoundError(f"{path}: {model}")
    return rows.withColumn("p", parse_name(F.col("model"))).select("model", "p.year", *[f"p.{s}" for s in SETTINGS], "word", "vector")


def read_vector_text(spark: SparkSession, path: str) -> DataFrame:
    """word and vector from the text form: an optional head of two numbers, then a word and its numbers in every line."""
    parts = F.split("value", " ")
    rows = spark.read.text(path).select(parts[0].alias("word"), F.filter(F.slice(parts, 2, 1 << 30), lambda x: x != "").alias("numbers"))
    return rows.where(F.size("numbers") > 1).select("word", F.transform("numbers", lambda x: x.cast("float")).alias("vector"))


def write_vector_text(models: DataFrame, path: str) -> None:
    """word and vector as text, without a head, as part files are read together."""
    models.select(F.concat_ws(" ", "word", F.transform("vector", lambda x: x.cast("string"))).alias("value")).write.mode("overwrite").text(path)


def saved_models(spark: SparkSession, path: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """model, bytes and valid of every folder of saved vectors: whole are those of `least_bytes` or more, whose names state their settings."""
    sizes: dict[str, int] = {}
    for name, size in listing(spark, path) if exists(spark, path) else []:
        folder = next((p for p in name.split("/") if p.startswith("model=")), None)
        if folder and name.endswith(".parquet"):
            sizes[folder[6:]] = sizes.get(folder[6:], 0) + size
    rows = spark.createDataFrame(sorted(sizes.items()), "model string, bytes long")
    return rows.withColumn("valid", (F.col("bytes") >= least_bytes) & parse_name(F.col("model")).isNotNull())


def append_results(results: DataFrame, path: str, overwrite: bool = False) -> None:
    """Adds evaluation results, scores that were not computed as null, to a folder of CSV files with a head each."""
    columns = [c.split() for c in RESULTS.split(", ")]
    rows = results.select(*[(F.col(n) if n in results.columns else F.lit(None)).cast(t).alias(n) for n, t in columns])
    rows.write.mode("overwrite" if overwrite else "append").option("header", True).csv(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULTS).option("header", True).csv(path)


def similarity_pairs(spark: SparkSession, path: str) -> DataFrame:
    """w1, w2 and score from tab-separated lines; comments and lines without a number are left out, words are lower-cased."""
    parts = F.split(F.btrim("value"), "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(parts) == 3)
    rows = rows.select(F.lower(parts[0]).alias("w1"), F.lower(parts[1]).alias("w2"), parts[2].try_cast("double").alias("score"))
    return rows.where("score IS NOT NULL")


def analogies(spark: SparkSession, path: str) -> DataFrame:
    """section, a, b, c and d from lines of four words, lower-cased; a line `: name` begins a section.

    The file is read whole as one row, since a section's name holds for the lines after it; gold sets have some thousand lines.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    from pyspark.sql import Window

    named = F.when(F.col("line").startswith(":"), F.btrim(F.substring("line", 2, 1 << 20)))
    rows = lines.withColumn("section", F.last(named, ignorenulls=True).over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.split(F.lower(F.btrim("line")), r"\s+")
    return rows.where(~F.col("line").startswith(":")).where(F.size(parts) == 4).select("section", *[parts[i].alias(c) for i, c in enumerate("abcd")])
