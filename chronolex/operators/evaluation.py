"""Evaluation of all saved models in one plan, taken up again where an earlier run ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.operators import embeddings as emb
from chronolex.operators.training import SETTINGS
from chronolex.plans.stages import exists
from chronolex.sources import models as src


def scores(vectors: DataFrame, pairs: DataFrame | None, questions: DataFrame | None) -> DataFrame:
    """model, year, settings and the scores that gold sets are given for; a model that knows none of their words has null.

    The operators group by year; here each model stands for one.
    """
    names = vectors.select("model", "year", *SETTINGS).distinct()
    rows = vectors.select(F.col("model").alias("year"), "word", "vector")
    out = names
    if pairs is not None:
        found = emb.spearman(rows, pairs).select(F.col("year").alias("model"), F.col("spearman").alias("similarity_score"))
        out = out.join(found, "model", "left")
    if questions is not None:
        found = emb.analogy_accuracy(rows, questions).select(F.col("year").alias("model"), F.col("accuracy").alias("analogy_score"))
        out = out.join(found, "model", "left")
    return out


def evaluate_models(spark: SparkSession, vectors_path: str, results_path: str, pairs: DataFrame | None = None, questions: DataFrame | None = None, mode: str = "append") -> int:
    """Evaluates saved models and adds their results; `append` leaves out models that have results, `overwrite` takes all anew.

    Returns the number of models that were evaluated. Models that are not whole are left out.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    wanted = src.saved_models(spark, vectors_path).where("valid").select("model")
    if mode == "append" and exists(spark, results_path):
        wanted = wanted.join(src.read_results(spark, results_path).select("model"), "model", "left_anti")
    n = wanted.count()
    if n:
        vectors = src.load_vectors(spark, vectors_path).join(F.broadcast(wanted), "model", "left_semi")  # names of a folder's models
        src.append_results(scores(vectors, pairs, questions), results_path, mode == "overwrite")
    return n
