"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Each stage is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession

from chronolex.llm import dedup, jaccard, langid, mixing, packing
from chronolex.llm.common import documents
from chronolex.plans.stages import remove
from chronolex.session import shared_folder

STAGES = [
    ("language_id", langid.stage),
    ("exact_dedup", dedup.stage),
    ("ngram_jaccard_join", jaccard.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

#: Language models and genetic packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None

_runs = itertools.count()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to the documents of sf_dir. Between stages, tables live in the cluster's shared folder; each goes when the next one is whole."""
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-pipeline-{next(_runs)}"
    docs, before = documents(spark, sf_dir), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
