"""Takes in new n-gram files: the stream's checkpoint is the ledger of files that are done."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from chronolex.sources.ngrams import parse_lines


def stream_lines(spark: SparkSession, folder: str, table: str, checkpoint: str, kind: str = "all") -> StreamingQuery:
    """Parses all files not yet taken in and appends them to a table; counts add up, so no order or watermark matters."""
    lines = spark.readStream.schema("value string").text(folder)
    rows = parse_lines(lines, kind).selectExpr("ngram", "inline(freqs)")
    return rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
