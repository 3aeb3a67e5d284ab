"""Compression classifier: dictionaries of good and bad text, and the difference in compressed size as a score.

A zstandard dictionary is built from the good and one from the bad texts of a bounded labelled sample. A text is
cut into blocks, each block is compressed with either dictionary, and the difference of the summed sizes over
the text's length is the raw score. A logistic curve fitted on a calibration part of the sample makes it a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.llm.common import documents, held_out, small_batches

#: Documented bounds of the labelled sample: rows of either label, and bytes of a row, in blocks spread over its text.
TRAIN_ROWS = 1500
TRAIN_BLOCKS = 48
BLOCK = 128
DICTIONARY = 64 << 10
LEVEL = 3
PREDICT_AT = 0.7


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
        out = []
        for data in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_AUTO)
            d.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        return out

    def scores(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -500, 500)))


def blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def difference(pair: list[zstandard.ZstdCompressor], pieces: list[bytes]) -> float:
    """(bad - good) / length of the compressed sizes, 0 for an empty text; above 0 the good dictionary fits better."""
    good, bad = (sum(map(len, map(c.compress, pieces))) for c in pair)
    return (bad - good) / sum(map(len, pieces)) if pieces else 0.0


def dictionary(samples: list[bytes]) -> bytes:
    """Content for a dictionary: the trained one's where the sample is large enough, else the sample itself."""
    total = sum(map(len, samples))
    if total > 8 * DICTIONARY and len(samples) > 100:
        try:
            return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
        except zstandard.ZstdError:
            pass  # samples too alike to train on
    return b"".join(samples)[-DICTIONARY:] or b" "


def train(sample: list[tuple[int, list[bytes]]], prior: float | None = None) -> Model:
    """Fits on (label, blocks of a text) rows; every third row of a label calibrates. Without both labels the score is their share.

    prior is the share of label 1 among all labelled rows, where the sample holds another one.
    """
    by = {k: [b for q, b in sample if q == k] for k in (1, 0)}
    share = (len(by[1]) + 1) / (len(sample) + 2)
    if not by[1] or not by[0]:
        return Model(b" ", b" ", 0.0, float(np.log(share / (1 - share))))
    build = {k: [x for i, x in enumerate(v) if i % 3] or v for k, v in by.items()}
    model = Model(dictionary([p for x in build[1] for p in x]), dictionary([p for x in build[0] for p in x]), 0.0, 0.0)
    pair = model.compressors()
    held = [(k, difference(pair, x)) for k, v in by.items() for x in v[::3]]
    y, x = np.array(held, float).T
    scale = x.std() or 1.0
    design = np.stack([x / scale, np.ones(len(x))], axis=1)
    ridge = np.diag([1e-2, 1e-6])
    w = np.zeros(2)
    for _ in range(100):  # logistic regression by damped Newton steps
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = design.T @ (design * np.maximum(p * (1 - p), 1e-6)[:, None]) + ridge
        w -= np.clip(np.linalg.solve(h, design.T @ (p - y) + ridge @ w), -1, 1)
    model.slope, model.offset = float(w[0] / scale), float(w[1])
    if prior is not None and 0 < prior < 1:
        model.offset += float(np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean())))
    return model


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Fits on about `rows` rows of either label, chosen by hash outside the held-out fold."""
    spark = df.sparkSession
    small_batches(spark)
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    counts = {r[0]: r[1] for r in marked.groupBy("label").count().collect()}
    if not counts:
        return train([])
    place = F.pmod(F.xxhash64("id", F.lit("quality sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, rows / n))])
    picked = marked.where(place < share[F.col("label")]).limit(4 * rows)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pieces = [blocks((t or "").encode("utf-8", "replace")) for t in b.column("text").to_pylist()]
            pieces = [[p[i] for i in sorted({*np.linspace(0, len(p) - 1, min(len(p), TRAIN_BLOCKS)).astype(int).tolist()})] if p else [] for p in pieces]
            yield pa.RecordBatch.from_arrays([b.column("id").cast(pa.string()), b.column("label"), pa.array(pieces, pa.list_(pa.binary()))], ["id", "label", "pieces"])

    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")  # at most 4 * rows ids
    sample = texts.select("id", "label", "text").mapInArrow(spread, "id string, label int, pieces array<binary>").limit(8 * rows).collect()
    rows_ = [(r["label"], [bytes(p) for p in r["pieces"]]) for r in sorted(sample, key=lambda r: (r["id"], r["label"]))]
    return train(rows_, counts.get(1, 0) / sum(counts.values()))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row, over its whole text. Null and empty text get the score of no difference.

    Null ids and repeated rows give a row each, an empty table gives an empty result, and other columns are not read.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shared.value.compressors()
        for b in batches:
            data = [(t or "").encode("utf-8", "replace") for t in b.column("text").to_pylist()]
            raw = np.array([difference(pair, blocks(d)) for d in data])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(shared.value.scores(raw))], ["id", "score"])

    cols = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, f"id {cols.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
