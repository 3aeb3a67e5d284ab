"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are byte n-grams of 2 to 4 bytes of the lower-cased text, with one space for whatever lies between
words, hashed to BUCKETS rows of an embedding table. A document is the mean of its subwords' embeddings;
a linear softmax over it is trained by stochastic gradient descent in numpy. A calibration part of the sample fits two
numbers that turn scores into probabilities: a temperature, on whole documents, and a doubt that raises it where a document has few
subwords, on draws of some of them. The rejection threshold separates the calibration documents that are predicted
rightly from as many documents of random subwords, which no language is right for: it lies in the middle of the range of confidences that
errs least, and no more than REJECT of the former stay below it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.llm.common import documents, held_out, small_batches

BUCKET_BITS = 16
DIMENSION = 16
ORDERS = (2, 3, 4)
#: Documented bound of the training sample: labelled rows over all languages, and subwords of each.
TRAIN_ROWS = 8000
TRAIN_SUBWORDS = 256
EPOCHS = 4
#: Steps that a small sample is trained for at least.
LEAST_STEPS = 300
BATCH = 64
RATE = 8.0
REJECT = 0.001
#: Numbers of subwords that calibration draws from each document, to learn how far few of them can be trusted.
DRAWS = (1, 2, 4, 8, 16)
#: Bytes that are scored at a time, so memory does not depend on the length of a text.
BLOCK = 1 << 19

LETTER = re.compile(r"[^\W\d_]")
#: Bytes outside words become a space; bytes above ASCII belong to words.
TO_WORDS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def subwords(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, bucket) of every subword in bytes of words; a subword has a space at its ends only, and not at both."""
    space = data == 0x20
    starts, buckets = [], []
    wide = data.astype(np.uint32)
    for n in ORDERS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        code = wide[:m].copy()
        inner = np.zeros(m, bool)
        for k in range(1, n):
            code = (code << np.uint32(8)) | wide[k : k + m]
            if k < n - 1:
                inner |= space[k : k + m]
        ok = ~(inner | (space[:m] & space[n - 1 :]))
        code = code[ok] * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        starts.append(np.flatnonzero(ok))
        buckets.append((code >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(starts), np.concatenate(buckets)


def as_words(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace").translate(TO_WORDS) + b" "


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  #: each bucket's contribution to the logits, BUCKETS x languages
    bias: np.ndarray
    temperature: float
    doubt: float
    threshold: float

    def probabilities(self, logits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of every language, for documents with these mean logits over so many subwords."""
        z = logits / (self.temperature * (1 + self.doubt / np.maximum(counts, 1)))[:, None]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of logits for each text, over all of its subwords, BLOCK bytes at a time, and their numbers."""
        parts = [as_words(t) for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        del parts
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts), np.int64)
        block = max(1 << 14, BLOCK // max(1, len(self.languages) // 8))
        over = max(ORDERS) - 1
        for at in range(0, len(data), block):
            # a text begins and ends with a space, so no subword crosses from one to the next
            starts, buckets = subwords(data[at : at + block + over])
            keep = starts < block
            owner = np.searchsorted(ends, starts[keep] + at, side="right")
            order_starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
            if len(owner):
                np.add.at(sums, owner[order_starts], np.add.reduceat(self.table[buckets[keep]], order_starts, axis=0))
                counts += np.bincount(owner, minlength=len(texts))
        return sums / np.maximum(counts, 1)[:, None] + self.bias, counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language or und, score, rejected) of each text."""
        some = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        best, score = ["und"] * len(texts), np.zeros(len(texts))
        if some and self.languages:
            p = self.probabilities(*self.logits([texts[i] for i in some]))
            top = p.argmax(axis=1)
            for i, k in zip(some, top, strict=True):
                best[i] = self.languages[k]
            score[some] = np.minimum(p[np.arange(len(some)), top], 1.0)
        return best, score, np.array([b == "und" for b in best], bool) | (score < self.threshold)


def spaced(texts: list[str]) -> list[list[int]]:
    """TRAIN_SUBWORDS subwords of each text, evenly spaced over all of it."""
    out = []
    for t in texts:
        starts, buckets = subwords(np.frombuffer(as_words(t), np.uint8))
        buckets = buckets[np.argsort(starts, kind="stable")]
        out.append(buckets[np.linspace(0, len(buckets) - 1, min(len(buckets), TRAIN_SUBWORDS)).astype(int)].tolist() if len(buckets) else [])
    return out


def train(sample: list[tuple[str, list[int]]], seed: int = 7) -> Model:
    """Fits the model on (language, subwords) rows; every fifth row calibrates. No rows give a model without languages."""
    rows = [(lang, np.asarray(ids, np.int64)) for lang, ids in sample if ids]
    languages = sorted({lang for lang, _ in rows})
    buckets = 1 << BUCKET_BITS
    if not languages:
        return Model([], np.zeros((buckets, 0), np.float32), np.zeros(0), 1.0, 0.0, 0.0)
    random = np.random.default_rng(seed)
    rows = [rows[i] for i in random.permutation(len(rows))]
    held = rows[::5] if len(rows) >= 50 else rows
    used = [r for i, r in enumerate(rows) if i % 5] if len(rows) >= 50 else rows
    emb = random.normal(0, 0.1, (buckets, DIMENSION)).astype(np.float32)
    out = np.zeros((DIMENSION, len(languages)), np.float32)
    out += random.normal(0, 0.1, out.shape).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    label = np.array([languages.index(lang) for lang, _ in used])
    epochs = max(EPOCHS, -(-LEAST_STEPS // -(-len(used) // BATCH)))
    steps, step = epochs * -(-len(used) // BATCH), 0
    for _ in range(epochs):
        order = random.permutation(len(used))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            ids = [used[i][1] for i in batch]
            lengths = np.array([len(x) for x in ids])
            flat = np.concatenate(ids)
            mean = np.add.reduceat(emb[flat], np.r_[0, np.cumsum(lengths)[:-1]], axis=0) / lengths[:, None]
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), label[batch]] -= 1
            p /= len(batch)
            rate = RATE * (1 - step / steps)
            back = (p @ out.T) / lengths[:, None]
            out -= rate * mean.T @ p
            bias -= 0.1 * rate * p.sum(axis=0)
            np.add.at(emb, flat, -rate * np.repeat(back, lengths, axis=0).astype(np.float32))
            step += 1
    table = (emb @ out).astype(np.float32)
    model = Model(languages, table, bias.astype(np.float64), 1.0, 0.0, 0.0)
    right = np.array([languages.index(lang) for lang, _ in held])

    def seen(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.array([table[ids].mean(axis=0) + model.bias for ids in documents]), np.array([len(ids) for ids in documents])

    def loss(cases: tuple[np.ndarray, np.ndarray], of: np.ndarray) -> float:
        return float(-np.log(np.maximum(model.probabilities(*cases)[np.arange(len(of)), of], 1e-300)).mean())

    def best(name: str, values: np.ndarray, cases, of) -> None:
        losses = []
        for v in values:
            setattr(model, name, float(v))
            losses.append(loss(cases, of))
        setattr(model, name, float(values[int(np.argmin(losses))]))

    whole = seen([ids for _, ids in held])
    best("temperature", np.geomspace(0.05, 20, 61), whole, right)
    some = seen([random.choice(ids, min(m, len(ids)), replace=False) for _, ids in held for m in DRAWS])
    best("doubt", np.r_[0, np.geomspace(0.1, 100, 31)], some, np.repeat(right, len(DRAWS)))
    p = model.probabilities(*whole)
    good = np.sort(p.max(axis=1)[p.argmax(axis=1) == right])
    noise = np.sort(model.probabilities(*seen([random.integers(0, buckets, len(ids)) for _, ids in held])).max(axis=1))
    model.threshold = between(good, noise)
    return model


def between(good: np.ndarray, noise: np.ndarray, reject: float = REJECT) -> float:
    """The middle of the widest range of confidences with the fewest errors, good ones below and noise above; both are sorted. At most
    the share `reject` of the good ones is below it.
    """
    if not len(good):
        return 0.0
    edges = np.unique(np.r_[0.0, good, noise, 1.0])
    middles = (edges[1:] + edges[:-1]) / 2
    errors = np.searchsorted(good, middles) / len(good) + 1 - np.searchsorted(noise, middles) / max(len(noise), 1)
    least = np.flatnonzero(errors <= errors.min() + 1e-12)
    t = float(middles[least[np.argmax((edges[1:] - edges[:-1])[least])]])
    return min(t, float(good[int(reject * (len(good) - 1))]))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """Fits on about `rows` labelled rows outside the held-out fold, as many of each language, chosen by hash."""
    spark = df.sparkSession
    small_batches(spark)
    usable = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col))).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    counts = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}  # one number a language
    if not counts:
        return train([])
    each = max(rows // len(counts), 50)
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, each / n))])
    place = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1 << 30)) / float(1 << 30)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("id").cast(pa.string()), b.column("lang"), pa.array(spaced(t), pa.list_(pa.int32()))], ["id", "lang", "ids"])

    picked = usable.where(place < share[F.col("lang")]).mapInArrow(features, "id string, lang string, ids array<int>").limit(2 * rows + 100 * len(counts))
    sample = sorted((r["id"], r["lang"], r["ids"]) for r in picked.collect())  # bounded by rows and TRAIN_SUBWORDS
    return train([(lang, ids) for _, lang, ids in sample])


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """id, lang_pred, score and rejected of every row, over its whole text; the id is only passed through.

    Null text and text without a letter give und, score 0, rejected. Ties between languages go to the first by
    name. Repeated rows give repeated results; an empty table an empty one. With carry, `row` is the input row.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            lang, score, rejected = m.predict(b.column("text").to_pylist())
            keep = [n for n in ("id", "row") if n in b.schema.names]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], [*keep, "lang_pred", "score", "rejected"])

    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    cols = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *row)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cols.drop("text").schema) + ", lang_pred string, score double, rejected boolean"
    return cols.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language the model rejects go."""
    small_batches(spark)
    model = spark.sparkContext.broadcast(fit(docs))

    @F.pandas_udf("boolean")
    def accepted(texts):
        import pandas as pd

        return pd.Series(~model.value.predict([None if t is None else t for t in texts])[2])

    return docs.where(accepted(F.col("text")))
