"""Training and keeping yearly word embeddings: the grid of settings, what is left to train, and the trainer."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.functions.tokens import UNK

SETTINGS = ("weight_by", "vector_size", "window", "min_count", "approach", "epochs")
# The form of model names; the first has fields of three digits, as written, the second fields of any width.
STRICT_NAME = r"^w2v_y(\d+)_wb(\w+)_vs(\d{3})_w(\d{3})_mc(\d{3})_sg(\d+)_e(\d{3})\.kv"
NAME = r"^w2v_y(\d+)_wb([a-z_]+)_vs(\d+)_w(\d+)_mc(\d+)_sg(\d)_e(\d+)\.kv$"


def grid(spark: SparkSession, years: list[int], **choices: list) -> DataFrame:
    """Every year with every combination of settings; choices are the query's own lists."""
    rows = list(itertools.product(years, *(choices[s] for s in SETTINGS)))
    return spark.createDataFrame(rows, "year int, weight_by string, vector_size int, window int, min_count int, approach string, epochs int")


def model_name() -> Column:
    pad = lambda c: F.lpad(F.col(c).cast("string"), 3, "0")
    approach = F.when(F.col("approach") == "skip-gram", "1").otherwise("0")
    return F.concat(
        F.lit("w2v_y"), F.col("year").cast("string"), F.lit("_wb"), F.col("weight_by"), F.lit("_vs"), pad("vector_size"), F.lit("_w"), pad("window"),
        F.lit("_mc"), pad("min_count"), F.lit("_sg"), approach, F.lit("_e"), pad("epochs"), F.lit(".kv"),
    )


def parse_name(name: Column, strict: bool = False) -> Column:
    """Year and settings of a model's name, null for other names; strict: only fields of three digits, as model_name writes them."""
    pattern = STRICT_NAME if strict else NAME
    part = lambda i: F.regexp_extract(name, pattern, i)
    number = lambda i: part(i).try_cast("int")
    return F.when(
        name.rlike(pattern),
        F.struct(
            number(1).alias("year"), part(2).alias("weight_by"), number(3).alias("vector_size"), number(4).alias("window"),
            number(5).alias("min_count"), F.when(part(6) == "1", "skip-gram").otherwise("CBOW").alias("approach"), number(7).alias("epochs"),
        ),
    )


def model_folders(corpus: str, suffix: str) -> tuple[str, str, str]:
    """(table of the corpus, folder of models, folder of logs) for a corpus folder that ends with the size of its n-grams."""
    name = corpus.rstrip("/").rsplit("/", 1)[-1]
    if not name.endswith("gram_files") or "NLP_corpora" not in corpus:
        raise ValueError(f"{corpus!r} is no folder of n-gram files below NLP_corpora")
    base = corpus.rstrip("/").replace("NLP_corpora", "NLP_models")
    return f"{corpus.rstrip('/')}/{name.removesuffix('gram_files')}grams_pivoted.db", f"{base}/models_{suffix}", f"{base}/logs_{suffix}/training"


def to_train(wanted: DataFrame, saved: DataFrame, mode: str = "resume") -> tuple[DataFrame, DataFrame]:
    """(settings to train, names of saved models to remove) by mode; saved has model and valid.

    resume keeps whole models and removes broken ones; restart removes all; new takes models to be there for an error.
    """
    if mode not in ("resume", "restart", "new"):
        raise ValueError(f"unknown mode {mode!r}")
    named = saved.withColumn("p", parse_name(F.col("model")))
    if mode == "restart":
        return wanted, saved.select("model")
    if mode == "new":
        if not saved.limit(1).isEmpty():
            raise FileExistsError("there are models already")
        return wanted, saved.select("model")
    whole = named.where("valid").select("p.year", *[f"p.{s}" for s in SETTINGS])
    return untrained(wanted, whole), saved.where("NOT valid").select("model")


def untrained(wanted: DataFrame, models: DataFrame) -> DataFrame:
    """Settings of which there is no model yet."""
    return wanted.join(models, ["year", *SETTINGS], "left_anti")


def latest(models: DataFrame) -> DataFrame:
    """The last model by name of every year."""
    return models.groupBy("year").agg(F.max("model").alias("model"))


def by_settings(results: DataFrame, settings: list[str], metric: str) -> DataFrame:
    return results.groupBy(*settings).agg(F.avg(metric).alias("mean"), F.count(F.lit(1)).alias("n"))


def train_one(sentences: list[np.ndarray], weights: np.ndarray, counts: np.ndarray, size: int, window: int, epochs: int, skip_gram: bool, negative: int = 5, rate: float = 0.025, seed: int = 1, batch: int = 256, losses: list[float] | None = None) -> np.ndarray:
    """Skip-gram or CBOW with negative sampling, in batches; a sentence's weight scales its steps.

    losses, if given, gets the mean negative log-likelihood of every epoch.
    """
    rng = np.random.default_rng(seed)
    vocabulary = len(counts)
    inner = ((rng.random((vocabulary, size)) - 0.5) / size).astype(np.float32)
    outer = np.zeros((vocabulary, size), np.float32)
    noise = np.cumsum(counts**0.75)
    lengths = np.array([len(s) for s in sentences], int)
    flat = np.concatenate([*sentences, np.zeros(0, int)]).astype(int)
    owner = np.repeat(np.arange(len(sentences)), lengths)
    centre, context, weight = [], [], []
    for d in range(1, min(window, int(lengths.max(initial=0)) - 1) + 1):  # words d places apart in a sentence, both ways
        i = np.flatnonzero(owner[d:] == owner[:-d])
        centre += [flat[i], flat[i + d]]
        context += [flat[i + d], flat[i]]
        weight += [weights[owner[i]]] * 2
    if not sum(map(len, centre)):
        return inner
    centre, context, weight = (np.concatenate(x) for x in (centre, context, weight))
    if not skip_gram:  # the context word predicts the centre
        centre, context = context, centre
    weight = weight / weight.mean()
    steps, step = epochs * -(-len(centre) // batch), 0
    for _ in range(epochs):
        order, loss = rng.permutation(len(centre)), 0.0
        for at in range(0, len(order), batch):
            b = order[at : at + batch]
            target = np.column_stack([context[b], np.searchsorted(noise, rng.random((len(b), negative)) * noise[-1])])
            goal = np.zeros(target.shape, np.float32)
            goal[:, 0] = 1
            goal[:, 1:][target[:, 1:] == target[:, :1]] = 1
            v, u = inner[centre[b]], outer[target]
            g = 1 / (1 + np.exp(-np.clip(np.einsum("bd,bkd->bk", v, u), -20, 20)))
            loss -= float(np.log(np.maximum(np.where(goal > 0, g, 1 - g), 1e-12)).sum())
            g -= goal
            g *= (weight[b] * max(rate * (1 - step / steps), rate * 1e-2))[:, None]
            np.add.at(outer, target, -(g[:, :, None] * v[:, None, :]).astype(np.float32))
            np.add.at(inner, centre[b], -np.einsum("bk,bkd->bd", g, u).astype(np.float32))
            step += 1
        if losses is not None:
            losses.append(loss / len(centre))
    return inner


def train(corpus: DataFrame, wanted: DataFrame, seed: int = 1, unk: str = "reject") -> DataFrame:
    """year, settings, word and vector, one model a task: its corpus is the weighted distinct n-grams of a year.

    corpus has year, tokens, weight; wanted the grid. The corpus of a year goes once to each of its models; if it has weight_by too,
    to those that are weighted so. unk says what becomes of
    sentences with UNK: reject drops them, strip takes UNK out and keeps what has two words left, retain trains a vector for it.
    """
    if unk not in ("reject", "strip", "retain"):
        raise ValueError(f"unknown policy {unk!r}")
    if unk == "reject":
        corpus = corpus.where(~F.array_contains("tokens", UNK))
    elif unk == "strip":
        corpus = corpus.withColumn("tokens", F.array_remove("tokens", UNK)).where(F.size("tokens") > 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        pdf = pdf.sort_values("line")
        lists = [list(t) for t in pdf["tokens"]]
        counts: dict[str, int] = {}
        for t, w in zip(lists, pdf["weight"], strict=True):
            for x in t:
                counts[x] = counts.get(x, 0) + int(w)
        words = sorted(w for w, n in counts.items() if n >= first["min_count"])
        index = {w: i for i, w in enumerate(words)}
        ids = [np.array([index[x] for x in t if x in index], int) for t in lists]
        vectors = train_one(ids, pdf["weight"].to_numpy(float), np.array([counts[w] for w in words], float), int(first["vector_size"]), int(first["window"]), int(first["epochs"]), first["approach"] == "skip-gram", seed=seed) if words else []
        return pd.DataFrame({"year": first["year"], **{s: first[s] for s in SETTINGS}, "word": words, "vector": list(vectors)})

    rows = corpus.withColumn("line", F.concat_ws(" ", "tokens")).join(F.broadcast(wanted), [c for c in ("year", "weight_by") if c in corpus.columns])  # the grid is the query's own
    return rows.groupBy("year", *SETTINGS).applyInPandas(run, "year int, weight_by string, vector_size int, window int, min_count int, approach string, epochs int, word string, vector array<float>")
