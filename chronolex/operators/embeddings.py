"""Operators over yearly embeddings: rows of year, word, vector."""

from __future__ import annotations

import itertools
import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolex.functions.vectors import cosine, dot, doubles, norm, unit
from chronolex.session import settled


def normalised(models: DataFrame) -> DataFrame:
    return models.withColumn("vector", unit(F.col("vector")))


def is_normalised(models: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """year and whether every vector has length 1."""
    return models.groupBy("year").agg((F.max(F.abs(norm(F.col("vector")) - 1)) < tolerance).alias("normalised"))


def restricted(models: DataFrame, words: DataFrame) -> DataFrame:
    return models.join(words.select("word").distinct(), "word", "left_semi")


def shared_by_all(models: DataFrame) -> DataFrame:
    """Words that every year has."""
    years = models.select("year").distinct().agg(F.count(F.lit(1)).alias("n_years"))
    words = models.groupBy("word").agg(F.count_distinct("year").alias("n"))
    return words.join(F.broadcast(years), F.col("n") == F.col("n_years")).select("word")  # one row


def word_similarity(models: DataFrame, w1: str, w2: str) -> DataFrame:
    """year and the cosine of two words; years that lack one have no row."""
    return two_words(models, w1, w2).select("year", cosine(F.col("a"), F.col("b")).alias("cosine"))


def two_words(models: DataFrame, w1: str, w2: str) -> DataFrame:
    a = models.where(F.col("word") == w1).select("year", F.col("vector").alias("a"))
    return a.join(models.where(F.col("word") == w2).select("year", F.col("vector").alias("b")), "year")


def model_similarity(models: DataFrame, pairs: DataFrame) -> DataFrame:
    """For (year, other) pairs: mean, population deviation and number of the dot products of the words they share."""
    a = models.select("year", "word", F.col("vector").alias("a"))
    b = models.select(F.col("year").alias("other"), "word", F.col("vector").alias("b"))
    both = pairs.join(a, "year").join(b, ["other", "word"]).withColumn("s", dot(F.col("a"), F.col("b")))
    return both.groupBy("year", "other").agg(F.avg("s").alias("mean"), F.stddev_pop("s").alias("std"), F.count(F.lit(1)).alias("shared"))


def previous_years(models: DataFrame) -> DataFrame:
    """Each year with the available year before it. One row a year."""
    years = models.select("year").distinct()
    return years.withColumn("other", F.lag("year").over(Window.orderBy("year"))).where("other IS NOT NULL")


def mean_relatedness(models: DataFrame, word: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """year and the mean cosine of a word to all others but the excluded.

    The mean of dot products is the dot product with the mean of the unit vectors: summed by component, so no pairs arise.
    """
    others = models.where((F.col("word") != word) & ~F.col("word").isin(*excluded)) if excluded else models.where(F.col("word") != word)
    parts = others.select("year", "word", F.posexplode(unit(F.col("vector"))).alias("i", "x")).groupBy("year", "i").agg(F.avg("x").alias("m"))
    centre = parts.groupBy("year").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("centre"))  # one vector a year
    own = models.where(F.col("word") == word).select("year", unit(F.col("vector")).alias("v"))
    return own.join(centre, "year", "left").select("year", F.coalesce(dot(F.col("v"), F.col("centre")), F.lit(0.0)).alias("mean"))


def cross_covariance(models: DataFrame, anchor: int) -> DataFrame:
    """year and the flattened matrix of sums over shared words of (anchor vector) x (own vector), summed in Arrow batches."""
    ref = models.where(F.col("year") == anchor).select("word", doubles(F.col("vector")).alias("ref"))
    both = models.select("year", "word", doubles(F.col("vector")).alias("own")).join(ref, "word")

    def partial(frames):
        held: dict[int, np.ndarray] = {}
        for pdf in frames:
            for year, g in pdf.groupby("year"):
                block = np.stack(g["ref"].to_list()).T @ np.stack(g["own"].to_list())
                held[year] = held.get(year, 0) + block
        if held:
            yield pd.DataFrame({"year": list(held), "m": [b.ravel() for b in held.values()]})

    sums = both.select("year", "ref", "own").mapInPandas(partial, "year int, m array<double>")
    cells = sums.select("year", F.posexplode("m").alias("i", "x")).groupBy("year", "i").agg(F.sum("x").alias("x"))
    return cells.groupBy("year").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("m"))  # d x d numbers a year


def rotations(models: DataFrame, anchor: int) -> dict[int, np.ndarray]:
    """The orthogonal matrix of each year that turns its vectors onto the anchor's; years that share no word are an error."""
    out = {}
    for row in cross_covariance(models, anchor).collect():  # a matrix of d x d a year
        d = math.isqrt(len(row["m"]))
        u, _, vt = np.linalg.svd(np.array(row["m"]).reshape(d, d).T)
        out[row["year"]] = u @ vt
    missing = {r["year"] for r in models.select("year").distinct().collect()} - set(out)
    if missing:
        raise ValueError(f"no shared words with {anchor}: {sorted(missing)}")
    return out


def aligned(models: DataFrame, anchor: int, vocabulary: str = "anchor") -> DataFrame:
    """Unit vectors of every year turned onto the anchor's, over the words shared with it, or by all years."""
    models = normalised(models)
    words = shared_by_all(models) if vocabulary == "all" else models.where(F.col("year") == anchor).select("word")
    models = restricted(models, words)
    turn = models.sparkSession.sparkContext.broadcast(rotations(models, anchor))  # d x d numbers a year

    def run(frames):
        for pdf in frames:
            parts = []
            for year, g in pdf.groupby("year"):
                parts.append(g.assign(vector=list(np.stack(g["vector"].to_list()) @ turn.value[year])))
            yield pd.concat(parts) if parts else pdf

    return models.select("year", "word", "vector").mapInPandas(run, "year int, word string, vector array<double>")


def alignment_quality(models: DataFrame, anchor: int, tolerance: float = 1e-3, entry_tolerance: float = 1e-6) -> DataFrame:
    """year, distance of the best rotation from the identity, verdict (minimal, small, significant), whether the distance is below
    `tolerance`, and whether every entry is within `entry_tolerance`.
    """
    rows = [(year, float(np.linalg.norm(r - np.eye(len(r)))), bool((np.abs(r - np.eye(len(r))) < entry_tolerance).all())) for year, r in sorted(rotations(models, anchor).items())]
    df = models.sparkSession.createDataFrame(rows, "year int, distance double, identical boolean")
    verdict = F.when(F.col("distance") < 1e-4, "minimal").when(F.col("distance") < 1e-2, "small").otherwise("significant")
    return df.select("year", "distance", verdict.alias("verdict"), (F.col("distance") < tolerance).alias("aligned"), "identical")


def association(models: DataFrame, sets: DataFrame) -> DataFrame:
    """year, set (T1, T2), word and its mean cosine to A1 less that to A2; words a year lacks drop out. sets has set and word."""
    vectors = models.join(F.broadcast(sets), "word").select("year", "set", "word", "vector")  # the word sets are the query
    targets = vectors.where(F.col("set").isin("T1", "T2"))
    attributes = vectors.where(F.col("set").isin("A1", "A2")).select("year", F.col("set").alias("a"), F.col("vector").alias("av"))
    both = targets.join(attributes, "year").withColumn("c", cosine(F.col("vector"), F.col("av")))
    means = both.groupBy("year", "set", "word").agg(F.avg(F.when(F.col("a") == "A1", F.col("c"))).alias("m1"), F.avg(F.when(F.col("a") == "A2", F.col("c"))).alias("m2"))
    return means.select("year", "set", "word", (F.col("m1") - F.col("m2")).alias("s"))


def set_cosines(models: DataFrame, sets: DataFrame) -> DataFrame:
    """year, set (T1, T2), word, a (A1, A2), aw and c: the cosines of all targets and attributes of a year; the word sets are the query's own."""
    vectors = models.join(F.broadcast(sets), "word").select("year", "set", "word", "vector")
    targets, attributes = vectors.where(F.col("set").isin("T1", "T2")), vectors.where(F.col("set").isin("A1", "A2"))
    both = targets.join(attributes.select("year", F.col("set").alias("a"), F.col("word").alias("aw"), F.col("vector").alias("av")), "year")
    return both.select("year", "set", "word", "a", "aw", cosine(F.col("vector"), F.col("av")).alias("c"))


def weat(models: DataFrame, sets: DataFrame, variant: str = "words") -> DataFrame:
    """year, effect size, the difference of the mean associations of T1 and T2 in standard deviations, and that deviation.

    words: over the targets' associations, with the sample deviation. pairwise: over all cosines of targets and attributes.
    Without variance the effect is null.
    """
    if variant == "words":
        a = association(models, sets)
        out = a.groupBy("year").agg((F.avg(F.when(F.col("set") == "T1", F.col("s"))) - F.avg(F.when(F.col("set") == "T2", F.col("s")))).alias("d"), F.stddev_samp("s").alias("std"))
    else:
        mean = lambda t, a: F.avg(F.when((F.col("set") == t) & (F.col("a") == a), F.col("c")))
        out = set_cosines(models, sets).groupBy("year").agg((mean("T1", "A1") - mean("T1", "A2") - mean("T2", "A1") + mean("T2", "A2")).alias("d"), F.stddev_samp("c").alias("std"))
    return out.select("year", F.when(F.col("std") > 0, F.col("d") / F.col("std")).alias("effect"), "std")


def weat_series(models: DataFrame, sets: DataFrame, confidence: float = 0.95) -> DataFrame:
    """year, effect and half the width of its band: z times the deviation, where years without one take the mean of the others, 0 if none has any."""
    rows = weat(models, sets).withColumn("std", F.when(F.col("std") > 0, F.col("std")))
    mean = rows.agg(F.avg("std").alias("mean_std"))  # one row
    z = NormalDist().inv_cdf((1 + confidence) / 2)
    return rows.join(F.broadcast(mean)).select("year", "effect", (F.lit(z) * F.coalesce("std", "mean_std", F.lit(0.0))).alias("band"))


def weat_p_values(models: DataFrame, sets: DataFrame, permutations: int | None, seed: int, two_tailed: bool = True) -> DataFrame:
    """year and the share of splits of the targets whose difference of sums reaches the observed one; a year's targets are few.

    permutations random splits; None takes every split once, so the result is exact. 0 gives null.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["set", "word"])
        s, n = pdf["s"].to_numpy(), int((pdf["set"] == "T1").sum())
        fold = abs if two_tailed else (lambda x: x)
        seen = fold(s[:n].sum() - s[n:].sum())
        rng = np.random.default_rng(seed)
        first = (s[list(c)].sum() for c in itertools.combinations(range(len(s)), n)) if permutations is None else (rng.permutation(s)[:n].sum() for _ in range(permutations))
        hits = [fold(2 * x - s.sum()) >= seen - 1e-12 for x in first]
        return pd.DataFrame({"year": [pdf["year"].iloc[0]], "p": [float(np.mean(hits)) if hits else np.nan]})

    return association(models, sets).groupBy("year").applyInPandas(run, "year int, p double")


def weat_pairwise_p_values(models: DataFrame, sets: DataFrame, permutations: int | None, seed: int) -> DataFrame:
    """year and the share of splits of the targets whose pairwise effect is at least the observed one (one tail); None takes every split."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.pivot_table(index=["set", "word"], columns=["a", "aw"], values="c").sort_index()
        c, n = table.to_numpy(), int((table.index.get_level_values(0) == "T1").sum())
        sign = np.where(table.columns.get_level_values(0) == "A1", 1.0, -1.0)
        share = sign / np.where(sign > 0, (sign > 0).sum(), (sign < 0).sum())
        own = c @ share  # mean cosine to A1 less that to A2; the deviation is over all cosines, so it is the same for every split
        rng, m = np.random.default_rng(seed), len(own)
        splits = itertools.combinations(range(m), n) if permutations is None else (rng.permutation(m)[:n].tolist() for _ in range(permutations))
        effect = lambda at: own[list(at)].mean() - np.delete(own, list(at)).mean()
        seen = effect(range(n))
        hits = [effect(at) >= seen - 1e-12 for at in splits]
        return pd.DataFrame({"year": [pdf["year"].iloc[0]], "p": [float(np.mean(hits)) if hits and 0 < n < m else np.nan]})

    return set_cosines(models, sets).groupBy("year").applyInPandas(run, "year int, p double")


def spearman(models: DataFrame, pairs: DataFrame) -> DataFrame:
    """year and the rank correlation of cosines with scores, over the pairs whose words the year has; ties share their mean rank.

    pairs has w1, w2 and score: a gold set of a few hundred rows, so a year's ranks are one small window.
    """
    a = models.select("year", F.col("word").alias("w1"), F.col("vector").alias("a"))
    b = models.select("year", F.col("word").alias("w2"), F.col("vector").alias("b"))
    # rounded so that cosines that are equal up to summation order tie
    both = F.broadcast(pairs).join(a, "w1").join(b, ["year", "w2"]).withColumn("c", F.round(cosine(F.col("a"), F.col("b")), 9))

    def mean_rank(column: str):
        ties = Window.partitionBy("year", column)
        return F.rank().over(Window.partitionBy("year").orderBy(column)) + (F.count(F.lit(1)).over(ties) - 1) / 2

    return both.withColumn("r1", mean_rank("c")).withColumn("r2", mean_rank("score")).groupBy("year").agg(F.corr("r1", "r2").alias("spearman"), F.count(F.lit(1)).alias("pairs"))


def analogy_accuracy(models: DataFrame, analogies: DataFrame) -> DataFrame:
    """year and the share of a : b = c : d that the nearest word to b - a + c, other than the three, gets right.

    A year's questions, a few thousand gold rows, go as one matrix to every batch of its vocabulary; each batch gives its best word of every
    question, and max_by reduces these. Similarities are rounded, ties go to the word that sorts last.
    """
    unitary = normalised(models).select("year", "word", "vector")
    v = lambda n: unitary.select("year", F.col("word").alias(n), F.col("vector").alias(f"v{n}"))
    known = F.broadcast(analogies.select(*"abcd")).join(v("a"), "a").join(v("b"), ["year", "b"]).join(v("c"), ["year", "c"])
    known = known.join(unitary.select("year", F.col("word").alias("d")), ["year", "d"])
    target = F.zip_with(F.zip_with("vb", "va", lambda x, y: x - y), "vc", lambda x, y: x + y)
    asked = settled(known.select("year", F.xxhash64("year", *"abcd").alias("q"), *"abcd", target.alias("target")).dropDuplicates(["year", *"abcd"]))
    questions = asked.groupBy("year").agg(F.collect_list(F.struct("q", *"abc", "target")).alias("asked"))  # a gold set a year

    def best(frames):
        for pdf in frames:
            rows = []
            for year, g in pdf.groupby("year"):
                words, asked_ = g["word"].to_numpy(object), g["asked"].iloc[0]
                near = np.round(np.stack([q["target"] for q in asked_]) @ np.stack(g["vector"].to_list()).T, 9)
                order = np.argsort(words)  # of equal similarities the last word wins
                for q, s in zip(asked_, near[:, order], strict=True):
                    s = np.where(np.isin(words[order], [q["a"], q["b"], q["c"]]), -np.inf, s)
                    k = len(s) - 1 - int(np.argmax(s[::-1]))
                    if s[k] > -np.inf:
                        rows.append((year, q["q"], words[order][k], float(s[k])))
            yield pd.DataFrame(rows, columns=["year", "q", "word", "near"])

    met = unitary.join(F.broadcast(questions), "year").select("year", "word", "vector", "asked")  # gold questions
    found = met.mapInPandas(best, f"year {dict(models.dtypes)['year']}, q long, word string, near double")
    found = found.groupBy("year", "q").agg(F.max_by("word", F.struct("near", "word")).alias("found"))
    both = asked.select("year", "q", "d").join(found, ["year", "q"])
    return both.groupBy("year").agg(F.avg((F.col("found") == F.col("d")).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("questions"))
