"""Yearly series: drift, interpolation, smoothing, averages of chunks. A series has a row a year, so its windows are small."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolex.operators.embeddings import model_similarity, previous_years


def yearly_drift(models: DataFrame, word: str | None = None, confidence: float = 0.95, error: str = "CI") -> DataFrame:
    """year, drift (1 - mean similarity to the year before), error and shared words; years whose mean is 0 are left out.

    CI: z * std / sqrt(n). SE: drift / sqrt(n), 0 for a single word.
    """
    rows = models if word is None else models.where(F.col("word") == word)
    s = model_similarity(rows, previous_years(models)).where("mean <> 0")
    drift = 1 - F.col("mean")
    if error == "CI":
        err = F.lit(NormalDist().inv_cdf((1 + confidence) / 2)) * F.col("std") / F.sqrt(F.col("shared"))
    elif error == "SE":
        err = F.when(F.col("shared") > 1, drift / F.sqrt(F.col("shared"))).otherwise(F.lit(0.0))
    else:
        raise ValueError(f"unknown error type {error!r}")
    return s.select("year", drift.alias("drift"), err.alias("error"), "shared")


def residual(series: DataFrame, regressor: DataFrame, value: str = "drift") -> DataFrame:
    """Adds `adjusted`: the value less its least-squares fit on the regressor (year, x); years without x drop out."""
    both = series.join(regressor, "year").where(F.col("x").isNotNull() & F.col(value).isNotNull())
    fit = both.agg(F.regr_slope(value, "x").alias("slope"), F.regr_intercept(value, "x").alias("intercept"))
    return both.join(F.broadcast(fit)).select(*both.columns, (F.col(value) - F.col("intercept") - F.col("slope") * F.col("x")).alias("adjusted"))


def interpolated(series: DataFrame, first: int, last: int, value: str = "value", group: str | None = None) -> DataFrame:
    """A row for every year of the range, missing ones by the line between their neighbours, flat at the ends."""
    keys = [group] if group else []
    spine = (series.select(group).distinct() if group else series.sparkSession.range(1).drop("id")).withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    rows = spine.join(series.select(*keys, "year", value), [*keys, "year"], "left")
    point = F.when(F.col(value).isNotNull(), F.struct(F.col("year").alias("y"), F.col(value).alias("v")))
    w = Window.partitionBy(*keys).orderBy("year") if keys else Window.orderBy("year")
    rows = rows.withColumn("p", F.last(point, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("n", F.first(point, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    line = F.col("p.v") + (F.col("n.v") - F.col("p.v")) * (F.col("year") - F.col("p.y")) / (F.col("n.y") - F.col("p.y"))
    return rows.select(*keys, "year", F.coalesce(F.col(value), line, F.col("p.v"), F.col("n.v")).alias(value))


def chunk_means(series: DataFrame, size: int, value: str = "value") -> DataFrame:
    """Mean year and value of blocks of `size` rows in order of years."""
    rows = series.withColumn("chunk", F.floor((F.row_number().over(Window.orderBy("year")) - 1) / size).cast("long"))
    return rows.groupBy("chunk").agg(F.avg("year").alias("year"), F.avg(value).alias(value))


def gaussian_kernel(sigma: float, truncate: float = 4.0) -> np.ndarray:
    radius = int(truncate * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return k / k.sum()


def gaussian_smooth(series: DataFrame, sigma: float, value: str = "value") -> DataFrame:
    """The series smoothed by a Gaussian cut at four deviations, mirrored at the ends with the end value repeated."""
    kernel = gaussian_kernel(sigma)
    radius = len(kernel) // 2
    spark = series.sparkSession
    rows = series.withColumn("i", F.row_number().over(Window.orderBy("year")) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    weights = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({o - radius}, {w!r}D)" for o, w in enumerate(kernel.tolist())) + " AS t(offset, w)")
    asked = rows.select("year", "i", "n").join(F.broadcast(weights)).withColumn("j", F.pmod(F.col("i") + F.col("offset"), 2 * F.col("n")))
    asked = asked.withColumn("j", F.when(F.col("j") >= F.col("n"), 2 * F.col("n") - 1 - F.col("j")).otherwise(F.col("j")))
    return asked.join(rows.select(F.col("i").alias("j"), F.col(value).alias("v")), "j").groupBy("year").agg(F.sum(F.col("w") * F.col("v")).alias(value))


def savgol_weights(window: int, order: int, at: int, delta: float) -> np.ndarray:
    """Weights of a window's values for the first derivative, at place `at`, of the polynomial fitted to them."""
    x = np.arange(window) - at
    return np.linalg.pinv(np.vander(x, order + 1, increasing=True))[1] / delta


def savgol_derivative(series: DataFrame, window: int = 11, order: int = 3, value: str = "value") -> DataFrame:
    """year and the first derivative of a polynomial fitted to the window around it; at the ends, of the last whole window's fit."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("year")
        y, n = pdf[value].to_numpy(float), len(pdf)
        size = min(window, n if n % 2 else n - 1)
        if size <= order:
            return pd.DataFrame({"year": pdf["year"], "derivative": np.full(n, np.nan)})
        delta = float(np.diff(pdf["year"].to_numpy(float)).mean())
        out = []
        for i in range(n):
            start = min(max(i - size // 2, 0), n - size)
            out.append(savgol_weights(size, order, i - start, delta) @ y[start : start + size])
        return pd.DataFrame({"year": pdf["year"], "derivative": out})

    rows = series.select(F.col("year").cast("double").alias("year"), value, F.lit(0).alias("one"))
    return rows.groupBy("one").applyInPandas(run, "year double, derivative double")
