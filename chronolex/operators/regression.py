"""Design matrices, least squares and random-intercept models from sufficient statistics that Spark sums."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prepared(df: DataFrame, outcome: str, predictors: list[str], others: tuple[str, ...] = ()) -> DataFrame:
    """Rows without a missing outcome, predictor or group."""
    missing = [c for c in (outcome, *predictors, *others) if c not in df.columns]
    if missing:
        raise ValueError(f"no columns {missing}")
    return df.dropna(subset=[outcome, *predictors, *others])


def design(df: DataFrame, outcome: str, continuous: list[str], categorical: list[str], interactions: list[tuple[str, str]] = (), standardise: bool = True, keep: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """outcome and one column a term: scaled numbers, treatment dummies against the smallest level, products of two terms."""
    terms: dict[str, list[tuple[str, object]]] = {}
    stats = df.agg(*[f(c).alias(f"{n}_{c}") for c in continuous for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first() if continuous else None
    for c in continuous:
        scaled = (F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0) if standardise else F.col(c).cast("double")
        terms[c] = [(c, scaled)]
    for c in categorical:
        levels = [r[0] for r in df.select(c).distinct().orderBy(c).collect()]  # a factor's levels
        terms[c] = [(f"{c}_{level}", (F.col(c) == level).cast("double")) for level in levels[1:]]
    columns = [("intercept", F.lit(1.0)), *[t for c in [*continuous, *categorical] for t in terms[c]]]
    columns += [(f"{a}:{b}", x * y) for p, q in interactions for a, x in terms[p] for b, y in terms[q]]
    return df.select(F.col(outcome).cast("double").alias("outcome"), *[F.col(k) for k in keep], *[x.alias(n) for n, x in columns]), [n for n, _ in columns]


@dataclass
class Fit:
    names: list[str]
    coefficients: np.ndarray
    errors: np.ndarray
    variance: float
    group_variance: float | None = None

    def summary(self) -> list[tuple[str, float, float, float, float, float, float, str]]:
        """term, coefficient, standard error, z, p, lower, upper, stars; p by the normal distribution."""
        out = []
        for name, b, e in zip(self.names, self.coefficients, self.errors, strict=True):
            z = b / e if e > 0 else math.inf * (b > 0) - math.inf * (b < 0) if b else 0.0
            p = math.erfc(abs(z) / math.sqrt(2))
            out.append((name, float(b), float(e), float(z), p, float(b - 1.959964 * e), float(b + 1.959964 * e), "***" if p < 0.001 else "**" if p < 0.01 else "*" if p < 0.05 else ""))
        return out


def moments(rows: DataFrame, names: list[str], group: str | None = None) -> list[tuple[int, np.ndarray, np.ndarray, float]]:
    """(n, X'X, X'y, y'y) of all rows, or of every group: sums by column pair, so no rows reach the driver."""
    sums = [F.sum(F.col(f"`{a}`") * F.col(f"`{b}`")).alias(f"s{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    sums += [F.sum(F.col(f"`{a}`") * F.col("outcome")).alias(f"y{i}") for i, a in enumerate(names)]
    sums += [F.count(F.lit(1)).alias("rows_"), F.sum(F.col("outcome") * F.col("outcome")).alias("yy")]
    out = []
    for r in (rows.groupBy(group) if group else rows.groupBy()).agg(*sums).collect():  # one row a group, as many numbers as terms allow
        p = len(names)
        xx = np.array([[r[f"s{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(p)] for i in range(p)])
        out.append((r["rows_"], xx, np.array([r[f"y{i}"] or 0.0 for i in range(p)]), float(r["yy"] or 0.0)))
    return out


def ols(rows: DataFrame, names: list[str]) -> Fit:
    n, xx, xy, yy = moments(rows, names)[0]
    inverse = np.linalg.pinv(xx)
    b = inverse @ xy
    variance = max(0.0, yy - b @ xy) / max(1, n - len(names))
    return Fit(names, b, np.sqrt(np.maximum(np.diag(inverse), 0) * variance), variance)


def mixed(rows: DataFrame, names: list[str], group: str) -> Fit:
    """Random intercept by group: restricted maximum likelihood over the ratio of the two variances."""
    parts = moments(rows, names, group)
    n, p = sum(x[0] for x in parts), len(names)

    def solve(ratio: float):
        a, c, yy, logs = np.zeros((p, p)), np.zeros(p), 0.0, 0.0
        for m, xx, xy, own in parts:
            # the intercept is the first term, so the sums over a group stand in its row
            k = ratio / (1 + m * ratio)
            a += xx - k * np.outer(xx[0], xx[0])
            c += xy - k * xx[0] * xy[0]
            yy += own - k * xy[0] ** 2
            logs += math.log(1 + m * ratio)
        inverse = np.linalg.pinv(a)
        b = inverse @ c
        variance = max(yy - b @ c, 1e-12) / (n - p)
        return (n - p) * math.log(variance) + logs + np.linalg.slogdet(a)[1], b, inverse, variance

    grid = [0.0, *np.geomspace(1e-6, 1e4, 61)]
    best = min(range(len(grid)), key=lambda i: solve(grid[i])[0])
    low, high = grid[max(0, best - 1)], grid[min(len(grid) - 1, best + 1)]
    for _ in range(60):  # golden section around the best of the grid
        third = 0.381966 * (high - low)
        low, high = (low, high - third) if solve(low + third)[0] < solve(high - third)[0] else (low + third, high)
    ratio = min((grid[best], (low + high) / 2), key=lambda x: solve(x)[0])
    _, b, inverse, variance = solve(ratio)
    return Fit(names, b, np.sqrt(np.maximum(np.diag(inverse), 0) * variance), variance, ratio * variance)


def fitted(rows: DataFrame, names: list[str], group: str | None) -> tuple[str, Fit]:
    """A random-intercept model by group, or least squares where there is no group or the mixed model cannot be fitted: its kind and the fit."""
    if group is not None:
        try:
            fit = mixed(rows, names, group)
            if np.isfinite(fit.coefficients).all() and np.isfinite(fit.errors).all():
                return "mixed", fit
        except (np.linalg.LinAlgError, ValueError, ZeroDivisionError, FloatingPointError):
            pass
    return "ols", ols(rows, names)
