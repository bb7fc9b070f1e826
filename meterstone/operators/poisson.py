"""Poisson regression by reweighted least squares, one aggregate a step."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class PoissonFit:
    """Coefficients (intercept first), standard errors and p-values (None where a term is not told apart), deviances."""

    coefficients: list[float]
    std_errors: list[float | None]
    p_values: list[float | None]
    deviance: float
    null_deviance: float
    steps: int


def _dot(state: str, terms: Sequence[Column]) -> Column:
    total = F.element_at(state, 1)
    for i, x in enumerate(terms, start=2):
        total = total + F.element_at(state, i) * x
    return total


def fit_poisson(df: DataFrame, features: Sequence[str], label: str, offset: str, tolerance: float = 1e-12, most: int = 50) -> PoissonFit:
    """Log-link Poisson regression of ``label`` on an intercept and ``features`` with a given offset.

    Every step sums the normal equations of the weighted problem (k * (k + 1) / 2 + k doubles, combined before the
    shuffle), so only these reach the driver whatever the rows; steps end when no coefficient moves by more than ``tolerance`` of
    its size. Rows with a null in any column are left out. Terms without variation of their own share the least solution and
    have no standard error. No rows, or no event at all, raise ``ValueError``.
    """
    spark, k = df.sparkSession, len(features) + 1
    rows = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features, start=1)],
                     F.col(label).cast("double").alias("y"), F.col(offset).cast("double").alias("o")).dropna()
    total = rows.agg(F.sum("y"), F.sum(F.exp("o"))).first()
    if not total[0]:
        raise ValueError("nothing to fit: no rows or no events")
    level = math.log(total[0] / total[1])
    beta = np.array([level] + [0.0] * (k - 1))
    terms = [F.col(f"x{i}") for i in range(1, k)]
    x = [F.lit(1.0), *terms]
    surprise = lambda rate: F.sum(2 * (F.when(F.col("y") > 0, F.col("y") * F.ln(F.col("y") / rate)).otherwise(F.lit(0.0)) - (F.col("y") - rate)))
    upper = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        state = spark.createDataFrame([(at.tolist(),)], "b array<double>")
        told = rows.crossJoin(F.broadcast(state)).select("*", _dot("b", terms).alias("eta")).withColumn("mu", F.exp(F.col("eta") + F.col("o")))
        work = F.col("mu") * F.col("eta") + F.col("y") - F.col("mu")  # weight times working value
        out = told.agg(*[F.sum(F.col("mu") * x[i] * x[j]) for i, j in upper], *[F.sum(work * v) for v in x], surprise(F.col("mu"))).first()
        a = np.zeros((k, k))
        for (i, j), v in zip(upper, out):
            a[i, j] = a[j, i] = v
        return a, np.array(out[len(upper):-1], dtype=float), out[-1]

    steps, moved = 0, True
    while moved and steps < most:
        a, b, _ = sums(beta)
        scale = 1 / np.sqrt(np.maximum(np.diag(a), 1e-300))  # equal diagonals keep the solution exact for terms of unlike size
        after = scale * np.linalg.lstsq(a * np.outer(scale, scale), b * scale, rcond=1e-12)[0]
        moved = bool((np.abs(after - beta) > tolerance * np.maximum(np.abs(after), 1.0)).any())
        beta, steps = after, steps + 1
    a, _, deviance = sums(beta)
    scale = 1 / np.sqrt(np.maximum(np.diag(a), 1e-300))
    even = a * np.outer(scale, scale)
    if np.linalg.matrix_rank(even, tol=1e-10) < k:
        errors: list = [None] * k
        p: list = [None] * k
    else:
        errors = (np.sqrt(np.diag(np.linalg.inv(even))) * scale).tolist()
        p = [math.erfc(abs(v) / e / math.sqrt(2)) for v, e in zip(beta.tolist(), errors)]
    null = rows.agg(surprise(F.exp(F.lit(level) + F.col("o")))).first()[0]
    return PoissonFit(beta.tolist(), errors, p, float(deviance), float(null), steps)
