"""Per-class sufficient statistics: what every closed-form model is fitted from.

One aggregate returns count, mean and co-moments for each (fold, class). A training
set "all folds but one" is the merge of the other folds' statistics, so k folds cost
the same single pass as one fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalars import quoted

MAX_FEATURES = 500


@dataclass
class Moments:
    """Count, mean vector and scatter matrix (sum of centred outer products) of a set of rows."""

    n: float
    mean: np.ndarray
    scatter: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        gap = other.mean - self.mean
        mean = self.mean + gap * (other.n / n)
        scatter = self.scatter + other.scatter + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, mean, scatter)

    @property
    def variance(self) -> np.ndarray:
        return np.diag(self.scatter) / self.n


ByClass = dict[float, Moments]


def merge(parts: list[Moments]) -> Moments:
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def complete_rows(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows in which every feature is present; closed-form models skip the others."""
    whole = F.lit(True)
    for gap in gaps(df, features).values():
        whole = whole & ~gap
    return df.filter(whole)


def gaps(df: DataFrame, features: list[str]) -> dict[str, Column]:
    """Feature -> whether a row lacks it (NULL or NaN), for features that can be lacking."""
    kinds, out = {f.name: f for f in df.schema}, {}
    for c in features:
        tests = []
        # Indicators can be neither NULL nor NaN: testing them would only cost time.
        if kinds[c].nullable:
            tests.append(quoted(c).isNull())
        if isinstance(kinds[c].dataType, (T.DoubleType, T.FloatType)):
            tests.append(F.coalesce(F.isnan(quoted(c)), F.lit(False)))
        if tests:
            out[c] = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return out


def class_moments(
    df: DataFrame, features: list[str], fold: str | None = None, products: bool = True
) -> dict[int, ByClass]:
    """``{fold: {class: Moments}}``; a single fold 0 when no fold column is named.

    Without ``products`` only the diagonal of the scatter matrix is computed.

    Products come from ``PolynomialExpansion`` and their means from ``Summarizer``,
    both JVM-side with partial aggregation. Features are shifted by their overall mean
    first, which keeps the products free of cancellation. What reaches the driver is
    folds x classes rows of about p*p/2 numbers.
    """
    p = len(features)
    if p > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features")
    rows = complete_rows(df, features)
    if not products:
        return _variances(rows, features, fold)
    centre = rows.agg(*[F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(features)]).first()
    shift = np.array([v if v is not None else 0.0 for v in centre], dtype=float)

    key = (quoted(fold) if fold else F.lit(0)).cast("int").alias("fold")
    shifted = rows.select(
        key,
        F.col("label").cast("double").alias("label"),
        *[(quoted(c).cast("double") - F.lit(float(s))).alias(f"x{i}") for i, (c, s) in enumerate(zip(features, shift))],
    )
    assembled = VectorAssembler(inputCols=[f"x{i}" for i in range(p)], outputCol="v").transform(shifted)
    products = PolynomialExpansion(degree=2, inputCol="v", outputCol="w").transform(assembled)
    summary = (
        products.groupBy("fold", "label")
        .agg(Summarizer.metrics("mean", "count").summary(F.col("w")).alias("s"))
        .select("fold", "label", "s.mean", "s.count")
        .collect()
    )
    # Expansion order: x0, x0*x0, x1, x0*x1, x1*x1, x2, ...
    linear = np.array([j * (j + 3) // 2 for j in range(p)], dtype=int)
    out: dict[int, ByClass] = {}
    for row in summary:
        values, n = row["mean"].toArray(), float(row["count"])
        local = values[linear]
        second = np.empty((p, p))
        for j in range(p):
            second[j, : j + 1] = second[: j + 1, j] = values[linear[j] + 1 : linear[j] + 2 + j]
        scatter = n * (second - np.outer(local, local))
        out.setdefault(row["fold"], {})[row["label"]] = Moments(n, local + shift, scatter)
    return out


def _variances(rows: DataFrame, features: list[str], fold: str | None) -> dict[int, ByClass]:
    key = (quoted(fold) if fold else F.lit(0)).cast("int").alias("fold")
    named = rows.select(
        key,
        F.col("label").cast("double").alias("label"),
        *[quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
    )
    assembler = VectorAssembler(inputCols=[f"x{i}" for i in range(len(features))], outputCol="v")
    summary = (
        assembler.transform(named)
        .groupBy("fold", "label")
        .agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s"))
        .select("fold", "label", "s.mean", "s.variance", "s.count")
        .collect()
    )
    out: dict[int, ByClass] = {}
    for r in summary:
        n = float(r["count"])
        scatter = np.diag(r["variance"].toArray() * (n - 1))
        out.setdefault(r["fold"], {})[r["label"]] = Moments(n, r["mean"].toArray(), scatter)
    return out


def all_but(moments: dict[int, ByClass], fold: int | None) -> ByClass:
    """Training statistics: every fold merged except ``fold``."""
    parts: dict[float, list[Moments]] = {}
    for f, by_class in moments.items():
        if f != fold:
            for label, m in by_class.items():
                parts.setdefault(label, []).append(m)
    return {label: merge(ms) for label, ms in sorted(parts.items())}
