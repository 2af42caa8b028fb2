"""Feature reduction and selection."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import PCA, StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.moments import ByClass, Moments, all_but, class_moments, merge


def principal_axes(pooled: Moments, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading axes of centred data (rows) and their explained variances.

    An axis is only known up to its sign: the largest loading is made positive.
    """
    values, vectors = np.linalg.eigh(pooled.scatter / (pooled.n - 1))
    order = np.argsort(values)[::-1][:k]
    axes = vectors[:, order].T
    for axis in axes:
        if axis[np.argmax(np.abs(axis))] < 0:
            axis *= -1
    return axes, values[order]


def anova_scores(stats: ByClass) -> np.ndarray:
    """F value of every feature: between-class over within-class mean square."""
    pooled, k = merge(list(stats.values())), len(stats)
    within = sum(np.diag(m.scatter) for m in stats.values())
    between = sum(m.n * (m.mean - pooled.mean) ** 2 for m in stats.values())
    with np.errstate(divide="ignore", invalid="ignore"):
        f = (between / (k - 1)) / (within / (pooled.n - k))
    # Constant features have no F value and rank last.
    return np.where(np.isnan(f), -1.0, f)


def anova_f(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, f_score) from one statistics pass; NULL for a constant feature."""
    scores = anova_scores(all_but(class_moments(df, features, products=False), None))
    rows = [(f, float(v) if v >= 0 else None) for f, v in zip(features, scores)]
    return df.sparkSession.createDataFrame(rows, "feature string, f_score double")


def select_k_best(df: DataFrame, features: list[str], k: int = 6) -> DataFrame:
    """The k features with the highest F value, best first; among equals the earlier column."""
    place = F.array_position(F.lit(features), F.col("feature"))
    return anova_f(df, features).orderBy(F.desc_nulls_last("f_score"), place).limit(k)


def loading_signs(loadings: np.ndarray) -> np.ndarray:
    """What makes the largest loading of each axis (column) positive."""
    return np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])])


def union_pipeline(components: int = 2, k: int = 6) -> Pipeline:
    """Centre, reduce and select side by side, then naive Bayes, as Spark ML stages.

    ``PCA`` does not centre its input, hence the scaler in front of it.
    """
    centre = StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False)
    reduce = PCA(k=components, inputCol="centred", outputCol="axes")
    select = UnivariateFeatureSelector(
        featuresCol="features", labelCol="label", outputCol="selected", selectionMode="numTopFeatures"
    )
    select = select.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k)
    union = VectorAssembler(inputCols=["axes", "selected"], outputCol="union")
    bayes = NaiveBayes(modelType="gaussian", featuresCol="union", labelCol="label")
    return Pipeline(stages=[centre, reduce, select, union, bayes])
