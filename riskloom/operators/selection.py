"""Cross-validation, model ranking and grid search."""

from __future__ import annotations

import itertools
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import BOOSTED_GRID, DEEPEST_TREE, FOREST_GRID, KFOLDS, ROW_ID
from riskloom.functions.order_stats import order_statistics
from riskloom.operators import boosting, closed_form
from riskloom.operators.columns import design
from riskloom.operators.iterative import iterative_models, random_forest
from riskloom.operators.logistic import fit_logistic
from riskloom.operators.metrics import score
from riskloom.operators.moments import class_moments
from riskloom.operators.neighbors import knn_cross_predict
from riskloom.session import pin, run_path


ROWS_PER_TASK = 2_500  # of a sample that iterative fits pass over many times


def sampled(df: DataFrame, fit_rows: int | None) -> DataFrame:
    """About ``fit_rows`` labelled rows, those whose ids hash lowest; ids of one hash come together.

    The hash to cut at is found by exact selection, so the table isn't sorted, and the rows
    are dealt to as many tasks as there are ``ROWS_PER_TASK`` in them.
    """
    if fit_rows is None:
        return df
    hashed = df.select(F.xxhash64(ROW_ID).alias("h"))
    found = order_statistics(hashed, "h", lambda n: [min(fit_rows, n) - 1] if n else [])
    n, at = found.get((), (0, {}))
    kept = df.filter(F.xxhash64(ROW_ID) <= F.lit(next(iter(at.values())))) if n > fit_rows else df
    return kept.repartition(-(-min(fit_rows, max(n, 1)) // ROWS_PER_TASK), ROW_ID)


def fold_samples(df: DataFrame, folds: int, fit_rows: int | None) -> list[DataFrame]:
    """``sampled`` rows outside of each fold, from one pass over the table.

    The lowest hashes outside of a fold are among the lowest of the other folds each.
    """
    outside = [F.col("fold") != f for f in range(folds)]
    if fit_rows is None:
        return [df.filter(o) for o in outside]
    h = F.xxhash64(ROW_ID)
    found = order_statistics(df.select("fold", h.alias("h")), "h", lambda n: [min(fit_rows, n) - 1] if n else [], by=("fold",))
    low = F.lit(False)
    for (fold,), (_, at) in found.items():
        low = low | (F.col("fold").eqNullSafe(F.lit(fold)) & (h <= F.lit(max(at.values()))))
    candidates = pin(df.filter(low), "fit-candidates")
    return [pin(sampled(candidates.filter(o), fit_rows), "fit-rows") for o in outside]


def cross_predict(
    df: DataFrame, estimator, folds: int = KFOLDS, threads: int = 4, fit_rows: int | None = None, train: list[DataFrame] | None = None
) -> DataFrame:
    """Out-of-fold predictions of a Spark ML estimator over a ``features`` vector.

    ``train`` has the rows that each fold's fit learns from, if they are known.
    """
    here = F.col("fold")
    train = train or fold_samples(df, folds, fit_rows)

    def held_out(fold: int) -> DataFrame:
        model = estimator.fit(train[fold])
        return model.transform(df.filter(here == fold)).select(ROW_ID, "fold", "label", "prediction")

    with ThreadPool(threads) as pool:
        parts = pool.map(inheritable_thread_target(df.sparkSession)(held_out), range(folds))
    return reduce(DataFrame.unionByName, parts)


def fold_scores(predictions: DataFrame, model: str, metric: str = "recall") -> DataFrame:
    """(model, fold, metric, value) from out-of-fold predictions."""
    return score(predictions, metric, by=("fold",)).select(
        F.lit(model).alias("model"), "fold", F.lit(metric).alias("metric"), F.col(metric).alias("value")
    )


def summarize(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold scores of each model."""
    return scores.groupBy("model").agg(
        F.avg("value").alias("mean_score"), F.stddev_pop("value").alias("std_score")
    )


def closed_form_scores(df: DataFrame, features: list[str], metric: str = "recall") -> DataFrame:
    """Fold scores of the models that need one statistics pass for all folds."""
    moments = class_moments(df, features, "fold")
    parts = [
        fold_scores(
            closed_form.cross_predict(df, closed_form.FITTERS[name], features, moments=moments), name, metric
        )
        for name in ("LDA", "NB")
    ]
    return reduce(DataFrame.unionByName, parts)


def logistic_cross_predict(df: DataFrame, features: list[str], fold: str = "fold") -> DataFrame:
    """Out-of-fold predictions of ridge logistic regression, fitted on all rows of the other folds."""
    return closed_form.cross_predict(df, None, features, fold, models=fit_logistic(df, features, fold))


def compare_models(
    df: DataFrame,
    features: list[str],
    metric: str = "recall",
    folds: int = KFOLDS,
    fit_rows: int | None = None,
    threads: int = 4,
    models=iterative_models,
) -> DataFrame:
    """Fold scores of all eight models on rows with ``label`` and ``fold``.

    ``fit_rows`` bounds the labelled rows that a tree, ensemble or kernel fit learns from
    (None: all); the other models learn from all, and every row is scored.
    """
    assembled = pin(design(df, features, target="label", keep=("fold",)), "compared")
    n_rows = assembled.count() * (folds - 1) // folds
    parts = [closed_form_scores(df, features, metric)]
    parts.append(fold_scores(logistic_cross_predict(df, features), "LR", metric))
    parts.append(fold_scores(knn_cross_predict(df, features), "KNN", metric))
    train = fold_samples(assembled, folds, fit_rows)
    for name, estimator in models(min(n_rows, fit_rows or n_rows), len(features)).items():
        if name == "LR":
            continue
        predictions = cross_predict(assembled, estimator, folds, threads, train=train)
        parts.append(fold_scores(predictions, name, metric))
    return reduce(DataFrame.unionByName, parts)


def best_of(summary: DataFrame) -> DataFrame:
    """The best grid point; the earlier one among equal scores."""
    winner = F.max_by(F.struct("grid_index", "params", "mean_score"), F.struct("mean_score", -F.col("grid_index")))
    return summary.agg(winner.alias("w")).select("w.grid_index", "w.params", F.col("w.mean_score").alias("best_score"))


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations, the last name varying fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def node_arrays(model, spark: SparkSession) -> list[tuple[np.ndarray, ...]]:
    """(feature, threshold, left, right, positive share) of each tree of a fitted forest.

    Read from the saved model's node table. ``feature`` is -1 at a leaf. The share is that
    of the node's own training rows, so a tree cut off at any depth can vote.
    """
    path = run_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    table = spark.read.parquet(f"{path}/data").select(
        "treeID",
        node["id"].alias("id"),
        F.when(node["leftChild"] < 0, -1).otherwise(node["split"]["featureIndex"]).alias("feature"),
        F.coalesce(F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)).alias("threshold"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        (F.get(node["impurityStats"], F.lit(1)) / F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, x: a + x)).alias("share"),
    )
    nodes = table.orderBy("treeID", "id").toPandas()
    names = ["feature", "threshold", "left", "right", "share"]
    return [tuple(g[n].to_numpy() for n in names) for _, g in nodes.groupby("treeID", sort=True)]


def truncated_votes(trees, depths: list[int], counts: list[int], x: np.ndarray) -> np.ndarray:
    """Predictions (rows x depths x counts) of the first n trees cut off at each depth."""
    votes = np.zeros((len(x), len(depths), len(counts)))
    upto = np.zeros((len(x), len(depths)))
    columns = np.ascontiguousarray(x.T)
    goes_right = boosting.remembered(lambda feature, threshold: ~(columns[feature] <= threshold))
    for t, (feature, threshold, left, right, share) in enumerate(trees, 1):
        leaves: list[int] = []
        feature, left, right = feature.tolist(), left.tolist(), right.tolist()
        plan = boosting.tree_plan(0, feature, threshold.tolist(), left, right, leaves)
        upto += share[_cut_off(leaves, feature, left, right, depths)][boosting.leaf_places(plan, goes_right, boosting.place_type(len(leaves)))]
        for j, n in enumerate(counts):
            if n == t:
                votes[:, :, j] = upto / t
    return votes > 0.5


def _cut_off(leaves: list[int], feature: list, left: list, right: list, depths: list[int]) -> np.ndarray:
    """(leaf, depth): the node that a row of the leaf has reached at each depth."""
    paths, open_ = {}, [(0, (0,))]
    while open_:
        node, path = open_.pop()
        if feature[node] < 0:
            paths[node] = path
        else:
            open_ += [(child, (*path, child)) for child in (left[node], right[node])]
    return np.array([[paths[leaf][min(depth, len(paths[leaf]) - 1)] for depth in depths] for leaf in leaves])


def forest_grid(
    df: DataFrame,
    n_features: int,
    grid: dict[str, list] = FOREST_GRID,
    folds: int = 5,
    fit_rows: int | None = None,
    threads: int = 4,
) -> DataFrame:
    """The whole grid from one forest per fold and number of features.

    The first n trees of a forest are a forest of n trees, and a tree cut off at a depth,
    where a node answers with its own rows' shares, is a tree of that depth. So the largest
    and deepest forest of each ``max_features`` scores every depth and count in one pass
    over the held-out rows. ``fit_rows`` bounds the labelled rows that a forest learns from
    (None: all); every row is scored.
    """
    points, counts = grid_points(grid), sorted(grid["n_estimators"])
    depths = [d or DEEPEST_TREE for d in grid["max_depth"]]
    spark = df.sparkSession
    train = fold_samples(df, folds, fit_rows)
    if fit_rows is None:
        train = [pin(rows, "grid-train") for rows in train]

    # Recall asks for positives only; a batch without any still tells that there are rows.
    asked = F.when(F.col("label") == 1, vector_to_array("features")).alias("x")
    held = pin(df.select("fold", asked), "grid-held")

    def fitted(fold: int, wanted: int) -> DataFrame:
        model = random_forest(n_features, max(counts), max(depths), wanted).fit(train[fold])
        return _grid_hits(held.filter(F.col("fold") == fold), node_arrays(model, spark), depths, counts, fold, wanted)

    with ThreadPool(threads) as pool:
        jobs = list(itertools.product(range(folds), grid["max_features"]))
        parts = pool.starmap(inheritable_thread_target(spark)(fitted), jobs)
    hits = reduce(DataFrame.unionAll, parts)
    recall = F.sum("hits") / F.sum("positives")
    per_fold = hits.groupBy("fold", "wanted", "depth", "n").agg(F.coalesce(recall, F.lit(0.0)).alias("value"))
    named = [
        (i, ", ".join(f"{k}={v}" for k, v in p.items()), p["max_features"], p["max_depth"] or DEEPEST_TREE, p["n_estimators"])
        for i, p in enumerate(points)
    ]
    table = df.sparkSession.createDataFrame(named, "grid_index int, params string, wanted int, depth int, n int")
    return (
        table.join(per_fold, ["wanted", "depth", "n"])
        .groupBy("grid_index", "params")
        .agg(F.avg("value").alias("mean_score"), F.stddev_pop("value").alias("std_score"))
    )


def _grid_hits(held: DataFrame, trees, depths: list[int], counts: list[int], fold: int, wanted: int) -> DataFrame:
    """Per batch of held-out rows and grid point: positives, and how many are found."""

    def score_batches(batches):
        for pdf in batches:
            x = [row for row in pdf["x"] if row is not None]
            found = truncated_votes(trees, depths, counts, np.stack(x)).sum(axis=0) if x else np.zeros((len(depths), len(counts)))
            rows = [
                (fold, wanted, d, n, int(found[i, j]), len(x))
                for i, d in enumerate(depths)
                for j, n in enumerate(counts)
            ]
            yield pd.DataFrame(rows, columns=["fold", "wanted", "depth", "n", "hits", "positives"])

    return held.select("x").mapInPandas(score_batches, "fold int, wanted int, depth int, n int, hits long, positives long")


def forest_grid_search(
    df: DataFrame, n_features: int, grid: dict[str, list] = FOREST_GRID, folds: int = 5, fit_rows: int | None = None
):
    """``forest_grid``, and the best point's forest fitted on all rows."""
    table = pin(forest_grid(df, n_features, grid, folds, fit_rows), "forest-grid")
    best = grid_points(grid)[best_of(table).first()["grid_index"]]
    return table, random_forest(n_features, best["n_estimators"], best["max_depth"], best["max_features"]).fit(df)


def boosted_grid_search(
    df: DataFrame,
    n_features: int,
    grid: dict[str, list] = BOOSTED_GRID,
    rounds: int = 100,
    folds: int = 5,
    fit_rows: int | None = None,
):
    """Search boosted trees over depth, leaf size, gain, row share and column share.

    Every point learns from all rows less a fold, and is scored on all rows; returns the grid
    and the best point's trees, learned from all rows. ``fit_rows`` bounds the rows that are
    learned from (None: all).
    """
    sample = df if fit_rows is None else pin(sampled(df, fit_rows), "boost-rows")
    table = pin(boosting.boosted_grid(df, sample, n_features, grid, folds, rounds), "boosted-grid")
    best = grid_points(grid)[best_of(table).first()["grid_index"]]
    return table, boosting.fit_boosted(sample, n_features, best, rounds)


def smoothing_grid_search(df: DataFrame, features: list[str], grid: list[float], metric: str = "recall") -> DataFrame:
    """Grid over the variance smoothing of naive Bayes: (grid_index, params, mean and std score)."""
    parts, moments = [], class_moments(df, features, "fold", products=False)
    for i, smoothing in enumerate(grid):
        fitter = lambda stats, names, s=smoothing: closed_form.GaussianNaiveBayes.fit(stats, names, s)
        scores = fold_scores(closed_form.cross_predict(df, fitter, features, moments=moments), str(i), metric)
        parts.append(
            summarize(scores).select(
                F.lit(i).alias("grid_index"), F.lit(f"smoothing={smoothing:g}").alias("params"), "mean_score", "std_score"
            )
        )
    return reduce(DataFrame.unionByName, parts)
