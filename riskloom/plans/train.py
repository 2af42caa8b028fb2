"""Compare, search, fit and evaluate models; every result becomes a table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import BOOSTED_GRID, FIXED_FOREST, FOREST_GRID, KFOLDS, ROW_ID, STRATIFIED_FOLDS, TARGET
from riskloom.operators import closed_form
from riskloom.operators.columns import design, feature_names, log_column
from riskloom.operators.folds import with_kfold, with_split, with_stratified_kfold
from riskloom.operators.iterative import iterative_models, random_forest
from riskloom.operators.metrics import classification_report, confusion_matrix, roc_curve, score
from riskloom.operators.selection import (
    best_of,
    boosted_grid_search,
    compare_models,
    fold_scores,
    forest_grid_search,
    sampled,
    summarize,
)
from riskloom.session import pin, spread
from riskloom.sources.files import read_parquet, write_parquet

@dataclass
class TrainingData:
    rows: DataFrame
    features: list[str]

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "test")


def training_data(curated: DataFrame) -> TrainingData:
    """Log amount, label and split: still one projection over the curated scan."""
    features = feature_names(curated)
    labelled = log_column(curated).withColumn("label", F.col(TARGET).cast("double"))
    return TrainingData(with_split(labelled), features)


def pinned(data: TrainingData) -> TrainingData:
    """The feature table written once, evenly spread, before the passes that read it."""
    return TrainingData(pin(spread(data.rows, ROW_ID), "features"), data.features)


def fit_fixed_forest(
    data: TrainingData, settings: dict = FIXED_FOREST, keep: tuple[str, ...] = (), fit_rows: int | None = None
):
    """The forest whose settings are given rather than searched; (model, scored test rows).

    ``fit_rows`` bounds the labelled rows that it learns from (None: all).
    """
    train = sampled(design(data.train, data.features, target="label", keep=keep), fit_rows)
    test = design(data.test, data.features, target="label", keep=keep)
    model = random_forest(len(data.features), **settings).fit(train)
    return model, model.transform(test)


def test_scores(predictions: DataFrame, model: str) -> DataFrame:
    scores = score(predictions, "accuracy", "recall", "fbeta2")
    return scores.select(F.lit(model).alias("model"), *scores.columns)


@dataclass
class Search:
    """What is compared and searched. ``fit_rows`` bounds the labelled rows that an iterative
    fit learns from (None: all); every row is scored."""

    forest: dict = field(default_factory=lambda: FOREST_GRID)
    boosted: dict = field(default_factory=lambda: BOOSTED_GRID)
    rounds: int = 100
    folds: int = KFOLDS
    grid_folds: int = STRATIFIED_FOLDS
    models: Callable = iterative_models
    fit_rows: int | None = None
    threads: int = 4


def train_models(spark: SparkSession, curated: str, destination: str, search: Search | None = None) -> None:
    """Compare, search, fit and evaluate; tables and models go below ``destination``.

    The feature table is written once to the shared folder before the many passes over
    it, so model fits read pruned columns and survive lost executors.
    """
    search = search or Search()
    data = pinned(training_data(read_parquet(spark, curated)))
    p = len(data.features)
    evaluated: dict[str, DataFrame] = {}

    def save(df: DataFrame, name: str) -> None:
        write_parquet(df, f"{destination}/{name}")

    def keep_model(model, name: str) -> None:
        model.write().overwrite().save(f"{destination}/models/{name}")

    folded = with_kfold(data.train, search.folds)
    scores = compare_models(
        folded, data.features, folds=search.folds, fit_rows=search.fit_rows, threads=search.threads, models=search.models
    )
    save(scores, "model_scores")
    save(summarize(read_parquet(spark, f"{destination}/model_scores")), "model_ranking")

    stratified = with_stratified_kfold(data.train, k=search.grid_folds)
    assembled = pin(design(stratified, data.features, target="label", keep=("fold",)), "stratified")
    test = pin(design(data.test, data.features, target="label"), "test")
    table, forest = forest_grid_search(assembled, p, search.forest, search.grid_folds, search.fit_rows)
    save(table, "forest_grid")
    save(best_of(table), "forest_best")
    keep_model(forest, "forest_best")
    table, boosted = boosted_grid_search(
        assembled, p, search.boosted, search.rounds, search.grid_folds, search.fit_rows
    )
    save(table, "boosted_grid")
    save(best_of(table), "boosted_best")
    save(boosted.to_table(spark), "models/boosted_best")
    evaluated["boosted_best"] = boosted.transform(test)

    fixed, evaluated["forest_fixed"] = fit_fixed_forest(data, fit_rows=search.fit_rows)
    keep_model(fixed, "forest_fixed")
    everything = design(data.rows, data.features, target="label", keep=("split",))
    save(fixed.transform(everything).select("application_id", "split", "label", "prediction"), "scored")

    bayes = closed_form.fit(data.train, closed_form.FITTERS["NB"], data.features)
    save(bayes.to_table(spark), "models/bayes")
    evaluated["bayes"] = closed_form.predict(data.test, bayes)
    save(test_scores(closed_form.predict(data.train, bayes), "bayes"), "bayes_training_score")
    save(classification_report(evaluated["bayes"]), "bayes_report")
    save(roc_curve(evaluated["bayes"], "probability"), "bayes_roc")

    union = closed_form.FITTERS["UNION"]
    crossed = closed_form.cross_predict(folded, union, data.features)
    save(summarize(fold_scores(crossed, "union", "accuracy")), "union_accuracy")
    evaluated["union"] = closed_form.predict(data.test, closed_form.fit(data.train, union, data.features))

    save(reduce(DataFrame.unionByName, [test_scores(df, name) for name, df in evaluated.items()]), "test_scores")
    matrices = [confusion_matrix(df).withColumn("model", F.lit(name)) for name, df in evaluated.items()]
    save(reduce(DataFrame.unionByName, matrices), "confusion")
