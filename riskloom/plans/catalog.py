"""Every registered query: a function of (session, data folder) that returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime


from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import ROW_ID
from riskloom.functions.scalars import batch_number, local_time
from riskloom.operators import boosting, closed_form, columns, encode, features, folds, governance, gram, iterative, logistic, metrics
from riskloom.operators import neighbors, profile, profile_state, selection
from riskloom.operators.conform import conform
from riskloom.operators.moments import all_but, class_moments, gaps, merge
from riskloom.plans import batch, train
from riskloom.session import pin, run_path
from riskloom.sources import files, warehouse
from riskloom.sources.applications import applications, table
from riskloom.sources.promote import promote, promote_changed
from riskloom.streaming import daily
from riskloom.streaming.daily import land_stream, new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), places) for n in names})


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.curate(applications(spark, sf_dir))


def model_data(spark: SparkSession, sf_dir: str) -> train.TrainingData:
    return train.pinned(train.training_data(curated(spark, sf_dir)))


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicants classified by one threshold: metrics can be checked without a model."""
    rate = F.col("credit_amount") / F.col("duration")
    return applications(spark, sf_dir).select(
        ROW_ID,
        (F.col("risk") == "bad").cast("double").alias("label"),
        rate.alias("score"),
        (rate > 6000).cast("double").alias("prediction"),
    )


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicants as untyped text with faults, as a file might bring them."""
    age = F.when(F.col("housing") == "P", "unknown").otherwise(F.col("age").cast("string"))
    return applications(spark, sf_dir).withColumns(
        {"age": age, "housing": F.coalesce("checking_account", F.lit("own"))}
    )


# Projections, fills and encoding ------------------------------------------------


@query
def applicants(spark, sf_dir):
    return applications(spark, sf_dir)


@query
def fill_missing(spark, sf_dir):
    return columns.fill_missing(applications(spark, sf_dir))


@query
def curated_features(spark, sf_dir):
    return curated(spark, sf_dir)


@query
def encode_all_strings(spark, sf_dir):
    """Every text column of the applicants."""
    return encode.one_hot_encoder(columns.fill_missing(applications(spark, sf_dir)))[0]


@query
def encode_null_level(spark, sf_dir):
    """Every text column of the applicants, a gap as a level of its own."""
    rows = applications(spark, sf_dir)
    return encode.one_hot_encoder(rows.select(ROW_ID, *columns.string_columns(rows)), nan_as_category=True)[0]


CUSTOMER_TEXTS = ["c_name", "c_mktsegment"]


@query
def level_positions(spark, sf_dir):
    """The levels of customers' names and segments, a name for each customer, with their places."""
    return encode.level_table(table(spark, sf_dir, "customer"), CUSTOMER_TEXTS)


@query
def sparse_indicators(spark, sf_dir):
    """Customers' names and segments as sparse indicators: a place for each name but the first."""
    found = encode.sparse_encode(table(spark, sf_dir, "customer"), CUSTOMER_TEXTS, row_id="c_custkey")
    return found.select("c_custkey", "size", F.array_join("ones", ",").alias("ones"))


@query
def age_bands(spark, sf_dir):
    banded = applications(spark, sf_dir).select(encode.bucketize("age").alias("age_cat"), "age")
    return banded.groupBy("age_cat").agg(
        F.count("*").alias("n"), F.min("age").alias("min_age"), F.max("age").alias("max_age")
    )


@query
def warehouse_projection(spark, sf_dir):
    return columns.warehouse_projection(applications(spark, sf_dir))


@query
def drop_originals(spark, sf_dir):
    return columns.drop_columns(applications(spark, sf_dir), "saving_accounts", "checking_account", "purpose", "sex", "housing", "risk")


@query
def log_amount(spark, sf_dir):
    logged = columns.log_column(applications(spark, sf_dir).select(ROW_ID, "credit_amount"))
    return rounded(logged, "credit_amount")


@query
def log_rejects(spark, sf_dir):
    return columns.log_rejects(table(spark, sf_dir, "customer").select("c_acctbal"), "c_acctbal")


@query
def string_columns(spark, sf_dir):
    """Text columns found by type, each with how many cells it fills."""
    apps = applications(spark, sf_dir)
    cells = profile.tall(apps, columns.string_columns(apps), "string")
    return cells.groupBy("column").agg(F.count("value").alias("n_filled"))


@query
def design_matrix(spark, sf_dir):
    data = model_data(spark, sf_dir)
    vectors = columns.design(data.rows, data.features, target="label")
    x = vector_to_array("features")
    total = F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    return vectors.select(ROW_ID, "label", F.size(x).alias("n_features"), F.round(total, 6).alias("feature_sum"))


@query
def skipped_rows(spark, sf_dir):
    """Rows a model would leave out if customer balances were logged before training."""
    logged = columns.log_column(table(spark, sf_dir, "customer"), "c_acctbal")
    return columns.skipped_rows(logged, ["c_nationkey", "c_acctbal"])


@query
def attach_features(spark, sf_dir):
    """Line-item features computed apart and joined to the applications on their id."""
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias(ROW_ID)).agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")
    )
    return columns.attach(applications(spark, sf_dir).select(ROW_ID, "risk"), items)


@query
def conform_valid(spark, sf_dir):
    return conform(raw_texts(spark, sf_dir)).valid


@query
def conform_quarantine(spark, sf_dir):
    return conform(raw_texts(spark, sf_dir)).quarantine


@query
def conform_violations(spark, sf_dir):
    return conform(raw_texts(spark, sf_dir)).violations


# Splits and folds ---------------------------------------------------------------


@query
def train_test_split(spark, sf_dir):
    return folds.with_split(applications(spark, sf_dir).select(ROW_ID))


@query
def kfold_contiguous(spark, sf_dir):
    return folds.with_kfold(applications(spark, sf_dir).select(ROW_ID))


@query
def kfold_stratified(spark, sf_dir):
    return folds.with_stratified_kfold(applications(spark, sf_dir).select(ROW_ID, "risk"), label="risk")


@query
def fold_sizes(spark, sf_dir):
    train_rows, _ = folds.train_test_split(applications(spark, sf_dir).select(ROW_ID))
    return folds.fold_sizes(folds.with_kfold(train_rows))


# Metrics ------------------------------------------------------------------------


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(ruled(spark, sf_dir))


@query
def accuracy(spark, sf_dir):
    return rounded(metrics.score(ruled(spark, sf_dir), "accuracy"), "accuracy")


@query
def recall(spark, sf_dir):
    return rounded(metrics.score(ruled(spark, sf_dir), "recall"), "recall")


@query
def fbeta2(spark, sf_dir):
    return rounded(metrics.score(ruled(spark, sf_dir), "fbeta2"), "fbeta2")


@query
def classification_report(spark, sf_dir):
    return rounded(metrics.classification_report(ruled(spark, sf_dir)), "precision", "recall", "f1")


@query
def roc_points(spark, sf_dir):
    return rounded(metrics.roc_curve(ruled(spark, sf_dir)), "fpr", "tpr", "threshold")


@query
def roc_points_all(spark, sf_dir):
    curve = metrics.roc_curve(ruled(spark, sf_dir), drop_intermediate=False)
    return rounded(curve, "fpr", "tpr", "threshold")


# Closed-form models -------------------------------------------------------------


@query
def gnb_params(spark, sf_dir):
    data = model_data(spark, sf_dir)
    model = closed_form.fit(data.train, closed_form.FITTERS["NB"], data.features)
    return rounded(model.to_table(spark).drop("position"), "prior", "mean", "variance")


def bayes_scored(spark, sf_dir, part: str) -> DataFrame:
    data = model_data(spark, sf_dir)
    model = closed_form.fit(data.train, closed_form.FITTERS["NB"], data.features)
    return closed_form.predict(getattr(data, part), model)


@query
def gnb_scores(spark, sf_dir):
    scored = bayes_scored(spark, sf_dir, "test")
    return rounded(scored.select(ROW_ID, "label", "prediction", "probability"), "probability")


@query
def gnb_training_score(spark, sf_dir):
    return rounded(metrics.score(bayes_scored(spark, sf_dir, "train"), "accuracy"), "accuracy")


@query
def gnb_report(spark, sf_dir):
    report = metrics.classification_report(bayes_scored(spark, sf_dir, "test"))
    return rounded(report, "precision", "recall", "f1")


@query
def gnb_cv_recall(spark, sf_dir):
    data = model_data(spark, sf_dir)
    crossed = closed_form.cross_predict(folds.with_kfold(data.train), closed_form.FITTERS["NB"], data.features)
    return rounded(selection.fold_scores(crossed, "NB"), "value")


@query
def gnb_grid(spark, sf_dir):
    data = model_data(spark, sf_dir)
    stratified = folds.with_stratified_kfold(data.train)
    table_ = selection.smoothing_grid_search(stratified, data.features, [1e-9, 1e-5, 1e-3, 1e-1])
    return rounded(table_, "mean_score", "std_score")


@query
def gnb_grid_best(spark, sf_dir):
    data = model_data(spark, sf_dir)
    stratified = folds.with_stratified_kfold(data.train)
    table_ = selection.smoothing_grid_search(stratified, data.features, [1e-9, 1e-5, 1e-3, 1e-1])
    return rounded(selection.best_of(table_), "best_score")


LDA2 = ["age", "credit_amount"]


@query
def lda2_scores(spark, sf_dir):
    data = model_data(spark, sf_dir)
    model = closed_form.fit(data.train, closed_form.FITTERS["LDA"], LDA2)
    scored = closed_form.predict(data.test, model)
    return rounded(scored.select(ROW_ID, "label", "prediction", "probability"), "probability")


@query
def lda2_cv_recall(spark, sf_dir):
    data = model_data(spark, sf_dir)
    crossed = closed_form.cross_predict(folds.with_kfold(data.train), closed_form.FITTERS["LDA"], LDA2)
    return rounded(selection.fold_scores(crossed, "LDA"), "value")


@query
def lda_scored(spark, sf_dir):
    data = model_data(spark, sf_dir)
    model = closed_form.fit(data.train, closed_form.FITTERS["LDA"], data.features)
    scored = closed_form.predict(data.test, model).select(ROW_ID, "label", "prediction", "probability")
    return rounded(scored, "probability")


@query
def lda_cv_recall(spark, sf_dir):
    """Recall of the discriminant over all features, ten folds from one statistics pass."""
    data = model_data(spark, sf_dir)
    crossed = closed_form.cross_predict(folds.with_kfold(data.train), closed_form.FITTERS["LDA"], data.features)
    return rounded(selection.fold_scores(crossed, "LDA"), "value")


@query
def model_ranking_closed(spark, sf_dir):
    """The ranking's models whose optimum is unique, over all features and rows."""
    data = model_data(spark, sf_dir)
    folded = pin(folds.with_kfold(data.train), "folded")
    scores = selection.closed_form_scores(folded, data.features)
    scores = scores.unionByName(selection.fold_scores(selection.logistic_cross_predict(folded, data.features), "LR"))
    return rounded(selection.summarize(scores), "mean_score", "std_score")


@query
def closed_form_ranking(spark, sf_dir):
    data = model_data(spark, sf_dir)
    scores = selection.closed_form_scores(folds.with_kfold(data.train), LDA2)
    return rounded(selection.summarize(scores), "mean_score", "std_score")


@query
def knn5_predict(spark, sf_dir):
    data = model_data(spark, sf_dir)
    return neighbors.knn_predict(data.train, data.test, data.features)


@query
def knn5_cv_recall(spark, sf_dir):
    data = model_data(spark, sf_dir)
    crossed = neighbors.knn_cross_predict(folds.with_kfold(data.train), data.features)
    return rounded(selection.fold_scores(crossed, "KNN"), "value")


@query
def anova_f(spark, sf_dir):
    data = model_data(spark, sf_dir)
    return rounded(features.anova_f(data.train, data.features), "f_score", places=4)


@query
def select_k_best(spark, sf_dir):
    data = model_data(spark, sf_dir)
    return features.select_k_best(data.train, data.features).select("feature")


@query
def pca2_variance(spark, sf_dir):
    data = model_data(spark, sf_dir)
    pooled = merge(list(all_but(class_moments(data.train, LDA2), None).values()))
    axes, variances = features.principal_axes(pooled, 2)
    rows = [(i, float(v), float(v / variances.sum())) for i, v in enumerate(variances)]
    out = spark.createDataFrame(rows, "component int, variance double, share double")
    return rounded(out, "variance", "share")


@query
def pca_scores(spark, sf_dir):
    """The two leading axes of all features, by the Spark ML stages."""
    data = model_data(spark, sf_dir)
    train_rows = columns.design(data.train, data.features, target="label")
    fitted = features.union_pipeline().fit(train_rows)
    axes = vector_to_array("axes")
    out = fitted.transform(columns.design(data.test, data.features, target="label"))
    signs = features.loading_signs(fitted.stages[1].pc.toArray())
    return out.select(ROW_ID, *[(axes[i] * float(signs[i])).alias(f"axis_{i}") for i in (0, 1)], "prediction")


@query
def union_scored(spark, sf_dir):
    data = model_data(spark, sf_dir)
    model = closed_form.fit(data.train, closed_form.FITTERS["UNION"], data.features)
    scored = closed_form.predict(data.test, model).select(ROW_ID, "label", "prediction", "probability")
    return rounded(scored, "probability")


@query
def union_cv_accuracy(spark, sf_dir):
    data = model_data(spark, sf_dir)
    crossed = closed_form.cross_predict(folds.with_kfold(data.train), closed_form.FITTERS["UNION"], data.features)
    return rounded(selection.fold_scores(crossed, "UNION", "accuracy"), "value")


# Profile ------------------------------------------------------------------------


def profiled(spark, sf_dir) -> DataFrame:
    return applications(spark, sf_dir).drop(ROW_ID)


def lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def profile_overview(spark, sf_dir):
    return rounded(profile.overview(profiled(spark, sf_dir)), "missing_share")


@query
def profile_overview_lines(spark, sf_dir):
    return rounded(profile.overview(lines(spark, sf_dir)), "missing_share")


@query
def profile_columns(spark, sf_dir):
    return rounded(profile.column_summary(applications(spark, sf_dir)), "null_share", "distinct_share")


@query
def profile_numeric(spark, sf_dir):
    stats = profile.numeric_stats(profiled(spark, sf_dir))
    return rounded(rounded(stats, "mean", "std", "min", "max", "range", "cv", "mad"), "variance", "sum", places=2)


@query
def profile_quantiles(spark, sf_dir):
    return rounded(profile.quantile_table(profiled(spark, sf_dir)), "q05", "q25", "q50", "q75", "q95", "iqr")


@query
def profile_quantiles_lines(spark, sf_dir):
    found = profile.quantile_table(lines(spark, sf_dir), LINE_NUMBERS)
    return rounded(found, "q05", "q25", "q50", "q75", "q95", "iqr")


@query
def profile_moments(spark, sf_dir):
    return rounded(profile.moments_table(profiled(spark, sf_dir)), "skewness", "kurtosis")


@query
def profile_histogram(spark, sf_dir):
    return profile.histogram(profiled(spark, sf_dir))


@query
def profile_top_values(spark, sf_dir):
    return profile.top_values(profiled(spark, sf_dir))


@query
def profile_extremes(spark, sf_dir):
    return profile.extreme_values(profiled(spark, sf_dir))


@query
def profile_text(spark, sf_dir):
    return rounded(profile.text_stats(profiled(spark, sf_dir)), "mean_length", "median_length")


@query
def corr_pearson(spark, sf_dir):
    return rounded(profile.pearson(profiled(spark, sf_dir)), "pearson")


@query
def corr_spearman(spark, sf_dir):
    return rounded(profile.spearman(profiled(spark, sf_dir)), "spearman")


@query
def cramers_v(spark, sf_dir):
    found = profile.cramers_v(profiled(spark, sf_dir))
    return rounded(found, "cramers_v", "cramers_v_corrected")


@query
def nullity_corr(spark, sf_dir):
    rows = applications(spark, sf_dir).drop(ROW_ID)
    found = profile.nullity_correlation(rows, rows.columns)
    return rounded(found, "nullity_correlation")


def yearly_states(spark, sf_dir) -> str:
    """A folder of profile states, one batch for each year of orders, the first sent twice."""
    path = run_path(spark, "states")
    orders = pin(table(spark, sf_dir, "orders"), "orders")
    years = [r[0] for r in orders.select(F.year("o_orderdate").alias("y")).distinct().orderBy("y").collect()]
    for year in [*years, years[0]]:
        profile_state.add_batch(orders.filter(F.year("o_orderdate") == year), year, path)
    return path


@query
def profile_by_batches(spark, sf_dir):
    """Counts, means and extremes of orders merged from yearly states; no order is read again."""
    found = profile_state.profile_so_far(spark, yearly_states(spark, sf_dir))
    return rounded(found.select("column", "n_batches", "n_rows", "n_null", "mean", "min", "max"), "mean", places=4)


@query
def profile_sketched(spark, sf_dir):
    """Distinct counts and quantiles of orders as merged sketches estimate them."""
    return profile_state.profile_so_far(spark, yearly_states(spark, sf_dir)).drop("mean", "min", "max")


@query
def null_patterns(spark, sf_dir):
    """Which columns the applicants lack together."""
    rows = applications(spark, sf_dir).drop(ROW_ID)
    return gram.null_patterns(rows, rows.columns)


@query
def duplicates(spark, sf_dir):
    return profile.duplicate_rows(lines(spark, sf_dir))


@query
def duplicate_keys(spark, sf_dir):
    """Order lines whose number occurs more than once in their order."""
    return profile.duplicate_rows(lines(spark, sf_dir).select("l_orderkey", "l_linenumber"))


@query
def profile_alerts(spark, sf_dir):
    return rounded(profile.alerts(applications(spark, sf_dir)), "value")


@query
def head_tail(spark, sf_dir):
    return profile.head_tail(applications(spark, sf_dir), ROW_ID)


# Iterative models and selection -------------------------------------------------


# Labelled rows that a single fit learns from, and a fit of the forest grid; every row is scored.
FIT_ROWS, GRID_FIT_ROWS = 20_000, 1_000


def fitted_scores(spark, sf_dir, name: str) -> DataFrame:
    data = model_data(spark, sf_dir)
    rows = pin(selection.sampled(columns.design(data.train, data.features, target="label"), FIT_ROWS), "fit-rows")
    model = iterative.iterative_models(rows.count(), len(data.features))[name].fit(rows)
    scored = model.transform(columns.design(data.test, data.features, target="label"))
    return scored.select(ROW_ID, "label", "prediction")


@query
def lr_scored(spark, sf_dir):
    """Test rows under ridge logistic regression on all features and all training rows."""
    data = model_data(spark, sf_dir)
    model = logistic.fit_logistic(data.train, data.features)[logistic.EVERY]
    scored = closed_form.predict(data.test, model)
    return rounded(scored.select(ROW_ID, "label", "prediction", "probability"), "probability")


@query
def lr_cv_recall(spark, sf_dir):
    """Recall of all ten folds' logistic regressions, fitted in one job per Newton step."""
    data = model_data(spark, sf_dir)
    crossed = selection.logistic_cross_predict(folds.with_kfold(data.train), data.features)
    return rounded(selection.fold_scores(crossed, "LR"), "value")


@query
def tree_scored(spark, sf_dir):
    return fitted_scores(spark, sf_dir, "CART")


@query
def rf_scored(spark, sf_dir):
    return fitted_scores(spark, sf_dir, "RF")


@query
def rff_svm_scored(spark, sf_dir):
    return fitted_scores(spark, sf_dir, "SVM")


@query
def gbt_scored(spark, sf_dir):
    return fitted_scores(spark, sf_dir, "XGB")


def stump_scores(spark, sf_dir, estimator) -> DataFrame:
    """Test rows under a single split, learned from all training rows and every feature of few values."""
    data = model_data(spark, sf_dir)
    few = [f for f in data.features if f != "credit_amount"]
    model = estimator(len(few)).fit(columns.design(data.train, few, target="label"))
    scored = iterative.positive_probability(model.transform(columns.design(data.test, few, target="label")))
    return rounded(scored.select(ROW_ID, "label", "prediction", "probability"), "probability")


@query
def tree_stump(spark, sf_dir):
    return stump_scores(spark, sf_dir, lambda p: iterative.decision_tree(1))


@query
def forest_stump(spark, sf_dir):
    """A forest of one tree that draws neither rows nor features."""
    return stump_scores(spark, sf_dir, lambda p: iterative.random_forest(p, 1, 1, "all").setBootstrap(False))


@query
def boosted_stump(spark, sf_dir):
    return stump_scores(spark, sf_dir, lambda p: iterative.boosted_trees(1, 1))


@query
def model_ranking(spark, sf_dir):
    """All eight models by cross-validated recall, at the compared sizes."""
    data = model_data(spark, sf_dir)
    scores = selection.compare_models(folds.with_kfold(data.train), data.features, threads=8)
    return selection.summarize(scores)


def stratified_design(spark, sf_dir) -> tuple[DataFrame, int]:
    data = model_data(spark, sf_dir)
    rows = folds.with_stratified_kfold(data.train)
    return columns.design(rows, data.features, target="label", keep=("fold",)), len(data.features)


@query
def rf_grid(spark, sf_dir):
    """All 120 points of the forest grid from one forest per fold and feature count."""
    rows, p = stratified_design(spark, sf_dir)
    return selection.forest_grid(rows, p, fit_rows=GRID_FIT_ROWS)


@query
def gbt_grid(spark, sf_dir):
    """All 540 points of the boosted grid at 100 rounds, each over five folds."""
    rows, p = stratified_design(spark, sf_dir)
    rows = pin(rows, "stratified")
    return boosting.boosted_grid(rows, rows, p)


@query
def gbt_best_confusion(spark, sf_dir):
    """Test rows under the boosted trees that the grid search picks, with their accuracy."""
    data = model_data(spark, sf_dir)
    rows = pin(stratified_design(spark, sf_dir)[0], "stratified")
    _, model = selection.boosted_grid_search(rows, len(data.features))
    scored = pin(model.transform(columns.design(data.test, data.features, target="label")), "boosted-test")
    found = metrics.score(scored, "accuracy").first()["accuracy"]
    return metrics.confusion_matrix(scored).withColumn("accuracy", F.lit(found))


# Governance, sources and sinks --------------------------------------------------


@query
def lineage_log(spark, sf_dir):
    """Rows through every phase of the applicants' flow, under the batch of the last order."""
    raw = raw_texts(spark, sf_dir)
    checked = conform(raw)
    train_rows, _ = folds.train_test_split(checked.valid.select(ROW_ID))
    log = governance.phase_log({"raw": raw, "validation": checked.valid, "training": train_rows}, "orders")
    batch = table(spark, sf_dir, "orders").agg(batch_number(F.max("o_orderdate"))).first()[0]
    return log.drop("position").withColumn("batch_nr", F.lit(batch).cast("bigint"))


@query
def data_dictionary(spark, sf_dir):
    comments = {ROW_ID: "row index of the file", "risk": "good or bad"}
    return governance.data_dictionary(applications(spark, sf_dir), comments)


def dated_results(spark, sf_dir) -> DataFrame:
    rate = F.col("credit_amount") / F.col("duration")
    return applications(spark, sf_dir, dated=True).withColumns(
        {"batch_nr": batch_number(F.trunc("applied_on", "year")), "prediction": (rate > 6000).cast("double")}
    )


@query
def results_summary(spark, sf_dir):
    summary = governance.results_summary(dated_results(spark, sf_dir))
    return rounded(rounded(summary, "bad_share"), "credit_amount", places=2)


@query
def published_summary(spark, sf_dir):
    """Summary rebuilt from published, partitioned results, one changed batch after the rest."""
    results, summary = run_path(spark, "results"), run_path(spark, "summary")
    governance.publish(dated_results(spark, sf_dir).drop("applied_on"), results)
    governance.refresh_summary(spark, results, summary)
    governance.refresh_summary(spark, results, summary, [19960101])
    return rounded(rounded(spark.read.parquet(summary), "bad_share"), "credit_amount", places=2)


@query
def csv_landing(spark, sf_dir):
    """Applicants through a raw CSV with its original headers into landed parquet."""
    raw, landed = run_path(spark, "raw"), run_path(spark, "landed")
    names = dict(zip(applications(spark, sf_dir).columns, [f.name for f in files.csv_schema()]))
    applications(spark, sf_dir).withColumnsRenamed(names).write.option("header", True).csv(raw)
    files.land_csv(spark, raw, landed)
    return columns.canonical_names(files.read_parquet(spark, landed))


@query
def prefix_scan(spark, sf_dir):
    """Many files below one folder read as one table."""
    root = run_path(spark, "prefix")
    files.write_parquet(applications(spark, sf_dir).withColumn("part", F.col("purpose")), root, "part")
    return files.read_prefix(spark, root)


@query
def promoted_copy(spark, sf_dir):
    source, copy = run_path(spark, "source"), run_path(spark, "copy")
    files.write_parquet(applications(spark, sf_dir), source)
    done = promote(spark, source, copy, files=2)
    return spark.read.parquet(copy).agg(F.count("*").alias("n_rows"), F.lit(done.matched).alias("matched"))


@query
def promoted_partitions(spark, sf_dir):
    """Applicants by purpose, copied twice: the second copy moves the one purpose that changed."""
    source, copy, manifest = (run_path(spark, n) for n in ("source", "copy", "manifest"))
    rows = applications(spark, sf_dir)
    rows.write.partitionBy("purpose").parquet(source)
    first = promote_changed(spark, source, copy, manifest, "purpose")
    dearer = rows.filter("purpose = 'ASIA'").withColumn("credit_amount", F.col("credit_amount") + 1)
    dearer.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("purpose").parquet(source)
    second = promote_changed(spark, source, copy, manifest, "purpose")
    copies = [(value, first.written.count(value) + second.written.count(value)) for value in first.written]
    told = spark.createDataFrame(copies, "purpose string, n_copies int")
    found = spark.read.parquet(copy).groupBy("purpose").agg(F.count("*").alias("n_rows"), F.round(F.sum("credit_amount"), 2).alias("credit_amount"))
    return found.join(told, "purpose")


@query
def interleaved_scan(spark, sf_dir):
    """Orders of few customers at middling prices, read from a table laid out along both columns."""
    path = run_path(spark, "interleaved")
    governance.publish_interleaved(table(spark, sf_dir, "orders"), path, ["o_custkey", "o_totalprice"], ["o_orderkey"])
    low, high = spark.read.parquet(path).agg(F.min("o_custkey"), F.max("o_custkey")).first()
    near = F.col("o_custkey").between(low, low + (high - low) / 20)
    found = spark.read.parquet(path).filter(near & F.col("o_totalprice").between(100_000, 150_000))
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


@query
def warehouse_load(spark, sf_dir):
    schema = f"credit_{uuid.uuid4().hex[:12]}"
    warehouse.create_tables(spark, schema, run_path(spark, "warehouse"))
    warehouse.load_table(applications(spark, sf_dir), f"{schema}.card_data")
    return spark.table(f"{schema}.card_data")


@query
def daily_landing(spark, sf_dir):
    """Events landed by a stream into one partition per local day, then counted."""
    source, landed, progress = (run_path(spark, n) for n in ("arrivals", "landed", "progress"))
    arrivals = table(spark, sf_dir, "events")
    arrivals.repartition(4, "event_id").write.parquet(source)
    stream = new_files(spark, source, arrivals.schema).withColumn("batch_nr", batch_number(local_time(F.col("ts"))))
    land_stream(stream, landed, progress)
    # A second run finds nothing new.
    land_stream(stream, landed, progress)
    return (
        spark.read.parquet(landed)
        .groupBy(F.col("batch_nr").cast("bigint").alias("batch_nr"))
        .agg(F.count("*").alias("n_rows"), F.round(F.sum("value"), 2).alias("value"))
    )


@query
def classified_dataset(spark, sf_dir):
    """Every applicant with the class given by the fixed forest, in one projection."""
    data = model_data(spark, sf_dir)
    model, _ = train.fit_fixed_forest(data, fit_rows=FIT_ROWS)
    rows = applications(spark, sf_dir)
    whole = columns.log_column(encode.curate(rows.withColumn("_row", F.struct(*rows.columns))))
    lacking = F.array_compact(F.array(*[F.when(g, F.lit(c)) for c, g in gaps(whole, data.features).items()]))
    marked = whole.withColumn("_whole", F.size(lacking) == 0)
    scored = model.transform(columns.design(marked, data.features, keep=("_row", "_whole"), invalid="keep"))
    return scored.select("_row.*", F.when(F.col("_whole"), F.col("prediction")).alias("prediction"))


@query
def classified_by_bayes(spark, sf_dir):
    """Every applicant with the class given by naive Bayes, in one projection."""
    rows = applications(spark, sf_dir)
    return batch.classify(rows, batch.fit_state(rows)).drop("probability", "unscored")


def raw_files(spark, sf_dir) -> str:
    """A folder of CSV files with faults: other column orders, words for numbers, amounts of 0."""
    rows = applications(spark, sf_dir)
    names = dict(zip(rows.columns, [f.name for f in files.csv_schema()]))
    key = F.col(ROW_ID)
    dirty = rows.withColumns(
        {
            "age": F.when(key % 97 == 0, "abc").otherwise(F.col("age").cast("string")),
            "credit_amount": F.when(key % 89 == 1, 0.0).otherwise(F.col("credit_amount")),
            "job": F.when(key % 101 != 2, F.col("job")),
            "purpose": F.when(key % 103 == 3, F.repeat("purpose", F.lit(20))).otherwise(F.col("purpose")),
        }
    )
    path = run_path(spark, "raw")
    for order, part in ((1, key % 2 == 0), (-1, key % 2 == 1)):
        turned = dirty.filter(part).select(*rows.columns[::order]).withColumnsRenamed(names)
        turned.write.mode("append").option("header", True).csv(path)
    return path


@query
def batch_published(spark, sf_dir):
    """What the daily batch makes of faulty files: every row is quarantined or published."""
    paths = batch.Paths(run_path(spark, "lake"), raw_files(spark, sf_dir))
    batch.run_batch(spark, paths, datetime(2023, 5, 12))
    bad = spark.read.parquet(paths.quarantine).select(ROW_ID, F.concat(F.lit("quarantined "), "violations").alias("outcome"))
    done = spark.read.parquet(paths.results).select(
        ROW_ID, F.coalesce(F.concat(F.lit("unscored "), "unscored"), F.when(F.col("prediction").isNotNull(), "scored")).alias("outcome")
    )
    return bad.unionAll(done).select(F.col(ROW_ID).cast("bigint").alias(ROW_ID), "outcome")


AGAIN_BYTES = 1 << 30  # of the files that one file of rows sent again draws on, at most


def send_again(spark, path: str) -> None:
    """A third of the rows a second time, in as few files as ``AGAIN_BYTES`` allows."""
    again = files.read_csv_text(spark, path)
    row_id = F.col(again.columns[0]).cast("long")
    parts = max(1, -(-files.folder_bytes(spark, path) // AGAIN_BYTES))
    again.filter(row_id % 3 == 0).repartition(parts).write.mode("append").option("header", True).csv(path)


@query
def stream_published(spark, sf_dir):
    """What streamed micro-batches make of faulty files, a third of whose rows come a second time."""
    paths = batch.Paths(run_path(spark, "lake"), raw_files(spark, sf_dir))
    send_again(spark, paths.source)
    daily.classify_new_files(spark, paths, run_path(spark, "progress"), datetime(2023, 5, 12), per_batch=2)
    bad = spark.read.parquet(paths.quarantine).select(ROW_ID, F.concat(F.lit("quarantined "), "violations").alias("outcome"))
    done = spark.read.parquet(paths.results).select(
        ROW_ID, F.coalesce(F.concat(F.lit("unscored "), "unscored"), F.when(F.col("prediction").isNotNull(), "scored")).alias("outcome")
    )
    return bad.unionAll(done).select(F.col(ROW_ID).cast("bigint").alias(ROW_ID), "outcome")


def dated_files(spark, rows) -> str:
    """A folder of CSV files with a day in their names: rows of even ids on one day, the others on
    the next, each day in as many files as Spark has tasks for it."""
    source, staged = run_path(spark, "dated"), run_path(spark, "staged")
    names = dict(zip(rows.columns, [f.name for f in files.csv_schema()]))
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(source))
    for day in (12, 13):
        part = rows.filter(F.col(ROW_ID) % 2 == day % 2).withColumnsRenamed(names)
        part.write.option("header", True).csv(f"{staged}/{day}")
        written = [file for group in files.file_headers(spark, f"{staged}/{day}").values() for file in group]
        for i, file in enumerate(written):
            fs.rename(fs_path(file), fs_path(f"{source}/credit_{i}_{day}052023.csv"))
    return source


@query
def dated_landing(spark, sf_dir):
    """Applicants from files with a day in their names, one partition per day."""
    landed = run_path(spark, "landed")
    files.land_daily(spark, dated_files(spark, applications(spark, sf_dir)), landed)
    return columns.canonical_names(spark.read.parquet(landed)).select(
        ROW_ID, "purpose", "credit_amount", F.col("batch_nr").cast("bigint").alias("batch_nr")
    )


@query
def lineage_append(spark, sf_dir):
    """The lineage of two loads of the applicants, appended one after the other."""
    log = run_path(spark, "lineage")
    for step, day in (("raw", 12), ("curation", 13)):
        n = applications(spark, sf_dir).filter(F.col(ROW_ID) % 2 == day % 2).count()
        record = governance.lineage_record(spark, step, "applications", step, datetime(2023, 5, day, 7, 30), n, n)
        governance.append_lineage(record, log)
    kept = spark.read.parquet(log)
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp")
    return kept.select("batch_nr", stamp, "step", "source", "destination", "rows_out")


@query
def gnb_roc(spark, sf_dir):
    """The ROC curve of naive Bayes' probability (to six places) on the test rows."""
    scored = rounded(bayes_scored(spark, sf_dir, "test"), "probability")
    curve = metrics.roc_curve(scored, "probability")
    return rounded(curve, *[c for c in curve.columns if c in ("tpr", "fpr", "threshold")])
