import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting, closed_form, columns, features, folds, iterative, neighbors, selection
from riskloom.operators.moments import all_but, class_moments
from riskloom.plans import train
from riskloom.plans.catalog import model_data
from riskloom.session import pin


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    made = model_data(spark, sf_dir)
    return train.TrainingData(pin(made.rows, "features"), made.features)


@pytest.fixture(scope="module")
def folded(data):
    return pin(folds.with_kfold(data.train), "folded")


def arrays(df, names, *extra):
    rows = df.orderBy("application_id").select(*[columns.quoted(c) for c in names], "label", *extra).toPandas()
    return rows[names].to_numpy(float), rows["label"].to_numpy(), *[rows[e].to_numpy() for e in extra]


def test_moments_equal_numpy(data, folded):
    x, y, fold = arrays(folded, data.features, "fold")
    got = class_moments(folded, data.features, "fold")
    for f in range(10):
        stats = all_but(got, f)
        for c in (0.0, 1.0):
            rows = x[(fold != f) & (y == c)]
            assert stats[c].n == len(rows)
            assert np.allclose(stats[c].mean, rows.mean(0))
            assert np.allclose(stats[c].scatter, np.cov(rows.T, bias=True) * len(rows), atol=1e-6)


def test_moments_far_from_zero(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (500, 2)) + 1e9
    df = spark.createDataFrame([(float(a), float(b), float(i % 2)) for i, (a, b) in enumerate(x)], "a double, b double, label double")
    stats = all_but(class_moments(df, ["a", "b"]), None)
    for c in (0, 1):
        assert np.allclose(stats[c].variance, x[c::2].var(0), rtol=1e-5)


def test_discriminant_equals_numpy(data):
    x, y = arrays(data.train, data.features)
    xt, _ = arrays(data.test, data.features)
    within = sum((x[y == c] - x[y == c].mean(0)).T @ (x[y == c] - x[y == c].mean(0)) for c in (0, 1)) / (len(x) - 2)
    inverse = np.linalg.pinv(within)
    score = lambda c: xt @ inverse @ x[y == c].mean(0) - 0.5 * x[y == c].mean(0) @ inverse @ x[y == c].mean(0) + np.log((y == c).mean())
    model = closed_form.fit(data.train, closed_form.FITTERS["LDA"], data.features)
    got = closed_form.predict(data.test, model).orderBy("application_id").toPandas()
    assert (got["prediction"].to_numpy() == (score(1) > score(0))).all()
    assert np.allclose(got["probability"], 1 / (1 + np.exp(score(0) - score(1))), atol=1e-6)


def test_union_equals_staged_pipeline(data):
    """The closed form and the Spark ML stages are the same model."""
    model = closed_form.fit(data.train, closed_form.FITTERS["UNION"], data.features)
    ours = closed_form.predict(data.test, model).select("application_id", F.col("prediction").alias("p"))
    staged = features.union_pipeline().fit(columns.design(data.train, data.features, target="label"))
    theirs = staged.transform(columns.design(data.test, data.features, target="label"))
    both = ours.join(theirs, "application_id")
    assert both.filter(F.col("p") != F.col("prediction")).count() == 0 and both.count() == data.test.count()


def test_out_of_fold_equals_fold_by_fold(data, folded):
    crossed = closed_form.cross_predict(folded, closed_form.FITTERS["UNION"], data.features)
    got = {r["application_id"]: r["probability"] for r in crossed.collect()}
    for f in (0, 7):
        model = closed_form.fit(folded.filter(F.col("fold") != f), closed_form.FITTERS["UNION"], data.features)
        for r in closed_form.predict(folded.filter(F.col("fold") == f), model).collect():
            assert abs(got[r["application_id"]] - r["probability"]) < 1e-8


def test_class_missing_from_a_training_part(spark):
    rows = [(i, float(i % 7), 1.0 if i < 10 else 0.0, 0 if i < 10 else 1 + i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "application_id bigint, x double, label double, fold int")
    got = closed_form.cross_predict(df, closed_form.FITTERS["NB"], ["x"]).filter("fold = 0").select("prediction")
    assert {r[0] for r in got.collect()} == {0.0}


def test_select_k_best_agrees_with_spark_ml(data):
    from pyspark.ml.feature import UnivariateFeatureSelector

    ours = [r["feature"] for r in features.select_k_best(data.train, data.features).collect()]
    selector = UnivariateFeatureSelector(featuresCol="features", labelCol="label", selectionMode="numTopFeatures")
    selector = selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(6)
    chosen = selector.fit(columns.design(data.train, data.features, target="label")).selectedFeatures
    assert sorted(ours) == sorted(data.features[i] for i in chosen)


def brute_force(x, ids, labels, fold, q, qfold, k):
    d2 = ((q[:, None, :] - x[None, :, :]) ** 2).sum(2)
    d2[qfold[:, None] == fold[None, :]] = np.inf
    return [[ids[j] for j in np.lexsort((ids, row))[:k]] for row in d2]


@pytest.mark.parametrize("leaf,block", [(10**6, 10**6), (50, 10**6), (50, 40), (60, 25)])
def test_neighbours_equal_brute_force(spark, leaf, block):
    """Small integer coordinates make ties common; a third of all rows is one point."""
    rng = np.random.default_rng(4)
    n = 900
    x = rng.integers(0, 6, (n, 3)).astype(float)
    x[: n // 3] = [2, 2, 2]
    labels, fold = rng.integers(0, 2, n), rng.integers(0, 4, n)
    rows = [(int(i), *map(float, x[i]), float(labels[i]), int(fold[i])) for i in rng.permutation(n)]
    df = spark.createDataFrame(rows, "application_id bigint, a double, b double, c double, label double, fold int")
    found = neighbors.k_nearest(df, df, ["a", "b", "c"], 5, "fold", leaf_rows=leaf, block_rows=block)
    got: dict[int, list] = {}
    for r in found.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["nid"])
    want = brute_force(x, np.arange(n), labels, fold, x, fold, 5)
    assert got == {i: w for i, w in enumerate(want)}


def test_neighbours_fewer_than_k(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 5.0, 0.0)], "application_id bigint, x double, label double")
    got = neighbors.k_nearest(df, df, ["x"], 5, leaf_rows=1).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["nid"]) for r in got] == [(1, 1), (1, 2), (2, 2), (2, 1)]


def test_best_of_prefers_the_earlier_point(spark):
    df = spark.createDataFrame([(0, "a", 0.5), (1, "b", 0.9), (2, "c", 0.9)], "grid_index int, params string, mean_score double")
    assert selection.best_of(df).first()["params"] == "b"


def test_summary_line(spark):
    df = spark.createDataFrame([("NB", 0, "recall", 0.5), ("NB", 1, "recall", 1.0)], "model string, fold int, metric string, value double")
    assert tuple(selection.summarize(df).first()) == ("NB", 0.75, 0.25)


def test_full_grids():
    from riskloom.constants import BOOSTED_GRID, FOREST_GRID

    assert len(selection.grid_points(FOREST_GRID)) == 120 and len(selection.grid_points(BOOSTED_GRID)) == 540


def test_features_per_split_are_clamped():
    with pytest.warns(UserWarning):
        assert iterative.subset_size(20, 7) == "7"
    assert iterative.subset_size("sqrt", 7) == "sqrt"


@pytest.mark.parametrize("name", ["LR", "CART", "RF", "SVM", "XGB"])
def test_iterative_models_learn(data, name):
    rows = columns.design(data.train, data.features, target="label")
    n, p = rows.count(), len(data.features)
    small = {
        "LR": iterative.logistic_regression(n, max_iter=25),
        "CART": iterative.decision_tree(12),
        "RF": iterative.random_forest(p, 15, 8),
        "SVM": iterative.KernelSvm(n, p, size=64, max_iter=10),
        "XGB": iterative.boosted_trees(5, 4),
    }
    assert set(iterative.iterative_models(n, p)) == set(small)
    model = small[name].fit(rows)
    test = columns.design(data.test, data.features, target="label")
    scored = model.transform(test)
    hits = scored.agg(
        F.count("*").alias("n"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("right"),
        F.avg(1 - F.col("label")).alias("majority"),
    ).first()
    assert hits["n"] == data.test.count()
    assert hits["right"] > hits["majority"]
    if name == "RF":
        shares = iterative.positive_probability(scored).agg(F.min("probability"), F.max("probability")).first()
        assert 0 <= shares[0] < shares[1] <= 1


def test_null_features_are_skipped_and_counted(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, None, 0.0)], "application_id bigint, x double, label double")
    assert columns.design(df, ["x"], target="label").count() == 1
    assert tuple(columns.skipped_rows(df, ["x"]).first()) == (2, 1)


def test_truncated_forest_is_a_smaller_forest(spark, data):
    """The grid's walk over saved nodes votes as Spark does, whole and with fewer trees."""
    rows = pin(columns.design(data.train, data.features, target="label"), "rows")
    model = iterative.random_forest(len(data.features), 6, 4, 5).fit(rows)
    trees = selection.node_arrays(model, spark)
    x = np.stack([r["features"].toArray() for r in rows.collect()])
    want = np.array([r["prediction"] for r in model.transform(rows).collect()])
    got = selection.truncated_votes(trees, [2, 4, 30], [3, 6], x)
    assert (got[:, 2, 1] == (want == 1)).mean() > 0.999 and (got[:, 1] == got[:, 2]).all()
    short = [[t.predict(v) for v in rows.limit(40).toPandas()["features"]] for t in model.trees[:1]]
    assert len(short[0]) == 40


def test_fold_samples_are_the_lowest_hashes_outside_each_fold(spark):
    df = spark.range(600).select(F.col("id").alias("application_id"), (F.col("id") % 3).cast("int").alias("fold"))
    for fold, rows in enumerate(selection.fold_samples(df, 3, 50)):
        want = selection.sampled(df.filter(F.col("fold") != fold), 50)
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, want.collect())) and rows.count() == 50


def test_truncated_votes_follow_each_row(spark):
    """Votes of cut-off trees equal a walk row by row."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (200, 3))

    def tree(depth):
        nodes = []

        def grow(d):
            at = len(nodes)
            nodes.append([-1, 0.0, -1, -1, rng.random()])
            if d and rng.random() < 0.9:
                nodes[at][:2] = [int(rng.integers(3)), float(rng.normal())]
                nodes[at][2] = grow(d - 1)
                nodes[at][3] = grow(d - 1)
            return at

        grow(depth)
        return tuple(np.array(c) for c in zip(*nodes))

    trees, depths, counts = [tree(9) for _ in range(5)], [0, 2, 4, 30], [1, 3, 5]

    def share(t, row, depth):
        feature, threshold, left, right, shares = t
        at = 0
        for _ in range(depth):
            if feature[at] < 0:
                break
            at = left[at] if row[feature[at]] <= threshold[at] else right[at]
        return shares[at]

    want = [[[sum(share(t, row, d) for t in trees[:n]) / n > 0.5 for n in counts] for d in depths] for row in x]
    assert np.array_equal(selection.truncated_votes(trees, depths, counts, x), np.array(want))
    # Each cut is tested once for all rows, however many trees have it.
    feature, threshold = np.array([0, -1, -1]), np.array([0.0, 0.0, 0.0])
    tested = []
    boosting.leaf_places(
        boosting.tree_plan(0, feature.tolist(), threshold.tolist(), [1, -1, -1], [2, -1, -1], []),
        boosting.remembered(lambda f, t: tested.append((f, t)) or x[:, f] > t), np.dtype(np.int8),
    )
    assert tested == [(0, 0.0)]


def test_cuts_part_values_whose_median_is_the_largest():
    x = np.array([[float(i % 3 > 0), 0.01 * (i % 8)] for i in range(960)])
    sizes = np.bincount(neighbors._Cuts.of(x, 3).leaf(x))
    # Two thirds are ones, so a cut at the median leaves all rows on one side, at every depth.
    assert sizes.max() <= 240 and sizes.sum() == 960


def test_forest_grid_has_every_point(data):
    rows = pin(columns.design(folds.with_stratified_kfold(data.train, k=2), data.features, target="label", keep=("fold",)), "rows")
    grid = {"max_depth": [2, None], "n_estimators": [1, 4], "max_features": [3, 99]}
    table = selection.forest_grid(rows, len(data.features), grid, folds=2, fit_rows=300).collect()
    assert sorted(r["grid_index"] for r in table) == list(range(8)) and all(0 <= r["mean_score"] <= 1 for r in table)


def test_leaves_stay_small_in_every_cell(spark):
    """The tree has many top cells, and leaves near the wanted size in each."""
    rng = np.random.default_rng(6)
    rows = [(i, float(i % 2), 0, [float(v) for v in p]) for i, p in enumerate(rng.normal(0, 1, (4_000, 3)))]
    points = pin(spark.createDataFrame(rows, "id bigint, label double, fold int, x array<double>"), "points")
    top = neighbors._top_cells(points, 4_000, 60, 3)
    placed = neighbors._with_leaf(points, "id", top, None, 60, 500)
    cuts = neighbors._leaf_cuts(pin(placed, "points"), 60, 3)
    leaves = neighbors._with_leaf(placed, "id", top, cuts, 60, 500).groupBy("top", "leaf").count().collect()
    assert sum(r["count"] for r in leaves) == 4_000
    assert len({r["top"] for r in leaves}) == 16 and len(leaves) > 60
    assert max(r["count"] for r in leaves) <= 120


def test_no_training_rows_give_no_neighbours(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0)], "application_id bigint, x double, label double")
    assert neighbors.k_nearest(df.limit(0), df, ["x"]).count() == 0
    assert neighbors.k_nearest(df, df.limit(0), ["x"]).count() == 0


def test_far_boxes_are_passed_over_together(monkeypatch):
    """A query is compared with a few boxes of many, and finds all within its reach."""
    rng = np.random.default_rng(9)
    low = np.arange(1_000.0)[:, None] * [1.0, 0.5]
    high = low + rng.uniform(0, 2, low.shape)
    q, r2 = rng.uniform(-5, 1_005, (300, 1)) * [1.0, 0.5], rng.uniform(0, 9, 300)
    r2[:3] = np.inf, 0.0, np.nan
    gap = np.maximum(np.maximum(low - q[:, None], q[:, None] - high), 0)
    want = np.argwhere((gap**2).sum(axis=2) <= r2[:, None])
    compared, gap2 = [], neighbors._gap2

    def counted(*boxes):
        compared.append(gap2(*boxes))
        return compared[-1]

    monkeypatch.setattr(neighbors, "_gap2", counted)
    found = np.concatenate([np.stack(pairs, axis=1) for pairs in neighbors._within(q, r2, low, high)])
    assert np.array_equal(found, want)
    assert sum(c.size for c in compared) < len(q) * 100


def test_the_ranking_learns_from_all_rows_outside_each_fold(spark, sf_dir, data, monkeypatch):
    from riskloom.plans import catalog

    class Learned(Exception):
        pass

    def counted(df, estimator, folds=10, threads=4, fit_rows=None, train=None):
        raise Learned([(rows.count(), df.filter(F.col("fold") != f).count()) for f, rows in enumerate(train)])

    monkeypatch.setattr(selection, "cross_predict", counted)
    with pytest.raises(Learned) as learned:
        catalog.model_ranking(spark, sf_dir)
    found = learned.value.args[0]
    assert len(found) == 10 and all(fitted == outside > 1_000 for fitted, outside in found)
