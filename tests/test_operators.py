import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import columns, encode, folds, metrics, profile
from riskloom.operators.conform import conform
from riskloom.sources.applications import applications


def cells(df):
    return sorted(map(tuple, df.collect()))


def test_all_null_category(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None)], "application_id bigint, saving_accounts string")
    out, new = encode.one_hot_encoder(df)
    assert new == [] and out.columns == ["application_id"]
    out, new = encode.one_hot_encoder(columns.fill_missing(df), nan_as_category=True)
    assert new == ["saving_accounts_nan"] and cells(out) == [(1, 0), (2, 0), (3, 0)]


def test_one_level_drops_to_nothing(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "application_id bigint, sex string")
    assert encode.one_hot_encoder(df)[1] == []


def test_odd_names_survive(spark, tmp_path):
    df = spark.createDataFrame([(1, "radio/TV", "p"), (2, "car", "q")], "application_id bigint, `a.b` string, `Saving accounts` string")
    out, new = encode.one_hot_encoder(df)
    assert new == ["a.b_radio/TV", "Saving accounts_q"]
    out.write.parquet(str(tmp_path / "odd"))
    assert cells(spark.read.parquet(str(tmp_path / "odd"))) == [(1, 1, 0), (2, 0, 1)]


def test_unseen_level_is_all_zero(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("c",)], "sex string")
    levels = encode.fit_levels(seen, ["sex"])
    new = spark.createDataFrame([("c",), ("d",), (None,)], "sex string")
    out, _ = encode.one_hot_encoder(new, levels=levels)
    assert sorted(map(tuple, out.collect())) == [(0, 0), (0, 0), (0, 1)]


def test_levels_round_trip_and_limit(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x")], "p string, q string")
    levels = encode.fit_levels(df, ["p", "q"])
    assert levels.values == {"p": ["a", "b", "c"], "q": ["x", "y"]}
    assert encode.Levels.from_table(levels.to_table(spark)) == levels
    with pytest.raises(ValueError):
        encode.fit_levels(df, ["p"], max_levels=2)


def test_band_edges(spark):
    df = spark.createDataFrame([(18,), (19,), (25,), (26,), (120,), (121,)], "age int")
    right = [r[0] for r in df.select(encode.bucketize("age")).collect()]
    assert right == [None, "Student", "Student", "Young", "Senior", None]
    left = [r[0] for r in df.select(encode.bucketize("age", right_closed=False)).collect()]
    assert left == ["Student", "Student", "Young", "Young", None, None]


def test_given_bands_are_kept(spark):
    df = spark.createDataFrame([(1, 30, "x"), (2, 40, "y")], "application_id bigint, age int, age_cat string")
    assert encode.curate(df).columns == ["application_id", "age", "Age_cat_y"]


def test_association_equals_numpy(spark):
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 3, 500), rng.integers(0, 4, 500)
    b[:200] = a[:200]
    df = spark.createDataFrame([(str(i), str(j)) for i, j in zip(a, b)], "a string, b string")
    seen = np.zeros((3, 4))
    np.add.at(seen, (a, b), 1)
    expected = np.outer(seen.sum(1), seen.sum(0)) / 500
    want = np.sqrt(((seen - expected) ** 2 / expected).sum() / 500 / 2)
    assert abs(profile.cramers_v(df).first()["cramers_v"] - want) < 1e-9


def test_curated_groups_and_plan(spark, sf_dir):
    out = encode.curate(applications(spark, sf_dir))
    for prefix in ("Purpose", "Sex", "Housing", "Savings", "Check", "Age_cat"):
        group = [columns.quoted(c) for c in out.columns if c.startswith(prefix + "_")]
        assert group and out.select(F.max(sum(group[1:], group[0]))).first()[0] <= 1
    assert "Risk_good" not in out.columns and "risk" not in out.columns
    # One narrow projection over the rows: indicators add no exchange.
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(out).count("Exchange") == plan(applications(spark, sf_dir)).count("Exchange")


def test_too_long_text_is_quarantined(spark):
    df = spark.createDataFrame(
        [(1, "30", "undecided"), (2, "x", "male"), (3, None, "female")], "application_id bigint, age string, sex string"
    )
    out = conform(df)
    assert cells(out.violations) == [("age:not_numeric", 1), ("sex:longer_than_8", 1)]
    assert [r["application_id"] for r in out.valid.collect()] == [3]
    assert out.quarantine.count() == 2 and dict(out.valid.dtypes)["age"] == "int"


def test_split_is_a_partition(spark):
    df = spark.range(4000).withColumnRenamed("id", "application_id")
    left, right = folds.train_test_split(df)
    assert left.intersect(right).count() == 0 and left.count() + right.count() == 4000
    assert abs(right.count() / 4000 - 0.25) < 0.03


def test_fold_sizes(spark):
    df = spark.range(103).withColumnRenamed("id", "application_id")
    sizes = [r["n_rows"] for r in folds.fold_sizes(folds.with_kfold(df)).orderBy("fold").collect()]
    assert sizes == [11, 11, 11] + [10] * 7


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_folds_do_not_depend_on_partitioning(spark, parts):
    ids = np.random.default_rng(0).choice(10**6, 1007, replace=False)
    df = spark.createDataFrame([(int(i), int(i) % 3) for i in ids], "application_id bigint, label int").repartition(parts)
    got = {r["application_id"]: r["fold"] for r in folds.with_kfold(df, limit=50).collect()}
    want = {int(i): f for f, part in enumerate(np.array_split(np.sort(ids), 10)) for i in part}
    assert got == want
    for label in range(3):
        want.update(
            {int(i): f for f, part in enumerate(np.array_split(np.sort(ids[ids % 3 == label]), 5)) for i in part}
        )
    got = {r["application_id"]: r["fold"] for r in folds.with_stratified_kfold(df, limit=50).collect()}
    assert got == want


def test_fewer_rows_than_folds(spark):
    df = spark.range(3).withColumnRenamed("id", "application_id")
    assert [r["fold"] for r in folds.with_kfold(df).orderBy("application_id").collect()] == [0, 1, 2]


def predictions(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "label double, prediction double, score double")


def test_one_class_fold_scores_zero(spark):
    row = metrics.score(predictions(spark, [(0, 0, 0)]), "recall", "fbeta2", "precision", "accuracy").first()
    assert tuple(row) == (0.0, 0.0, 0.0, 1.0)


def test_confusion_holds_zero_cells(spark):
    got = cells(metrics.confusion_matrix(predictions(spark, [(0, 0, 0), (1, 0, 0)])))
    assert got == [(0.0, 0.0, 1), (0.0, 1.0, 0), (1.0, 0.0, 1), (1.0, 1.0, 0)]


@pytest.mark.parametrize("size", [10**6, 5, 1])
@pytest.mark.parametrize("drop", [True, False])
def test_roc_in_pieces_equals_one_sort(spark, size, drop):
    rng = np.random.default_rng(9)
    y, s = rng.integers(0, 2, 400), np.round(rng.normal(0, 1, 400), 1)
    df = predictions(spark, [(a, 0, b) for a, b in zip(y, s)])
    got = cells(metrics.roc_curve(df, drop_intermediate=drop, rows_per_bucket=size))
    levels = np.unique(s)[::-1]
    tps = np.array([y[s >= t].sum() for t in levels])
    fps = np.array([(1 - y)[s >= t].sum() for t in levels])
    keep = np.ones(len(levels), dtype=bool)
    if drop:
        keep[1:-1] = (np.diff(tps, 2) != 0) | (np.diff(fps, 2) != 0)
    want = [(0.0, 0.0, levels[0] + 1)]
    want += [(f / (1 - y).sum(), t / y.sum(), lv) for f, t, lv in zip(fps[keep], tps[keep], levels[keep])]
    assert np.allclose(got, sorted(want))
    assert len({r[2] for r in got}) == len(got)


def test_profile_of_duplicates_and_constants(spark):
    df = spark.createDataFrame([(1, "x", 5)] * 3 + [(2, None, 5)], "a int, b string, c int")
    assert tuple(profile.overview(df).first()) == (4, 3, 1, 1 / 12, 2)
    kinds = {r["column"]: r["kind"] for r in profile.column_summary(df).collect()}
    assert kinds == {"a": "numeric", "b": "constant", "c": "constant"}
    assert cells(profile.duplicate_rows(df)) == [(1, "x", 5, 3)]
    assert profile.pearson(df).filter("pearson IS NOT NULL").count() == 0


def test_profile_runs_whole(spark, sf_dir):
    for name, df in profile.profile(applications(spark, sf_dir), "application_id").items():
        if name != "duplicates":
            assert df.count() > 0, name


def test_ranks_by_pieces(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 20, 300)
    df = spark.createDataFrame([(int(v), 0) for v in x], "x int, y int")
    got = {(r["column"], r["value"]): r["rank"] for r in profile.average_ranks(df, ["x", "y"], 3).collect()}
    for v in set(x):
        assert got[("x", v)] == (x < v).sum() + ((x == v).sum() + 1) / 2
    assert got[("y", 0)] == 150.5


def test_quantiles_by_rounds_equal_builtin(spark, sf_dir):
    df = applications(spark, sf_dir)
    small, large = profile.quantile_table(df), profile.quantile_table(df, limit=100)
    assert np.allclose([r[1:] for r in small.collect()], [r[1:] for r in large.collect()])


def test_approximate_distinct(spark, sf_dir):
    exact = {r["column"]: r["n_distinct"] for r in profile.column_summary(applications(spark, sf_dir)).collect()}
    rough = profile.column_summary(applications(spark, sf_dir), approximate=True)
    for r in rough.collect():
        assert abs(r["n_distinct"] - exact[r["column"]]) <= 0.15 * exact[r["column"]]
