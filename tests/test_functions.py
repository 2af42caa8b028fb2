import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.order_stats import order_statistics, quantiles
from riskloom.functions.running import running_totals
from riskloom.functions.scalars import file_date, local_time, natural_log


def values_table(spark):
    """Skewed on purpose: a third of group a is one value, group b has far outliers."""
    rng = np.random.default_rng(3)
    a = np.r_[np.full(1000, 7.25), rng.normal(0, 50, 2000)]
    b = np.r_[rng.normal(0, 1, 500), [1e9, -1e12, 5e15]]
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("b", None), ("c", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(7), {"a": a, "b": b}


@pytest.mark.parametrize("limit", [10**6, 40, 1])
def test_quantiles_equal_numpy(spark, limit):
    df, want = values_table(spark)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = quantiles(df, "v", probs, by=("g",), limit=limit)
    assert set(got) == {("a",), ("b",)}
    for g, v in want.items():
        assert np.allclose(got[(g,)], np.quantile(v, probs), rtol=1e-12, atol=1e-9)


def test_order_statistics_of_large_ids(spark):
    # Neighbouring ids that are the same number as doubles.
    base = 2**60
    df = spark.range(base, base + 5000).repartition(5)
    n, found = order_statistics(df, "id", lambda n: [0, 17, 2500, n - 1], limit=50)[()]
    assert n == 5000
    assert found == {0: base, 17: base + 17, 2500: base + 2500, 4999: base + 4999}


@pytest.mark.parametrize("size,descending", [(10**6, False), (37, False), (37, True), (1, True)])
def test_running_totals(spark, size, descending):
    rng = np.random.default_rng(5)
    keys, amounts = rng.permutation(300), rng.integers(0, 9, 300)
    df = spark.createDataFrame([(float(k), int(a)) for k, a in zip(keys, amounts)], "k double, a int")
    got = {r["k"]: r["upto_a"] for r in running_totals(df, "k", ["a"], descending, size).collect()}
    for k in keys:
        before = keys >= k if descending else keys <= k
        assert got[float(k)] == amounts[before].sum()


def test_log_guard(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(natural_log(F.col("x"))).collect()] == [None, None, 0.0, None]


def test_file_date(spark):
    df = spark.createDataFrame([("/a/german_credit_data_12052023.csv",), ("/a/other.csv",)], "p string")
    assert [str(r[0]) for r in df.select(file_date(F.col("p"))).collect()] == ["2023-05-12", "None"]


def test_local_time(spark):
    df = spark.sql("SELECT timestamp '2024-01-01 05:00:00' AS t").select(local_time(F.col("t")).cast("string"))
    assert df.first()[0] == "2023-12-31 22:00:00"


def spark_order(v):
    return (v != v, 0.0) if v != v else (False, v.encode() if isinstance(v, str) else v)


@pytest.mark.parametrize("kind", ["nan", "text", "date", "hot"])
def test_every_size_and_type_is_selected_alike(spark, kind):
    from datetime import date, timedelta

    rng = np.random.default_rng(7)
    made = {
        "nan": [float(x) for x in rng.normal(size=900)] + [float("nan")] * 40 + [float("inf")] * 30 + [float("-inf")] * 30,
        "text": [f"k{x}" for x in rng.integers(0, 10_000, 1000)] + ["é", "z\U0001f600", ""],
        "date": [date(2020, 1, 1) + timedelta(days=int(x)) for x in rng.integers(0, 900, 1000)],
        "hot": [5] * 700 + [int(x) for x in rng.integers(0, 1000, 300)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in made], ["v"])
    ordered, ranks = sorted(made, key=spark_order), [0, 1, 333, 500, 700, 960, len(made) - 1]
    for limit in (10, 1_000_000):
        n, found = order_statistics(df, "v", lambda n: ranks, limit=limit)[()]
        assert n == len(made) and all(spark_order(found[r]) == spark_order(ordered[r]) for r in ranks)


def test_roc_places_nan_alike_at_every_size(spark):
    from riskloom.operators import metrics

    rng = np.random.default_rng(2)
    rows = [(float(s), float(rng.integers(2))) for s in rng.normal(size=600)] + [(float("nan"), 1.0), (float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    curves = [sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, rows_per_bucket=n).collect()) for n in (50, 1_000_000)]
    assert curves[0] == curves[1]


def test_folds_of_text_ids_at_every_size(spark):
    from riskloom.operators import folds

    df = spark.createDataFrame([(f"id{i:04d}",) for i in range(500)], "application_id string")
    a, b = ({r[0]: r["fold"] for r in folds.with_kfold(df, 10, limit=n).collect()} for n in (20, 1_000_000))
    assert a == b and len(set(a.values())) == 10
