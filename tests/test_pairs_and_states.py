"""Pairwise statistics from one pass, and profiles merged from batches' states."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import gram, profile, profile_state


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(3)
    n = 2_000
    x = rng.normal(1e6, 1, (n, 6))
    x[:, 1] += x[:, 0] - 1e6
    x[:, 2] = 0.1
    x[rng.random((n, 6)) < 0.2] = np.nan
    x[:, 4] = np.nan
    x[3:, 5] = np.nan
    return pd.DataFrame(x, columns=list("abcdef"))


def test_correlations_over_rows_that_have_both(spark, gappy):
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in gappy.to_numpy()]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in gappy)).repartition(5)
    got = {(r[0], r[1]): r[2] for r in profile.pearson(df).collect()}
    want = gappy.corr(min_periods=2)
    assert len(got) == 15
    for (a, b), r in got.items():
        if a in "ce" or b in "ce":
            assert r is None
        elif np.isnan(want.loc[a, b]):
            assert r is None
        else:
            assert abs(r - want.loc[a, b]) < 1e-7, (a, b)
    flags = gappy.isna().astype(float).corr()
    gaps = {(r[0], r[1]): r[2] for r in profile.nullity_correlation(df).collect()}
    for (a, b), r in gaps.items():
        assert (r is None and np.isnan(flags.loc[a, b])) or abs(r - flags.loc[a, b]) < 1e-9
    assert df.select("a").transform(lambda d: profile.pearson(d)).count() == 0
    assert profile.pearson(df.limit(0)).filter("pearson IS NOT NULL").count() == 0


def test_plans_do_not_grow_with_the_pairs(spark):
    wide = spark.range(50).select(*[F.when(F.col("id") % (i + 2) > 0, F.col("id") * (i + 1)).alias(f"c{i}") for i in range(300)])
    text = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    patterns = gram.null_patterns(wide, wide.columns)
    assert text(patterns) < 100_000
    assert profile.nullity_correlation(wide).count() == 300 * 299 // 2
    some = wide.select(*[F.col(c).cast("string") for c in wide.columns[:60]])
    assert text(profile.cramers_v(some)) < 60_000


def test_states_merge_within_their_bounds(spark, tmp_path):
    df = spark.range(60_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(40_000))).alias("key"),
        F.when(F.col("id") % 7 > 0, F.rand(3) * F.col("id")).alias("amount"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("name"),
        F.lit(None).cast("double").alias("nothing"),
        (F.col("id") / 10_000).cast("int").alias("part"),
    ).cache()
    path = str(tmp_path / "states")
    for part in (0, 1, 2, 3, 4, 5, 2):  # the third batch is sent twice
        profile_state.add_batch(df.filter(F.col("part") == part), part, path)
    assert spark.read.parquet(path).count() == 6 * 5
    got = {r["column"]: r for r in profile_state.profile_so_far(spark, path).collect()}
    for c in ("key", "amount", "name", "nothing"):
        n, nulls, distinct = df.agg(F.count("*"), F.count_if(F.col(c).isNull()), F.countDistinct(c)).first()
        assert (got[c]["n_rows"], got[c]["n_null"], got[c]["n_batches"]) == (n, nulls, 6)
        assert abs(got[c]["n_distinct"] - distinct) <= profile_state.DISTINCT_ERROR * max(distinct, 1)
    for c in ("key", "amount"):
        values = np.sort(df.filter(F.col(c).isNotNull()).select(F.col(c).cast("double")).toPandas()[c].to_numpy())
        assert (got[c]["min"], got[c]["max"]) == (values[0], values[-1]) and abs(got[c]["mean"] / values.mean() - 1) < 1e-12
        for p in profile.PROBS:
            found = got[c][f"q{int(p * 100):02d}"]
            low, high = np.searchsorted(values, [found, np.nextafter(found, np.inf)]) / len(values)
            assert low - profile_state.RANK_ERROR <= p <= high + profile_state.RANK_ERROR
    assert got["nothing"]["q50"] is None and got["name"]["q50"] is None
    assert profile_state.batch_state(df.limit(0), 9).count() == 0
    df.unpersist()
