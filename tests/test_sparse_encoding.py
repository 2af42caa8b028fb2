"""Encoding through a level table equals the dense form, for any number of levels."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import encode


def test_sparse_places_are_the_dense_columns(spark):
    rows = [(i, None if i % 5 == 0 else f"v{i % 7}", "same" if i % 3 else None, f"é{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "application_id long, a string, b string, c string").repartition(4)
    dense, names = encode.one_hot_encoder(df)
    want = {r["application_id"]: [i for i, n in enumerate(names) if r[n]] for r in dense.collect()}
    got = {r["application_id"]: r for r in encode.sparse_encode(df, ["a", "b", "c"]).collect()}
    assert {k: r["ones"] for k, r in got.items()} == want
    assert {r["size"] for r in got.values()} == {len(names)}


def test_a_hundred_thousand_levels(spark):
    df = spark.range(150_000).select(F.col("id").alias("application_id"), F.format_string("%06d", F.pmod("id", F.lit(100_000))).alias("name"))
    with pytest.raises(ValueError):
        encode.fit_levels(df, ["name"])
    levels = encode.level_table(df, ["name"])
    assert levels.filter(F.col("position") != F.col("level").cast("int")).count() == 0 and levels.count() == 100_000
    encoded = encode.sparse_encode(df, ["name"])
    wrong = encoded.filter((F.col("size") != 99_999) | ~F.col("ones").eqNullSafe(
        F.when(F.pmod("application_id", F.lit(100_000)) == 0, F.array().cast("array<int>")).otherwise(F.array((F.pmod("application_id", F.lit(100_000)) - 1).cast("int")))
    ))
    assert encoded.count() == 150_000 and wrong.count() == 0


def test_unseen_levels_have_no_place(spark):
    known = encode.level_table(spark.createDataFrame([("x",), ("y",), (None,)], "a string"), ["a"])
    df = spark.createDataFrame([(1, "y"), (2, "z"), (3, None), (4, "x")], "application_id long, a string")
    got = {r["application_id"]: (r["size"], r["ones"]) for r in encode.sparse_encode(df, ["a"], known).collect()}
    assert got == {1: (1, [0]), 2: (1, []), 3: (1, []), 4: (1, [])}
    assert encode.sparse_encode(df.limit(0), ["a"]).count() == 0
