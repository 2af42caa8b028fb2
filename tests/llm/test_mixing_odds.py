"""Documents are included by odds of their own; targets are met to the word."""

import random

from pyspark.sql import functions as F

from riskloom.llm import mixing


def test_inclusion_follows_unequal_odds(spark):
    rng = random.Random(5)
    rows = [(i, "a", " ".join(["w"] * rng.choice([3, 20, 100])) + f" {i}") for i in range(9_000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).withColumn("digits", F.length(F.bin("size")))
    sums = {r["digits"]: r for r in got.groupBy("digits").agg(F.sum("size").alias("words"), F.sum("taken").alias("taken"), F.avg(F.col("taken") / F.col("size")).alias("often")).collect()}
    assert abs(sum(r["taken"] for r in sums.values()) - got.first()["target"]) <= 1
    assert got.filter("taken > 2 * size").count() == 0
    assert sorted(sums) == [3, 5, 7]
    # The longest are full at two copies each; what is left is shared by the number of digits.
    rest = got.first()["target"] - 2 * sums[7]["words"]
    t = rest / (5 * sums[5]["words"] + 3 * sums[3]["words"])
    wanted = {7: 2.0, 5: min(2.0, 5 * t), 3: 3 * t} if 7 * got.first()["target"] / sum(d * r["words"] for d, r in sums.items()) >= 2 else {
        d: d * got.first()["target"] / sum(e * r["words"] for e, r in sums.items()) for d in sums
    }
    for digits, often in wanted.items():
        assert abs(sums[digits]["often"] - often) < 0.05, (digits, sums[digits]["often"], often)
    assert sums[3]["often"] < sums[5]["often"] <= sums[7]["often"]


def test_rows_without_ids_are_spread(spark):
    rows = [(None, "a", f"word{i} " * (1 + i % 4)) for i in range(3_000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    by_size = got.filter("size = 1").groupBy("taken").count().collect()
    assert len(by_size) == 2 and min(r["count"] for r in by_size) > 50
