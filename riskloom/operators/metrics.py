"""Classification scores as aggregates over (label, prediction)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.running import range_buckets
from riskloom.functions.scalars import safe_ratio
from riskloom.session import pin


def confusion_matrix(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts for every label x prediction pair, absent pairs included as 0."""
    counts = df.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))
    return _complete(counts, by)


def _complete(counts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Fill the label grid from the collected class set of each group."""
    per_group = counts.groupBy(*by).agg(
        F.array_union(F.collect_set("label"), F.collect_set("prediction")).alias("classes"),
        F.map_from_entries(
            F.collect_list(F.struct(F.struct("label", "prediction"), "n"))
        ).alias("cells"),
    )
    labels = per_group.select(*by, "classes", "cells", F.explode("classes").alias("label"))
    grid = labels.select(*by, "cells", "label", F.explode("classes").alias("prediction"))
    cell = F.try_element_at("cells", F.struct("label", "prediction"))
    return grid.select(*by, "label", "prediction", F.coalesce(cell, F.lit(0)).cast("bigint").alias("n"))


def _cells(positive: float) -> dict[str, Column]:
    is_true, is_hit = F.col("label") == positive, F.col("prediction") == positive
    return {
        "tp": F.count_if(is_true & is_hit),
        "fp": F.count_if(~is_true & is_hit),
        "fn": F.count_if(is_true & ~is_hit),
        "right": F.count_if(F.col("label") == F.col("prediction")),
        "n": F.count("*"),
    }


def accuracy_of() -> Column:
    return safe_ratio(_cells(1.0)["right"], F.count("*"))


def recall_of(positive: float = 1.0) -> Column:
    c = _cells(positive)
    return safe_ratio(c["tp"], c["tp"] + c["fn"])


def precision_of(positive: float = 1.0) -> Column:
    c = _cells(positive)
    return safe_ratio(c["tp"], c["tp"] + c["fp"])


def fbeta_of(beta: float = 2.0, positive: float = 1.0) -> Column:
    """(1+b2)PR / (b2 P + R), written on counts so that 0/0 becomes 0."""
    c, b2 = _cells(positive), beta * beta
    return safe_ratio((1 + b2) * c["tp"], (1 + b2) * c["tp"] + b2 * c["fn"] + c["fp"])


METRICS = {"accuracy": accuracy_of, "recall": recall_of, "precision": precision_of, "fbeta2": fbeta_of}


def score(df: DataFrame, *metrics: str, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per group with the named metrics, from a single aggregate."""
    return df.groupBy(*by).agg(*[METRICS[m]().alias(m) for m in metrics])


def classification_report(df: DataFrame) -> DataFrame:
    """Per-class precision, recall, f1 and support, then accuracy and both averages."""
    cells = confusion_matrix(df)
    per_class = (
        cells.select(F.col("label").alias("class"), F.col("n").alias("support"), "label", "prediction", "n")
        .groupBy("class")
        .agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
        .join(cells.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("picked")), "class")
        .select(
            F.col("class").cast("int").cast("string").alias("row"),
            safe_ratio(F.col("tp"), F.col("picked")).alias("precision"),
            safe_ratio(F.col("tp"), F.col("support")).alias("recall"),
            safe_ratio(2 * F.col("tp"), F.col("picked") + F.col("support")).alias("f1"),
            "support",
            "tp",
        )
    )
    scores = ["precision", "recall", "f1"]
    total = F.sum("support")
    right = F.sum("tp") / total
    accuracy = per_class.agg(
        F.lit("accuracy").alias("row"), *[right.alias(s) for s in scores], total.alias("support")
    )
    macro = per_class.agg(
        F.lit("macro avg").alias("row"), *[F.avg(s).alias(s) for s in scores], total.alias("support")
    )
    weighted = per_class.agg(
        F.lit("weighted avg").alias("row"),
        *[(F.sum(F.col(s) * F.col("support")) / total).alias(s) for s in scores],
        total.alias("support"),
    )
    return per_class.drop("tp").unionByName(accuracy).unionByName(macro).unionByName(weighted)


def roc_curve(
    df: DataFrame,
    score_col: str = "score",
    positive: float = 1.0,
    drop_intermediate: bool = True,
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """(fpr, tpr, threshold) with one point per distinct score, from (0, 0) to (1, 1).

    Rows are first counted per score. Running counts are then made in two levels:
    inside ranges of scores, plus the totals of the ranges above, so no window ever
    spans the table. With ``drop_intermediate`` points on a straight line between
    their neighbours are left out: a point goes when the next score adds exactly the
    same counts as it does.
    """
    hit = (F.col("label") == positive).cast("bigint")
    per_score = (
        df.filter(F.col(score_col).isNotNull())
        .groupBy(F.col(score_col).alias("threshold"))
        .agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    )
    sliced = range_buckets(pin(per_score, "roc"), "threshold", rows_per_bucket)
    above = W.partitionBy(F.lit(0)).orderBy(F.desc("bucket"))
    before = above.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(0))
    ranges = (
        sliced.groupBy("bucket")
        .agg(
            F.sum("pos").alias("p"),
            F.sum("neg").alias("q"),
            F.max_by(F.struct("pos", "neg"), "threshold").alias("head"),
        )
        .select(
            "bucket",
            F.coalesce(F.sum("p").over(before), F.lit(0)).alias("from_pos"),
            F.coalesce(F.sum("q").over(before), F.lit(0)).alias("from_neg"),
            F.sum("p").over(whole).alias("all_pos"),
            F.sum("q").over(whole).alias("all_neg"),
            F.lead("head").over(above).alias("after"),
        )
    )
    down = W.partitionBy("bucket").orderBy(F.desc("threshold"))
    upto = down.rowsBetween(W.unboundedPreceding, W.currentRow)
    points = (
        sliced.select(
            "bucket",
            "threshold",
            F.struct("pos", "neg").alias("step"),
            F.sum("pos").over(upto).alias("in_pos"),
            F.sum("neg").over(upto).alias("in_neg"),
            F.lead(F.struct("pos", "neg")).over(down).alias("next_in"),
            F.lag("threshold").over(down).isNull().alias("heads_bucket"),
        )
        .join(F.broadcast(ranges), "bucket")
        .select(
            "threshold",
            "step",
            F.coalesce("next_in", "after").alias("next"),
            (F.col("heads_bucket") & (F.col("from_pos") + F.col("from_neg") == 0)).alias("first"),
            safe_ratio(F.col("in_neg") + F.col("from_neg"), F.col("all_neg")).alias("fpr"),
            safe_ratio(F.col("in_pos") + F.col("from_pos"), F.col("all_pos")).alias("tpr"),
        )
    )
    start = points.filter("first").select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), (F.col("threshold") + 1).alias("threshold")
    )
    if drop_intermediate:
        points = points.filter(
            F.col("first") | F.col("next").isNull() | ~(F.col("step") == F.col("next"))
        )
    return points.select("fpr", "tpr", "threshold").unionByName(start)
