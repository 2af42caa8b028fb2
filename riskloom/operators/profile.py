"""Data-quality profile of any table, as tidy tables with one row per finding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.order_stats import column_quantiles
from riskloom.functions.running import running_totals
from riskloom.functions.scalars import quoted
from riskloom.operators import gram
from riskloom.operators.columns import numeric_columns, string_columns
from riskloom.session import pin

PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


def tall(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """(column, value): one row per cell, without a shuffle."""
    cells = [F.struct(F.lit(c).alias("column"), quoted(c).cast(kind).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.column", "c.value")


def numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return tall(df, columns or numeric_columns(df), "double")


def kind_of(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "numeric" if isinstance(kind, T.NumericType) else "categorical"


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and repeated rows.

    Equal rows meet after a partial count in every task, so a row repeated a billion
    times is one record per task in the shuffle.
    """
    gaps = reduce(lambda a, b: a + b, [quoted(c).isNull().cast("bigint") for c in df.columns])
    width = len(df.columns)
    distinct = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    rows = F.sum("_n")
    return distinct.withColumn("_gaps", gaps).agg(
        F.coalesce(rows, F.lit(0)).alias("n_rows"),
        F.lit(width).cast("bigint").alias("n_columns"),
        F.coalesce(F.sum(F.col("_gaps") * F.col("_n")), F.lit(0)).alias("n_missing_cells"),
        (F.sum(F.col("_gaps") * F.col("_n")) / (rows * width)).alias("missing_share"),
        (F.coalesce(rows, F.lit(0)) - F.count("*")).alias("n_duplicate_rows"),
    )


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, value, n) with values as text; NULL is a value here."""
    return tall(df, columns or df.columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))


def column_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Kind, nulls and distinct values of every column.

    Exact distinct counts shuffle each column's distinct values; ``approximate``
    keeps one bounded sketch per column instead.
    """
    if approximate:
        cells = tall(df, df.columns, "string").groupBy("column")
        counted = cells.agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("value").isNull()).alias("n_null"),
            F.approx_count_distinct("value").alias("n_distinct"),
        )
    else:
        is_gap = F.col("value").isNull()
        counted = (
            value_counts(df)
            .groupBy("column")
            .agg(
                F.sum("n").alias("n_rows"),
                F.coalesce(F.sum(F.when(is_gap, F.col("n"))), F.lit(0)).alias("n_null"),
                F.count("value").alias("n_distinct"),
            )
        )
    kinds = F.create_map(*[F.lit(v) for f in df.schema for v in (f.name, kind_of(f.dataType))])
    filled = F.col("n_rows") - F.col("n_null")
    kind = (
        F.when(F.col("n_distinct") <= 1, "constant")
        .when((F.col("n_distinct") == F.col("n_rows")), "unique")
        .otherwise(F.element_at(kinds, F.col("column")))
    )
    return counted.select(
        "column",
        kind.alias("kind"),
        "n_rows",
        "n_null",
        (F.col("n_null") / F.col("n_rows")).alias("null_share"),
        "n_distinct",
        (F.col("n_distinct") / F.nullif(filled, F.lit(0))).alias("distinct_share"),
    )


def numeric_stats(df: DataFrame, columns: list[str] | None = None, limit: int = 1_000_000) -> DataFrame:
    """Location and spread of numeric columns, with the median absolute deviation."""
    columns = columns or numeric_columns(df)
    cells = numbers(df, columns)
    medians = {c: q[0] for c, q in column_quantiles(df, {c: quoted(c) for c in columns}, [0.5], limit).items()}
    away = {c: F.abs(quoted(c) - F.lit(m)) for c, m in medians.items()}
    mad = F.when(F.lit(False), F.lit(0.0))
    for c, q in column_quantiles(df, away, [0.5], limit).items():
        mad = mad.when(F.col("column") == c, F.lit(q[0]))
    value = F.col("value")
    return (
        cells.groupBy("column")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.var_samp("value").alias("variance"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            (F.max("value") - F.min("value")).alias("range"),
            F.sum("value").alias("sum"),
            (F.stddev_samp("value") / F.nullif(F.avg("value"), F.lit(0.0))).alias("cv"),
            F.count_if(value == 0).alias("n_zero"),
            F.count_if(value < 0).alias("n_negative"),
        )
        .withColumn("mad", mad)
    )


def quantile_table(df: DataFrame, columns: list[str] | None = None, limit: int = 1_000_000) -> DataFrame:
    """Exact 5/25/50/75/95 % quantiles and the interquartile range."""
    found = column_quantiles(df, {c: quoted(c) for c in columns or numeric_columns(df)}, PROBS, limit)
    rows = [(c, *q, q[3] - q[1]) for c, q in sorted(found.items())]
    return df.sparkSession.createDataFrame(
        rows, "column string, q05 double, q25 double, q50 double, q75 double, q95 double, iqr double"
    )


def moments_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Sample-adjusted skewness and excess kurtosis. Spark's own are population forms."""
    n = F.col("n").cast("double")
    return (
        numbers(df, columns)
        .groupBy("column")
        .agg(F.count("value").alias("n"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2"))
        .select(
            "column",
            F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
            F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)).alias("kurtosis"),
        )
    )


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width counts; the maximum belongs to the last bin, empty bins are absent."""
    columns = columns or numeric_columns(df)
    ends = df.agg(
        *[F.min(quoted(c)).cast("double").alias(f"l{i}") for i, c in enumerate(columns)],
        *[F.max(quoted(c)).cast("double").alias(f"h{i}") for i, c in enumerate(columns)],
    ).first()
    low, width = F.when(F.lit(False), F.lit(0.0)), F.when(F.lit(False), F.lit(0.0))
    for i, c in enumerate(columns):
        if ends[f"l{i}"] is not None:
            low = low.when(F.col("column") == c, F.lit(ends[f"l{i}"]))
            width = width.when(F.col("column") == c, F.lit(ends[f"h{i}"] - ends[f"l{i}"]))
    spot = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("value") - low) / F.nullif(width, F.lit(0.0)) * bins) + 1, F.lit(bins))
    )
    return (
        numbers(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("column", spot.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """The k most frequent texts of each column; ties by value."""
    counts = value_counts(df, columns or string_columns(df)).filter(F.col("value").isNotNull())
    order = W.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def extreme_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """The k smallest and k largest distinct numbers of each column, with their counts."""
    counts = (
        numbers(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    ends = []
    for side, key in (("min", F.asc("value")), ("max", F.desc("value"))):
        rank = F.row_number().over(W.partitionBy("column").orderBy(key))
        ends.append(counts.withColumn("rank", rank).filter(F.col("rank") <= k).withColumn("side", F.lit(side)))
    return ends[0].unionByName(ends[1])


def text_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Length of the texts of each string column."""
    columns = columns or string_columns(df)
    lengths = tall(df, columns, "string").select("column", F.length("value").alias("value"))
    middle = F.when(F.lit(False), F.lit(0.0))
    for c, q in column_quantiles(df, {c: F.length(quoted(c)) for c in columns}, [0.5]).items():
        middle = middle.when(F.col("column") == c, F.lit(q[0]))
    return (
        lengths.groupBy("column")
        .agg(
            F.min("value").alias("min_length"),
            F.max("value").alias("max_length"),
            F.avg("value").alias("mean_length"),
        )
        .withColumn("median_length", middle)
    )


def pearson(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return gram.pearson(df, columns or numeric_columns(df))


def average_ranks(df: DataFrame, columns: list[str], rows_per_bucket: int = 1_000_000) -> DataFrame:
    """(column, value, rank): the average place of every distinct value of each column.

    Equal values share the mean of their places. Values are counted first; places are
    running counts, per column in one window while its distinct values fit a bucket,
    in two levels beyond.
    """
    counts = numbers(df, columns).filter(F.col("value").isNotNull()).groupBy("column", "value")
    counts = pin(counts.agg(F.count("*").alias("n")), "counts")
    sizes = {r["column"]: r["size"] for r in counts.groupBy("column").agg(F.count("*").alias("size")).collect()}
    big = [c for c, size in sizes.items() if size > rows_per_bucket]
    running = W.partitionBy("column").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = [counts.filter(~F.col("column").isin(big)).withColumn("upto_n", F.sum("n").over(running))]
    for c in big:
        parts.append(running_totals(counts.filter(F.col("column") == c), "value", ["n"], rows_per_bucket=rows_per_bucket))
    every = reduce(DataFrame.unionByName, parts)
    return every.select("column", "value", (F.col("upto_n") - (F.col("n") - 1) / 2).alias("rank"))


def spearman(df: DataFrame, columns: list[str] | None = None, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Pearson correlation of average ranks, joined back to the rows by value.

    The join side is left to Catalyst: few distinct values are broadcast by their
    measured size, many are shuffled, with adaptive execution splitting a hot value.
    """
    columns = columns or numeric_columns(df)
    ranked = pin(df.select(*[quoted(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)]), "values")
    named = {f"_v{i}": c for i, c in enumerate(columns)}
    ranks = pin(average_ranks(ranked, list(named), rows_per_bucket), "ranks")
    for i, v in enumerate(named):
        own = ranks.filter(F.col("column") == v).select(F.col("value").alias("_k"), F.col("rank").alias(f"_rank{i}"))
        ranked = ranked.join(own, F.col(v) == F.col("_k"), "left").drop("_k")
    renamed = ranked.select(*[F.col(f"_rank{i}").alias(c) for i, c in enumerate(columns)])
    return gram.pearson(renamed, columns, "spearman")


def cramers_v(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Association of categorical pairs, plain and corrected for bias.

    Distinct rows are counted first; their cells, a pair of levels each with the row's
    count, make all contingency tables in one aggregate. The plan holds each column once.
    """
    columns = columns or string_columns(df)
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "left_column string, right_column string, cramers_v double, cramers_v_corrected double")
    levels = F.array(*[quoted(c).cast("string") for c in columns]).alias("levels")
    rows = df.select(levels).groupBy("levels").agg(F.count("*").alias("rows"))
    name, last = F.array(*[F.lit(c) for c in columns]), len(columns) - 1

    def pair(i: Column, j: Column) -> Column:
        return F.struct(
            F.get(name, i).alias("left_column"), F.get(name, j).alias("right_column"), F.get("levels", i).alias("a"), F.get("levels", j).alias("b")
        )

    pairs = F.flatten(
        F.transform(F.sequence(F.lit(0), F.lit(last - 1)), lambda i: F.transform(F.sequence(i + 1, F.lit(last)), lambda j: pair(i, j)))
    )
    counts = (
        rows.select("rows", F.inline(pairs))
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("left_column", "right_column", "a", "b")
        .agg(F.sum("rows").alias("n"))
    )
    pair = ["left_column", "right_column"]
    # Margins are aggregated and joined back, so a frequent level is never one window.
    table = pin(counts, "contingency")
    in_a = table.groupBy(*pair, "a").agg(F.sum("n").alias("in_a"))
    in_b = table.groupBy(*pair, "b").agg(F.sum("n").alias("in_b"))
    shares = table.join(in_a, [*pair, "a"]).join(in_b, [*pair, "b"])
    parts = shares.groupBy(*pair).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n") / (F.col("in_a").cast("double") * F.col("in_b"))).alias("s"),
        # A level's cells sum to its margin, so these shares count the levels.
        F.round(F.sum(F.col("n") / F.col("in_a"))).cast("bigint").alias("r"),
        F.round(F.sum(F.col("n") / F.col("in_b"))).cast("bigint").alias("k"),
    )
    phi2, n, r, k = F.col("s") - 1, F.col("n"), F.col("r"), F.col("k")
    phi2_corrected = F.greatest(phi2 - (k - 1) * (r - 1) / (n - 1), F.lit(0.0))
    smaller = F.least(r - (r - 1) * (r - 1) / (n - 1), k - (k - 1) * (k - 1) / (n - 1)) - 1
    usable = (F.least(r, k) > 1) & (n > 1)
    return parts.select(
        *pair,
        F.when(usable, F.sqrt(F.greatest(phi2, F.lit(0.0)) / (F.least(r, k) - 1))).alias("cramers_v"),
        F.when(usable & (smaller > 0), F.sqrt(phi2_corrected / F.nullif(smaller, F.lit(0.0)))).alias("cramers_v_corrected"),
    )


def nullity_correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Do gaps occur together? Correlation of the is-missing flags; NULL when one never varies."""
    return gram.nullity(df, columns or df.columns)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every row that occurs more than once, with its count."""
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def alerts(
    df: DataFrame,
    missing: float = 0.05,
    zeros: float = 0.10,
    skew: float = 1.0,
    cardinality: int = 50,
    correlation: float = 0.5,
    imbalance: float = 0.6,
) -> DataFrame:
    """(column, alert, value): findings worth a look, by rules over the profile tables."""
    summary = column_summary(df)
    numeric, text = numeric_columns(df), string_columns(df)

    def rule(source: DataFrame, condition: Column, name: str, value: Column) -> DataFrame:
        return source.filter(condition).select("column", F.lit(name).alias("alert"), value.cast("double").alias("value"))

    found = [
        rule(summary, F.col("kind") == "constant", "constant", F.col("n_distinct")),
        rule(summary, F.col("kind") == "unique", "unique", F.col("n_distinct")),
        rule(summary, F.col("null_share") > missing, "missing", F.col("null_share")),
        rule(
            summary,
            F.col("column").isin(text) & (F.col("n_distinct") > cardinality),
            "high_cardinality",
            F.col("n_distinct"),
        ),
    ]
    if numeric:
        zero_share = (
            numbers(df, numeric)
            .groupBy("column")
            .agg((F.count_if(F.col("value") == 0) / F.count("*")).alias("share"))
        )
        found.append(rule(zero_share, F.col("share") > zeros, "zeros", F.col("share")))
        found.append(rule(moments_table(df, numeric), F.abs("skewness") > skew, "skewed", F.col("skewness")))
    if len(numeric) > 1:
        strong = pearson(df, numeric).filter(F.abs("pearson") > correlation)
        named = strong.select(
            F.concat_ws("~", "left_column", "right_column").alias("column"), F.col("pearson").alias("r")
        )
        found.append(rule(named, F.lit(True), "correlated", F.col("r")))
    if text:
        largest = (
            value_counts(df, text)
            .filter(F.col("value").isNotNull())
            .groupBy("column")
            .agg((F.max("n") / F.sum("n")).alias("share"))
        )
        found.append(rule(largest, F.col("share") > imbalance, "imbalanced", F.col("share")))
    return reduce(DataFrame.unionByName, found)


def head_tail(df: DataFrame, row_id: str, n: int = 10) -> DataFrame:
    """The first and last n rows in row-id order."""
    head = df.orderBy(F.asc(row_id)).limit(n).withColumn("part", F.lit("head"))
    tail = df.orderBy(F.desc(row_id)).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def profile(df: DataFrame, row_id: str | None = None) -> dict[str, DataFrame]:
    """All profile tables of a dataset by name."""
    tables = {
        "overview": overview(df),
        "columns": column_summary(df),
        "nullity": nullity_correlation(df),
        "duplicates": duplicate_rows(df),
        "alerts": alerts(df),
    }
    if numeric_columns(df):
        tables.update(
            numeric=numeric_stats(df),
            quantiles=quantile_table(df),
            moments=moments_table(df),
            histogram=histogram(df),
            extremes=extreme_values(df),
        )
    if len(numeric_columns(df)) > 1:
        tables.update(pearson=pearson(df), spearman=spearman(df))
    if string_columns(df):
        tables.update(top_values=top_values(df), text=text_stats(df))
    if len(string_columns(df)) > 1:
        tables["cramers_v"] = cramers_v(df)
    if row_id:
        tables["head_tail"] = head_tail(df, row_id)
    return tables
