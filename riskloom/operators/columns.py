"""Projections, renames, fills and the feature/target split."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.constants import MISSING, RENAMES, ROW_ID, TARGET, WAREHOUSE_NAMES
from riskloom.functions.scalars import natural_log, quoted


def canonical_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(RENAMES)


def warehouse_projection(df: DataFrame) -> DataFrame:
    """The columns the warehouse table holds, under its names."""
    return df.select(*[F.col(c).alias(name) for c, name in WAREHOUSE_NAMES.items()])


def fill_missing(
    df: DataFrame,
    columns: tuple[str, ...] = ("saving_accounts", "checking_account"),
    value: str = MISSING,
) -> DataFrame:
    return df.fillna({c: value for c in columns if c in df.columns})


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def log_column(df: DataFrame, name: str = "credit_amount") -> DataFrame:
    """Replace a column by its natural logarithm."""
    return df.withColumn(name, natural_log(quoted(name)))


def log_rejects(df: DataFrame, name: str = "credit_amount") -> DataFrame:
    """How many rows have no logarithm because the value is not positive."""
    value = quoted(name)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(value <= 0).alias("n_not_positive"),
        F.count_if(value.isNull()).alias("n_null"),
    )


def attach(df: DataFrame, derived: DataFrame, on: str = ROW_ID) -> DataFrame:
    """Join features computed elsewhere to their rows.

    Columns derived from the same row never need this: ``withColumns`` keeps them
    in the scan's projection.
    """
    return df.join(derived, on, "inner")


def feature_names(df: DataFrame, target: str = TARGET, exclude: tuple[str, ...] = ()) -> list[str]:
    hidden = {ROW_ID, target, "label", "split", "fold", *exclude}
    return [c for c in numeric_columns(df) if c not in hidden]


def design(
    df: DataFrame, features: list[str], target: str = TARGET, keep: tuple[str, ...] = (), invalid: str = "skip"
) -> DataFrame:
    """``row id, kept columns, label, features vector``; rows with a NULL feature are skipped,
    or have NaN for it if ``invalid`` is ``keep``."""
    labelled = df.select(
        ROW_ID,
        *keep,
        quoted(target).cast("double").alias("label"),
        *[quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
    )
    assembler = VectorAssembler(
        inputCols=[f"x{i}" for i in range(len(features))], outputCol="features", handleInvalid=invalid
    )
    return assembler.transform(labelled).select(ROW_ID, *keep, "label", "features")


def skipped_rows(df: DataFrame, features: list[str]) -> DataFrame:
    """How many rows ``design`` leaves out."""
    gap = F.lit(False)
    for c in features:
        gap = gap | quoted(c).isNull()
    return df.agg(F.count("*").alias("n_rows"), F.count_if(gap).alias("n_skipped"))
