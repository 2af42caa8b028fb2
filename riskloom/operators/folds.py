"""Train/test split and k-fold assignment as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import KFOLDS, ROW_ID, SPLIT_SEED, STRATIFIED_FOLDS, TEST_SHARE
from riskloom.functions.order_stats import order_statistics
from riskloom.functions.scalars import in_test_part, quoted


def with_split(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``split`` = train / test by a hash of the row id: no shuffle, same on every run."""
    test = in_test_part(F.col(ROW_ID), test_share, seed)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def train_test_split(
    df: DataFrame, test_share: float = TEST_SHARE, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    test = in_test_part(F.col(ROW_ID), test_share, seed)
    return df.filter(~test), df.filter(test)


def _fold_starts(n: int, k: int) -> list[int]:
    """Rank of the first row of folds 1..k-1; the first ``n mod k`` folds get one extra row."""
    size, extra = divmod(n, k)
    return [i * size + min(i, extra) for i in range(1, k)]


def _fold_of(row_id: Column, first_ids: list) -> Column:
    chain = F.lit(len(first_ids))
    for fold in range(len(first_ids) - 1, -1, -1):
        first = first_ids[fold]
        below = F.lit(True) if first is None else row_id < F.lit(first)
        chain = F.when(below, F.lit(fold)).otherwise(chain)
    return chain.cast("int")


def with_kfold(df: DataFrame, k: int = KFOLDS, row_id: str = ROW_ID, limit: int = 1_000_000) -> DataFrame:
    """Add ``fold``: contiguous, unshuffled folds in row-id order.

    Only the k-1 ids at which folds start are computed, by exact selection over the
    id column. Rows then get their fold by comparing their id with those literals, so
    the table itself is neither sorted nor shuffled.
    """
    found = order_statistics(df.select(row_id), row_id, lambda n: _fold_starts(n, k), limit=limit)
    n, by_rank = found.get((), (0, {}))
    firsts = [by_rank.get(rank) for rank in _fold_starts(n, k)]
    return df.withColumn("fold", _fold_of(quoted(row_id), firsts))


def with_stratified_kfold(
    df: DataFrame,
    label: str = "label",
    k: int = STRATIFIED_FOLDS,
    row_id: str = ROW_ID,
    limit: int = 1_000_000,
) -> DataFrame:
    """Add ``fold``: contiguous folds within each class, so every fold has the class mix."""
    found = order_statistics(
        df.select(label, row_id), row_id, lambda n: _fold_starts(n, k), by=(label,), limit=limit
    )
    chain = F.when(F.lit(False), F.lit(0))
    for (value,), (n, by_rank) in found.items():
        firsts = [by_rank.get(rank) for rank in _fold_starts(n, k)]
        chain = chain.when(quoted(label).eqNullSafe(F.lit(value)), _fold_of(quoted(row_id), firsts))
    return df.withColumn("fold", chain)


def fold_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("fold").agg(F.count("*").alias("n_rows"))
