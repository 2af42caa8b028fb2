"""Running totals over a whole table in two levels instead of one global window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.session import pin


def range_buckets(df: DataFrame, key: str, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Add ``bucket``: ordered ranges of ``key`` with about ``rows_per_bucket`` rows each.

    Cut points only balance the work, any cut points give the same totals. ``key``
    must not be skewed, that is, equal keys have been aggregated before.
    """
    n = df.count()
    wanted = -(-n // rows_per_bucket)
    if wanted <= 1:
        return df.withColumn("bucket", F.lit(0.0))
    cuts = df.approxQuantile(key, [i / wanted for i in range(1, wanted)], 1 / (8 * wanted))
    held = F.array(*[F.lit(c) for c in sorted(set(cuts))])
    # Comparisons put NaN last, as Spark's order does.
    place = F.col(key).cast("double")
    return df.withColumn("bucket", F.size(F.filter(held, lambda c: place >= c)).cast("double"))


def running_totals(
    df: DataFrame, key: str, sums: list[str], descending: bool = False, rows_per_bucket: int = 1_000_000
) -> DataFrame:
    """Add ``upto_<c>`` for each column: its total over rows up to and including ``key``.

    Level one sums each bucket, level two adds the totals of the buckets before it.
    The bucket table has one row per million input rows, which is what is broadcast.
    """
    sliced = range_buckets(pin(df, "running"), key, rows_per_bucket)
    order = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    earlier = W.partitionBy(F.lit(0)).orderBy(order("bucket")).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("bucket")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select("bucket", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"from_{c}") for c in sums])
    )
    inside = W.partitionBy("bucket").orderBy(order(key))
    inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = sliced.select("*", *[F.sum(c).over(inside).alias(f"in_{c}") for c in sums])
    return local.join(F.broadcast(offsets), "bucket").select(
        *df.columns, *[(F.col(f"in_{c}") + F.col(f"from_{c}")).alias(f"upto_{c}") for c in sums]
    )
