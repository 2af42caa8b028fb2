"""Column expressions shared by the operators. All are built-in, none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.constants import SPLIT_SEED, TEST_SHARE, TIME_ZONE


def quoted(name: str) -> Column:
    """A column whose name may hold dots, blanks or slashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def natural_log(value: Column) -> Column:
    """ln for positive values, NULL for the rest (which callers count as rejects)."""
    return F.when(value > 0, F.ln(value))


def hash_bucket(row_id: Column, seed: int = SPLIT_SEED, buckets: int = 10_000) -> Column:
    """A bucket that depends on the row id and the seed only, not on partitioning."""
    digest = F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def in_test_part(row_id: Column, test_share: float = TEST_SHARE, seed: int = SPLIT_SEED) -> Column:
    return hash_bucket(row_id, seed) < round(test_share * 10_000)


def local_time(utc: Column, zone: str = TIME_ZONE) -> Column:
    return F.from_utc_timestamp(utc, zone)


def batch_number(moment: Column) -> Column:
    """yyyymmdd as a number."""
    return F.date_format(moment, "yyyyMMdd").cast("bigint")


def file_date(path: Column) -> Column:
    """The date in a ``name_ddmmyyyy.ext`` file name; NULL when there is none."""
    stamp = F.regexp_extract(path, r"_(\d{8})\.[A-Za-z0-9]+$", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("ddMMyyyy")))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """0 where the denominator is 0, as the classification scores define it."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)
