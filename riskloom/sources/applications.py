"""The applicants table, derived from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def applications(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """One row per order seen as a credit application; ``dated`` adds its day.

    The dimension tables are joined to each other first, smallest first, so the fact
    table takes part in a single equi-join. No side is forced to broadcast: customers
    grow with the data, so Catalyst decides by size and adaptive execution splits a hot
    customer.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    orders = table(spark, sf_dir, "orders")

    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    holder = customer.join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "r_name"
    )
    key = F.col("o_custkey")
    months = F.lit(6) * F.month("o_orderdate")
    bad = (F.col("o_totalprice") / months > 9000) | (
        (F.col("c_mktsegment") == "BUILDING") & (key % 57 < 12)
    )
    return orders.join(holder, key == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("application_id"),
        (F.lit(19) + key % 57).cast("int").alias("age"),
        F.when(key % 3 == 0, "female").otherwise("male").alias("sex"),
        (key % 4).cast("int").alias("job"),
        F.col("o_orderstatus").alias("housing"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("saving_accounts"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("checking_account"),
        F.col("o_totalprice").alias("credit_amount"),
        months.cast("int").alias("duration"),
        F.col("r_name").alias("purpose"),
        F.when(bad, "bad").otherwise("good").alias("risk"),
        *([F.to_date("o_orderdate").alias("applied_on")] if dated else []),
    )
