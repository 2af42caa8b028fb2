"""Warehouse tables: definition and bulk load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.constants import WAREHOUSE_TABLES
from riskloom.operators.columns import warehouse_projection


def table_ddl(schema: str, name: str, location: str | None = None) -> str:
    columns = ", ".join(f"`{c}` {kind}" for c, kind in WAREHOUSE_TABLES[name])
    place = f" LOCATION '{location}/{name}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({columns}) USING parquet{place}"


def create_tables(spark: SparkSession, schema: str = "credit_card_schema", location: str | None = None) -> None:
    """Create the schema and its tables where they do not exist yet."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")
    for name in WAREHOUSE_TABLES:
        spark.sql(table_ddl(schema, name, location))


def load_table(df: DataFrame, table: str) -> None:
    """Append applicants to a catalog table, columns matched by name."""
    projected = warehouse_projection(df)
    projected.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def jdbc_options(url: str, table: str, writers: int = 16, batch_rows: int = 10_000) -> dict[str, str]:
    """Connections are limited by ``writers``, round trips by ``batch_rows``."""
    return {
        "url": url,
        "dbtable": table,
        "numPartitions": str(writers),
        "batchsize": str(batch_rows),
        "isolationLevel": "READ_COMMITTED",
    }


def load_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, **limits: int) -> None:
    """Append applicants to a database table in parallel batches."""
    options = {**jdbc_options(url, table, **limits), **(properties or {})}
    warehouse_projection(df).write.format("jdbc").options(**options).mode("append").save()
