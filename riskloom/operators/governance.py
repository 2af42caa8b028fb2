"""Lineage, data dictionary and the summary tables that answer repeated questions."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.constants import LINEAGE_SCHEMA
from riskloom.functions.scalars import quoted
from riskloom.operators.profile import column_summary, kind_of

RUN_SCHEMA = T.StructType(
    [
        *LINEAGE_SCHEMA,
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("schema_hash", T.LongType()),
    ]
)


def lineage_record(
    spark: SparkSession,
    step: str,
    source: str,
    destination: str,
    moment: datetime,
    rows_in: int | None = None,
    rows_out: int | None = None,
    schema_hash: int | None = None,
) -> DataFrame:
    """One lineage row. The clock is an argument; the batch number is its day."""
    row = (int(moment.strftime("%Y%m%d")), moment, step, source, destination, rows_in, rows_out, schema_hash)
    return spark.createDataFrame([row], RUN_SCHEMA)


def append_lineage(record: DataFrame, path: str) -> None:
    record.coalesce(1).write.mode("append").parquet(path)


def schema_hash(df: DataFrame) -> int:
    """A number that changes when a column is added, dropped, renamed or retyped."""
    text = df.schema.simpleString()
    value = 0
    for byte in text.encode():
        value = (value * 31 + byte) % 2**61
    return value


def batch_of(spark: SparkSession, path: str, schema: T.StructType, batch: int) -> DataFrame:
    """One batch of a table partitioned by ``batch_nr``, without that column.

    The schema is given, so a table without any partition yet is simply empty.
    """
    columns = [f for f in schema if f.name != "batch_nr"]
    whole = T.StructType([*columns, T.StructField("batch_nr", T.LongType())])
    return spark.read.schema(whole).parquet(path).filter(F.col("batch_nr") == batch).drop("batch_nr")


def with_lineage(
    df: DataFrame, write, step: str, source: str, destination: str, log: str, moment: datetime, rows_in: int | None = None
) -> DataFrame:
    """Write ``df`` by batch through ``write(df, destination)``, record the phase, return the batch.

    Rows are counted at the destination, from the footers of the batch's files: the log
    says what is there, not what was sent.
    """
    spark, batch = df.sparkSession, int(moment.strftime("%Y%m%d"))
    write(df, destination)
    written = batch_of(spark, destination, df.schema, batch)
    append_lineage(
        lineage_record(spark, step, source, destination, moment, rows_in, written.count(), schema_hash(df)), log
    )
    return written


def phase_log(phases: dict[str, DataFrame], source: str) -> DataFrame:
    """(position, step, source, destination, rows_in, rows_out) of a chain of phases.

    Each phase is counted where it is computed; only one row per phase meets in the
    window that looks up the rows of the phase before.
    """
    names = list(phases)
    parts = [
        df.agg(F.count("*").alias("rows_out")).select(
            F.lit(i).alias("position"),
            F.lit(step).alias("step"),
            F.lit(names[i - 1] if i else source).alias("source"),
            F.lit(step).alias("destination"),
            "rows_out",
        )
        for i, (step, df) in enumerate(phases.items())
    ]
    chain = W.partitionBy(F.lit(0)).orderBy("position")
    return reduce(DataFrame.unionByName, parts).withColumn("rows_in", F.lag("rows_out").over(chain))


def data_dictionary(df: DataFrame, comments: dict[str, str] | None = None) -> DataFrame:
    """One row per column: type, kind, gaps, distinct values and meaning."""
    comments = comments or {}
    facts = [
        (f.name, i, f.dataType.simpleString(), kind_of(f.dataType), comments.get(f.name) or f.metadata.get("comment", ""))
        for i, f in enumerate(df.schema)
    ]
    described = df.sparkSession.createDataFrame(
        facts, "column string, position int, data_type string, base_kind string, comment string"
    )
    summary = column_summary(df).select("column", "kind", "n_rows", "n_null", "n_distinct")
    return described.join(summary, "column")


def results_summary(scored: DataFrame) -> DataFrame:
    """Class rates per batch and purpose: the table that dashboards read instead of the rows."""
    return scored.groupBy("batch_nr", "purpose").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("prediction") == 1).alias("n_bad"),
        F.avg((F.col("prediction") == 1).cast("double")).alias("bad_share"),
        F.sum("credit_amount").alias("credit_amount"),
    )


def publish(scored: DataFrame, path: str) -> None:
    """Write the classified rows partitioned by batch and sorted inside files.

    Rows are rebalanced by batch first: adaptive execution joins small batches and splits
    large ones by measured size, so a batch has few files however many tasks wrote it.
    Sorting by purpose within a task's partition narrows the min/max range of row
    groups, so filters on it skip most of a file.
    """
    (
        scored.hint("rebalance", "batch_nr").sortWithinPartitions("batch_nr", "purpose")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_nr")
        .parquet(path)
    )


CUTS = 255  # of each column that a place on the curve is made from: eight bits


def interleaved(df: DataFrame, columns: list[str], cuts: int = CUTS) -> Column:
    """A row's place on a Z-order curve through ``columns``: numbers that are near in all lie near.

    Each column's value becomes the count of its quantile cuts below it, so skewed columns
    use all bits, and the counts' bits are interleaved, the first column's highest first. NULL
    comes first. Cuts are approximate quantiles; any cuts give a valid layout.
    """
    bits = cuts.bit_length()
    found = df.approxQuantile(columns, [i / (cuts + 1) for i in range(1, cuts + 1)], 1 / (4 * (cuts + 1)))
    place = F.lit(0).cast("long")
    for i, (c, values) in enumerate(zip(columns, found, strict=True)):
        held = F.array(*[F.lit(v) for v in sorted(set(values))]).cast("array<double>")
        count = F.coalesce(F.size(F.filter(held, lambda v: v < quoted(c).cast("double"))), F.lit(0)).cast("long")  # noqa: B023
        for b in range(bits):
            spot = b * len(columns) + len(columns) - 1 - i
            place = place + F.shiftleft(F.shiftright(count, b).bitwiseAND(1), spot)
    return place


def publish_interleaved(df: DataFrame, path: str, columns: list[str], lookups: list[str] = (), row_group: int = 128 << 20) -> None:
    """Write ``df`` along a Z-order curve, with a Bloom filter for each column of ``lookups``.

    Row groups then cover small boxes in all of ``columns`` at once, so a filter on any of
    them, or on several, skips most groups by their footers' ranges; an equality on a lookup
    column skips the others by its filter. One range shuffle by the place on the curve.
    """
    placed = df.withColumn("_place", interleaved(df, columns))
    writer = placed.repartitionByRange("_place").sortWithinPartitions("_place").drop("_place").write.mode("overwrite")
    for c in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.option("parquet.block.size", row_group).parquet(path)


def refresh_summary(spark: SparkSession, results: str, summary: str, batches: list[int] | None = None) -> None:
    """Rebuild the summary of the changed batches only; other partitions stay as they are."""
    scored = spark.read.parquet(results)
    if batches is not None:
        scored = scored.filter(F.col("batch_nr").isin(batches))
    (
        results_summary(scored)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_nr")
        .parquet(summary)
    )
