"""Incremental landing: a file-source stream that takes up only files it has not seen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.constants import APPLICATION_SCHEMA
from riskloom.functions.scalars import quoted
from riskloom.operators.columns import canonical_names
from riskloom.operators.conform import conform
from riskloom.operators.governance import lineage_record
from riskloom.plans.batch import Paths, classify, stored_state
from riskloom.session import pin
from riskloom.sources.files import read_csv, read_csv_text, with_batch


def new_files(
    spark: SparkSession, path: str, schema: T.StructType = APPLICATION_SCHEMA, fmt: str = "parquet", per_batch: int = 1_000
) -> DataFrame:
    """A stream over the files below ``path``; ``per_batch`` bounds one micro-batch."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", per_batch).load(path)


def land_stream(df: DataFrame, destination: str, checkpoint: str, partition_by: str | None = "batch_nr") -> None:
    """Append what is new to parquet and stop.

    Progress is in ``checkpoint`` and finished files in the sink's log, so a killed run
    that starts again neither loses nor repeats a file.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", destination)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.start().awaitTermination()


def land_new_csv(spark: SparkSession, source: str, destination: str, checkpoint: str, per_batch: int = 1_000) -> None:
    """The daily run: dated CSV files to parquet by day, each file once.

    The stream carries file names only; a micro-batch reads its files by their headers and
    writes partitions of its own number, so one that is repeated replaces itself.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", per_batch)
        .load(source)
        .select("path")
    )

    def land(batch: DataFrame, number: int) -> None:
        files = [r["path"] for r in batch.collect()]  # at most per_batch names
        if files:
            rows = with_batch(read_csv(spark, files)).withColumn("arrival", F.lit(number))
            (
                rows.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_nr", "arrival")
                .parquet(destination)
            )

    query = names.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()


KEY = "row_digest"


def seen_before(spark: SparkSession, path: str, number: int) -> DataFrame:
    """Digests of the rows that earlier micro-batches took up."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)  # an empty folder is an empty table
    return spark.read.schema(f"{KEY} string, arrival int").parquet(path).filter(F.col("arrival") < number).select(KEY)


def classify_files(spark: SparkSession, files: list[str], number: int, paths: Paths, moment: datetime) -> dict[str, int]:
    """Conform, classify and publish the rows of ``files`` as micro-batch ``number``.

    Every table is partitioned by the micro-batch's number and written per partition, so a
    micro-batch that is repeated replaces what it left. A row whose cells an earlier
    micro-batch, or this one, has already brought is left out: digests of rows are kept by
    micro-batch, and only those before ``number`` count as seen. They are written last, when
    all else is.
    """
    rows = canonical_names(read_csv_text(spark, files))
    cells = [F.coalesce(F.concat(F.octet_length(quoted(c)).cast("string"), F.lit(":"), quoted(c)), F.lit("-")) for c in rows.columns]
    keyed = rows.withColumn(KEY, F.sha2(F.concat(*cells), 256)).dropDuplicates([KEY])
    fresh = pin(keyed.join(seen_before(spark, paths.seen, number), KEY, "left_anti"), "fresh")
    counts: dict[str, int] = {}

    def keep(df: DataFrame, path: str) -> DataFrame:
        out = df.withColumn("arrival", F.lit(number))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("arrival").parquet(path)
        return spark.read.schema(out.schema).parquet(path).filter(F.col("arrival") == number)

    def phase(df: DataFrame, step: str, destination: str, rows_in: int) -> int:
        counts[step] = keep(df, destination).count()
        record = lineage_record(spark, step, paths.source, destination, moment, rows_in, counts[step])
        keep(record.withColumn("position", F.lit(len(counts))), f"{paths.lineage}/{step}")
        return counts[step]

    checked = conform(fresh.drop(KEY))
    taken = fresh.count()
    phase(checked.quarantine, "quarantine", paths.quarantine, taken)
    phase(checked.valid, "validation", paths.valid, taken)
    state = stored_state(spark, paths, checked.valid)
    phase(classify(checked.valid, state), "training", paths.results, counts["validation"])
    if taken != counts["validation"] + counts["quarantine"] or counts["training"] != counts["validation"]:
        raise RuntimeError(f"rows were lost: {counts}")
    keep(fresh.select(KEY), paths.seen)
    return counts


def classify_new_files(spark: SparkSession, paths: Paths, checkpoint: str, moment: datetime, per_batch: int = 1_000, after=None) -> None:
    """Take up new CSV files below ``paths.source`` and run each micro-batch through the daily flow.

    The stream carries file names only. ``after`` is called with a micro-batch's number and
    counts; if it raises, the run stops there and the micro-batch is repeated by the next.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", per_batch)
        .load(paths.source)
        .select("path")
    )

    def take(batch: DataFrame, number: int) -> None:
        files = sorted(r["path"] for r in batch.collect())  # at most per_batch names
        if files:
            counts = classify_files(spark, files, number, paths, moment)
            if after:
                after(number, counts)

    writer = names.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(take)
    writer.start().awaitTermination()
