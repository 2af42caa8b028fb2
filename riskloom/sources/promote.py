"""Copy a dataset between stores and prove that the copy is whole."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalars import quoted
from riskloom.sources.files import folder_bytes


def fingerprint(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Row count and two order-free checksums, from one scan without a shuffle of rows.

    The sum sees repeated rows, which cancel in the xor. With ``by`` there is one row per
    value of these columns.
    """
    row_hash = F.xxhash64(*[quoted(c) for c in sorted(df.columns)])
    return df.groupBy(*[quoted(c) for c in by]).agg(
        F.count("*").alias("n_rows"),
        F.bit_xor(row_hash).alias("hash_xor"),
        F.sum(row_hash.cast("decimal(20,0)")).alias("hash_sum"),
    )


@dataclass
class Promotion:
    rows: int
    matched: bool


FILE_BYTES = 128 << 20  # of the source that one file of a compacted copy takes up, at most


def promote(spark: SparkSession, source: str, destination: str, files: int | None = None) -> Promotion:
    """Copy parquet from ``source`` to ``destination`` and compare both sides.

    ``files`` compacts the copy, into more files where these would take more than
    ``FILE_BYTES`` of the source each; ``repartition`` rather than ``coalesce`` keeps the
    read side parallel.
    """
    df = spark.read.parquet(source)
    if files:
        df = df.repartition(max(files, -(-folder_bytes(spark, source) // FILE_BYTES)))
    df.write.mode("overwrite").parquet(destination)
    here, there = (fingerprint(spark.read.parquet(p)).first() for p in (source, destination))
    return Promotion(there["n_rows"], here == there)


@dataclass
class Copied:
    """Partitions that a copy has written, those that stand as they were, and what is wrong."""

    written: list = field(default_factory=list)
    unchanged: int = 0
    gone: list = field(default_factory=list)  # only at the destination
    bad: list = field(default_factory=list)  # written, and not what the source holds


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def promote_changed(spark: SparkSession, source: str, destination: str, manifest: str, by: str = "batch_nr") -> Copied:
    """Copy the partitions of ``source`` whose rows aren't those of the last copy.

    ``manifest`` holds a fingerprint per partition as it stood at the destination after its
    copy. Partitions of the source with the same fingerprint aren't read a second time nor
    written; the others replace their partition and are compared there. A partition that
    doesn't match is named in ``bad`` and not entered, so the next copy writes it again.
    Partitions that the source no longer has stay and are named in ``gone``. One number per
    changed partition reaches the driver.
    """
    rows = spark.read.parquet(source)
    here = fingerprint(rows, (by,))
    if _exists(spark, manifest):
        known = spark.read.parquet(manifest).select(by, *[F.col(c).alias(f"_{c}") for c in here.columns if c != by])
    else:
        known = here.limit(0).select(by, *[F.col(c).alias(f"_{c}") for c in here.columns if c != by])
    sums = [c for c in here.columns if c != by]
    kind = here.schema[by].dataType
    both = here.join(known.withColumn(by, F.col(by).cast(kind)), by, "full").withColumn(
        "same", F.forall(F.array(*[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in sums]), lambda x: x)
    )
    moves = both.filter(~F.col("same")).select(by, F.col(sums[0]).isNull().alias("gone")).collect()
    done = Copied(written=sorted(r[by] for r in moves if not r["gone"]), gone=sorted(r[by] for r in moves if r["gone"]))
    done.unchanged = both.filter("same").count()
    if not done.written:
        return done
    changed = F.col(by).isin(done.written)
    (
        rows.filter(changed).hint("rebalance", by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(destination)
    )
    there = fingerprint(spark.read.parquet(destination).filter(changed), (by,)).withColumn(by, F.col(by).cast(kind))
    wanted = here.filter(changed)
    good = there.join(wanted, [by, *sums])
    good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(manifest)
    kept = {r[by] for r in spark.read.parquet(manifest).filter(changed).join(wanted.drop(by), sums, "left_semi").select(by).collect()}
    done.bad = [value for value in done.written if value not in kept]
    return done
