"""Interleaved layout, copies of changed partitions and repeated micro-batches."""

import glob
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskloom.operators import governance
from riskloom.plans import batch, catalog
from riskloom.session import run_path
from riskloom.sources.promote import promote_changed
from riskloom.streaming import daily


def groups_in_reach(path, wanted):
    """(row groups whose footer ranges overlap, all row groups)."""
    hit = every = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(names.index(c)).statistics for c in wanted}
            every += 1
            hit += all(stats[c].min <= high and stats[c].max >= low for c, (low, high) in wanted.items())
    return hit, every


def test_a_filter_on_two_columns_reads_few_row_groups(spark, tmp_path):
    n = 200_000
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("a"),
        F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000)) / 1000, F.lit(3.0)).alias("b"),
        F.col("id").cast("string").alias("name"),
        F.repeat(F.md5(F.col("id").cast("string")), 3).alias("ballast"),
    )
    path = str(tmp_path / "laid")
    governance.publish_interleaved(df, path, ["a", "b"], ["name"], row_group=64 << 10)
    assert spark.read.parquet(path).count() == n
    hit, every = groups_in_reach(path, {"a": (40_000, 45_000), "b": (0.1, 0.13)})
    assert every >= 100 and 0 < hit < every / 10
    for column, reach in (("a", (40_000, 45_000)), ("b", (0.1, 0.13))):
        alone = groups_in_reach(path, {column: reach})[0]
        assert alone < every / 2
    wanted = spark.read.parquet(path).filter("a BETWEEN 40000 AND 45000 AND b BETWEEN 0.1 AND 0.13")
    assert wanted.count() == df.filter("a BETWEEN 40000 AND 45000 AND b BETWEEN 0.1 AND 0.13").count()
    meta = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).metadata
    assert meta.num_row_groups > 1


def test_gaps_and_constants_have_a_place(spark, tmp_path):
    df = spark.createDataFrame([(None, 1.0), (3, None), (3, 1.0), (None, None)], "a long, b double")
    governance.publish_interleaved(df, str(tmp_path / "x"), ["a", "b"])
    assert spark.read.parquet(str(tmp_path / "x")).count() == 4


def test_only_changed_partitions_move(spark, tmp_path):
    source, copy, manifest = (str(tmp_path / n) for n in ("source", "copy", "manifest"))
    rows = spark.range(100).select("id", (F.col("id") % 5).cast("int").alias("batch_nr"), F.when(F.col("id") % 3 > 0, "x").alias("t"))
    rows.write.partitionBy("batch_nr").parquet(source)
    first = promote_changed(spark, source, copy, manifest)
    assert (first.written, first.unchanged, first.gone, first.bad) == ([0, 1, 2, 3, 4], 0, [], [])
    files = sorted(glob.glob(f"{copy}/*/*.parquet"))
    again = promote_changed(spark, source, copy, manifest)
    assert (again.written, again.unchanged) == ([], 5) and sorted(glob.glob(f"{copy}/*/*.parquet")) == files
    # A repeated pair of rows cancels in the xor and shows in the sum.
    more = rows.filter("batch_nr = 2").unionAll(spark.createDataFrame([(7, 2, "y")] * 2, rows.schema))
    more.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_nr").parquet(source)
    third = promote_changed(spark, source, copy, manifest)
    assert (third.written, third.unchanged, third.bad) == ([2], 4, [])
    left = {f for f in files if "batch_nr=2" not in f}
    assert left <= set(glob.glob(f"{copy}/*/*.parquet"))
    assert sorted(map(tuple, spark.read.parquet(copy).filter("batch_nr = 2").select("id", "t").collect()), key=str) == sorted(map(tuple, more.select("id", "t").collect()), key=str)


def test_a_bad_partition_is_named_and_copied_again(spark, tmp_path, monkeypatch):
    from riskloom.sources import promote

    source, copy, manifest = (str(tmp_path / n) for n in ("source", "copy", "manifest"))
    spark.range(40).select("id", (F.col("id") % 4).cast("int").alias("batch_nr")).write.partitionBy("batch_nr").parquet(source)
    plain = promote.fingerprint

    def torn(df, by=()):
        found = plain(df, by)
        damaged = any(copy in f for f in df.inputFiles())
        return found.withColumn("n_rows", F.when(F.col("batch_nr") == 1, F.col("n_rows") - 1).otherwise(F.col("n_rows"))) if damaged else found

    monkeypatch.setattr(promote, "fingerprint", torn)
    assert promote.promote_changed(spark, source, copy, manifest).bad == [1]
    monkeypatch.setattr(promote, "fingerprint", plain)
    assert promote.promote_changed(spark, source, copy, manifest).written == [1]


class Killed(Exception):
    pass


@pytest.fixture(scope="module")
def faulty(spark, sf_dir):
    return catalog.raw_files(spark, sf_dir)


def tables(spark, paths):
    def rows(path):
        return sorted(map(str, spark.read.parquet(path).collect()))

    steps = ("quarantine", "validation", "training")
    return [rows(p) for p in (paths.quarantine, paths.valid, paths.results, paths.seen)] + [
        sorted(map(str, spark.read.parquet(f"{paths.lineage}/{s}").drop("destination").collect())) for s in steps
    ]


def test_a_killed_run_leaves_the_tables_of_a_whole_one(spark, faulty):
    moment, made = datetime(2023, 5, 12), []
    for killed in (False, True):
        paths = batch.Paths(run_path(spark, "lake"), faulty)
        progress = run_path(spark, "progress")

        def stop(number, counts):
            if killed and number == 0 and not made[1:]:  # noqa: B023
                made.append("killed")
                raise Killed

        if killed:
            with pytest.raises(Exception):
                daily.classify_new_files(spark, paths, progress, moment, per_batch=2, after=stop)
        daily.classify_new_files(spark, paths, progress, moment, per_batch=2)
        made.append(tables(spark, paths))
        daily.classify_new_files(spark, paths, progress, moment, per_batch=2)
        assert tables(spark, paths) == made[-1]
    assert made[1] == "killed" and made[0] == made[2]
