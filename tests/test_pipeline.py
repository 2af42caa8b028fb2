from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskloom.operators import governance
from riskloom.plans import catalog
from riskloom.plans.batch import Paths, run_batch
from riskloom.operators import iterative
from riskloom.plans.jobs import curate_table, parse
from riskloom.plans.train import Search, train_models
from riskloom.sources import files, promote, warehouse
from riskloom.sources.applications import applications
from riskloom.streaming.daily import land_new_csv

HEADER = ",Age,Sex,Job,Housing,Saving accounts,Checking account,Credit amount,Duration,Purpose,Risk\n"


def write_csv(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEADER + "".join(r + "\n" for r in rows))


def test_csv_gaps(spark, tmp_path):
    write_csv(tmp_path / "a.csv", "0,67,male,2,own,NA,little,1169,6,radio/TV,good", "1,22,female,2,own,,moderate,5951,48,radio/TV,bad")
    df = files.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns[:2] == ["application_id", "Age"]
    assert df.filter(F.col("Saving accounts").isNull()).count() == 2


def test_daily_landing_replaces_its_day_only(spark, tmp_path):
    src, out = tmp_path / "raw_data", str(tmp_path / "out")
    write_csv(src / "credit_12052023.csv", "0,67,male,2,own,NA,little,1169,6,car,good")
    write_csv(src / "credit_13052023.csv", "0,60,male,2,own,NA,little,1169,6,car,good")
    files.land_daily(spark, str(src), out)
    write_csv(src / "credit_13052023.csv", "0,61,male,2,own,NA,little,1169,6,car,good", "1,62,male,2,own,NA,little,1169,6,car,good")
    files.land_daily(spark, str(src / "credit_13052023.csv"), out)
    got = sorted(map(tuple, spark.read.parquet(out).select("batch_nr", "Age").collect()))
    assert got == [(20230512, 67), (20230513, 61), (20230513, 62)]


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    write_csv(src / "credit_12052023.csv", "0,67,male,2,own,NA,little,1169,6,car,good")
    land_new_csv(spark, str(src), out, mark)
    land_new_csv(spark, str(src), out, mark)
    assert spark.read.parquet(out).count() == 1
    write_csv(src / "credit_13052023.csv", "5,30,male,2,own,NA,little,1169,6,car,good")
    land_new_csv(spark, str(src), out, mark)
    got = sorted(map(tuple, spark.read.parquet(out).select("batch_nr", "application_id").collect()))
    assert got == [(20230512, 0), (20230513, 5)]


def test_promotion_sees_changes(spark, tmp_path):
    src, dst = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(1000).withColumn("t", F.col("id").cast("string")).write.parquet(src)
    done = promote.promote(spark, src, dst, files=3)
    assert done == promote.Promotion(1000, True)
    whole, part = promote.fingerprint(spark.read.parquet(src)), spark.read.parquet(dst)
    assert whole.first() != promote.fingerprint(part.filter("id <> 7")).first()
    # A pair of equal rows cancels in the xor but not in the sum.
    doubled = part.filter("id < 998").union(part.filter("id = 1")).union(part.filter("id = 1"))
    assert whole.first() != promote.fingerprint(doubled).first()


def test_tables_are_created_once(spark, sf_dir, tmp_path):
    for _ in range(2):
        warehouse.create_tables(spark, "credit_test", str(tmp_path / "wh"))
    warehouse.load_table(applications(spark, sf_dir), "credit_test.card_data")
    assert spark.table("credit_test.card_data").count() == 1500
    assert spark.table("credit_test.data_flow").columns == ["batch_nr", "timestamp", "step", "source", "destination"]
    spark.sql("DROP SCHEMA credit_test CASCADE")


def test_jdbc_options():
    """No database is started here; only the bulk settings are checked."""
    made = warehouse.jdbc_options("jdbc:x", "card_data", writers=4, batch_rows=500)
    assert made["numPartitions"] == "4" and made["batchsize"] == "500" and made["dbtable"] == "card_data"


def test_lineage_is_append_only(spark, tmp_path):
    log, moment = str(tmp_path / "log"), datetime(2023, 5, 12, 7, 30)
    for step in ("raw", "curation"):
        governance.append_lineage(governance.lineage_record(spark, step, "a", "b", moment), log)
    got = sorted(map(tuple, spark.read.parquet(log).select("batch_nr", "step", F.col("timestamp").cast("string")).collect()))
    assert got == [(20230512, "curation", "2023-05-12 07:30:00"), (20230512, "raw", "2023-05-12 07:30:00")]


def test_schema_hash_changes_with_the_schema(spark):
    a, b = spark.range(1), spark.range(1).withColumn("x", F.lit(1))
    assert governance.schema_hash(a) == governance.schema_hash(spark.range(9)) != governance.schema_hash(b)


@pytest.fixture
def raw_csv(spark, sf_dir, tmp_path):
    apps = applications(spark, sf_dir)
    names = dict(zip(apps.columns, [f.name for f in files.csv_schema()]))
    path = str(tmp_path / "raw_csv")
    apps.withColumnsRenamed(names).write.option("header", True).csv(path)
    return path


def test_batch_runs_and_reruns(spark, raw_csv, tmp_path):
    paths = Paths(str(tmp_path / "lake"), raw_csv)
    for day in (12, 13, 13):
        counts = run_batch(spark, paths, datetime(2023, 5, day))
        assert counts["training"] == counts["curation"] == counts["validation"] == 1500
    results = spark.read.parquet(paths.results)
    assert {tuple(r) for r in results.groupBy("batch_nr").count().collect()} == {(20230512, 1500), (20230513, 1500)}
    assert results.filter(F.col("prediction").isNull()).count() == 0
    summary = spark.read.parquet(paths.summary)
    assert summary.agg(F.sum("n_rows")).first()[0] == 3000
    log = spark.read.parquet(paths.lineage)
    assert log.count() == 18 and log.filter("step = 'validation' AND rows_in = 1500 AND rows_out = 1500").count() == 3


def small_models(n_rows, n_features):
    return {
        "LR": iterative.logistic_regression(n_rows, max_iter=10),
        "CART": iterative.decision_tree(5),
        "RF": iterative.random_forest(n_features, 5, 5),
        "SVM": iterative.KernelSvm(n_rows, n_features, size=32, max_iter=5),
        "XGB": iterative.boosted_trees(3, 3),
    }


def test_command_line():
    asked = parse(["batch", "in", "lake", "2023-05-12"])
    assert (asked.source, asked.lake, asked.day) == ("in", "lake", datetime(2023, 5, 12))
    with pytest.raises(SystemExit):
        parse(["train", "only-one-folder"])


def test_columns_are_taken_by_header(spark, tmp_path):
    write_csv(tmp_path / "a.csv", "0,67,male,2,own,NA,little,1169,6,car,good")
    (tmp_path / "b.csv").write_text("Job,Age,Sex,Housing,Saving accounts,Checking account,Credit amount,Duration,Purpose,Risk,application_id,More\n"
                                    "3,61,male,own,NA,little,1169,6,car,good,1,x\n")
    df = files.read_csv(spark, str(tmp_path))
    assert sorted(map(tuple, df.select("application_id", "Age", "Job").collect())) == [(0, 67, 2), (1, 61, 3)]
    (tmp_path / "c.csv").write_text("Age,Sex\n1,male\n")
    with pytest.raises(ValueError, match="Job"):
        files.read_csv(spark, str(tmp_path))


def test_undated_file_is_refused(spark, tmp_path):
    write_csv(tmp_path / "in" / "credit.csv", "0,67,male,2,own,NA,little,1169,6,car,good")
    with pytest.raises(ValueError, match="credit.csv"):
        files.land_daily(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_batch_keeps_every_row_and_its_encoding(spark, raw_csv, tmp_path):
    paths = Paths(str(tmp_path / "lake"), raw_csv)
    run_batch(spark, paths, datetime(2023, 5, 12))
    first = spark.read.parquet(paths.curated).columns
    day = tmp_path / "one_class"
    rows = ["0,67,male,2,F,NA,1-URGENT,1169,6,ASIA,good", "1,abc,male,2,F,NA,1-URGENT,1169,6,ASIA,good",
            "2,30,male,2,F,NA,1-URGENT,0,6,ASIA,good", "3,,male,2,F,NA,1-URGENT,100,6,ASIA,good"]
    write_csv(day / "x.csv", *rows)
    counts = run_batch(spark, Paths(str(tmp_path / "lake"), str(day)), datetime(2023, 5, 13))
    assert (counts["raw"], counts["quarantine"], counts["validation"], counts["training"]) == (4, 1, 3, 3)
    assert spark.read.parquet(paths.curated).columns == first
    got = spark.read.parquet(paths.results).filter("batch_nr = 20230513").select("application_id", "unscored", F.col("prediction").isNull()).collect()
    assert sorted(map(tuple, got)) == [(0, None, False), (2, "credit_amount", True), (3, "age", True)]


def test_jobs_from_raw_to_models(spark, sf_dir, tmp_path):
    raw, mid, out = (str(tmp_path / n) for n in ("results", "curated", "output"))
    applications(spark, sf_dir).write.parquet(raw)
    curate_table(spark, raw, mid)
    assert spark.read.parquet(mid).count() == 1500
    small = Search(
        forest={"max_depth": [3, 7], "n_estimators": [5], "max_features": [4, 20]},
        boosted={"max_depth": [3], "min_child_weight": [3], "gamma": [0.0], "subsample": [0.8], "colsample_bytree": [0.8]},
        rounds=3,
        folds=3,
        grid_folds=2,
        models=small_models,
    )
    train_models(spark, mid, out, small)
    ranking = spark.read.parquet(f"{out}/model_ranking")
    assert {r["model"] for r in ranking.collect()} == {"LR", "LDA", "KNN", "CART", "NB", "RF", "SVM", "XGB"}
    assert spark.read.parquet(f"{out}/model_scores").count() == 24
    assert spark.read.parquet(f"{out}/scored").count() == 1500
    scores = {r["model"]: r for r in spark.read.parquet(f"{out}/test_scores").collect()}
    assert set(scores) == {"forest_fixed", "bayes", "union", "boosted_best"}
    assert all(0.5 < r["accuracy"] <= 1 for r in scores.values())
    confusion = spark.read.parquet(f"{out}/confusion").groupBy("model").agg(F.sum("n").alias("n")).collect()
    assert {r["n"] for r in confusion} == {379}


def test_a_day_lands_from_many_files(spark, sf_dir):
    rows = applications(spark, sf_dir).repartition(6, "application_id")
    source = catalog.dated_files(spark, rows)
    days = [f.rsplit("_", 1)[1] for group in files.file_headers(spark, source).values() for f in group]
    assert days.count("12052023.csv") > 1 and days.count("13052023.csv") > 1
    assert files.read_csv(spark, source).count() == rows.count()


def test_compacted_copies_have_bounded_files(spark, tmp_path, monkeypatch):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    spark.range(50_000).write.parquet(src)
    monkeypatch.setattr(promote, "FILE_BYTES", 20_000)
    assert promote.promote(spark, src, dst, files=2).matched
    assert len(list((tmp_path / "dst").glob("part-*"))) > 2


def test_rows_sent_again_come_in_bounded_files(spark, sf_dir, monkeypatch):
    path = catalog.raw_files(spark, sf_dir)
    before = [f for group in files.file_headers(spark, path).values() for f in group]
    rows = files.read_csv_text(spark, path)
    n, thirds = rows.count(), rows.filter(F.col("application_id").cast("long") % 3 == 0).count()
    monkeypatch.setattr(catalog, "AGAIN_BYTES", 30_000)
    catalog.send_again(spark, path)
    after = [f for group in files.file_headers(spark, path).values() for f in group]
    assert len(after) > len(before) + 1
    assert files.read_csv_text(spark, path).count() == n + thirds
