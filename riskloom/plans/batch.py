"""One daily batch: land, profile, conform, curate, classify, publish, with lineage."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import PREFIXES, ROW_ID
from riskloom.functions.scalars import quoted
from riskloom.operators import closed_form
from riskloom.operators.columns import canonical_names, log_column
from riskloom.operators.conform import conform
from riskloom.operators.encode import Levels, curate, fit_levels, prepare
from riskloom.operators.governance import publish, refresh_summary, with_lineage
from riskloom.operators.profile import column_summary
from riskloom.plans.train import training_data
from riskloom.sources.files import read_csv_text, write_parquet


@dataclass
class Paths:
    """Where the batch reads and writes; all below one root unless given."""

    root: str
    source: str

    def __getattr__(self, name: str) -> str:
        if name in ("raw", "profile", "quarantine", "valid", "curated", "results", "summary", "lineage", "levels", "model", "seen"):
            return f"{self.root}/{name}"
        raise AttributeError(name)


@dataclass
class State:
    """What days share: the levels that indicators stand for, and the model."""

    levels: Levels
    model: closed_form.GaussianNaiveBayes


def fit_state(valid: DataFrame) -> State:
    levels = fit_levels(prepare(valid), [c for c in PREFIXES if c in prepare(valid).columns])
    data = training_data(curate(valid, levels))
    return State(levels, closed_form.fit(data.train, closed_form.FITTERS["NB"], data.features))


def stored_state(spark: SparkSession, paths: Paths, valid: DataFrame) -> State:
    """The stored levels and model; the first batch fits and stores them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{paths.model}/_SUCCESS")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        state = fit_state(valid)
        write_parquet(state.levels.to_table(spark), paths.levels)
        write_parquet(state.model.to_table(spark), paths.model)
    levels, model = (spark.read.parquet(p) for p in (paths.levels, paths.model))
    return State(Levels.from_table(levels), closed_form.GaussianNaiveBayes.from_table(model))


def classify(valid: DataFrame, state: State) -> DataFrame:
    """All rows and columns of ``valid`` with prediction, probability and ``unscored``.

    The row travels through curation as a struct, so scoring is one projection: no join
    back, and a row that can't be scored is kept with the features that it lacks.
    """
    whole = valid.withColumn("_row", F.struct(*[quoted(c) for c in valid.columns]))
    scored = closed_form.predict_every(log_column(curate(whole, state.levels)), state.model)
    return scored.select("_row.*", "prediction", "probability", "unscored")


def run_batch(spark: SparkSession, paths: Paths, moment: datetime, schema=None) -> dict[str, int]:
    """Run the phases in order and return the rows each wrote.

    Rows landed are valid or quarantined, and every valid row is published, scored or with
    the reason why not; other counts stop the run.

    Every table is partitioned by batch and overwritten per partition, so running a
    day again replaces that day only.
    """
    batch = F.lit(int(moment.strftime("%Y%m%d"))).cast("bigint")
    counts: dict[str, int] = {}

    def by_batch(df: DataFrame, path: str) -> None:
        write_parquet(df.withColumn("batch_nr", batch), path, "batch_nr")

    def phase(df: DataFrame, step: str, source: str, destination: str, rows_in=None, write=by_batch) -> DataFrame:
        written = with_lineage(df, write, step, source, destination, paths.lineage, moment, rows_in)
        counts[step] = written.count()
        return written

    # Text, so that a bad cell reaches the quarantine as it came.
    raw = canonical_names(read_csv_text(spark, paths.source, schema))
    landed = phase(raw, "raw", paths.source, paths.raw)
    phase(column_summary(landed.drop(ROW_ID)), "analysis", paths.raw, paths.profile, counts["raw"])
    checked = conform(landed)
    phase(checked.quarantine, "quarantine", paths.raw, paths.quarantine, counts["raw"])
    valid = phase(checked.valid, "validation", paths.raw, paths.valid, counts["raw"])
    state = stored_state(spark, paths, valid)
    phase(curate(valid, state.levels), "curation", paths.valid, paths.curated, counts["validation"])
    scored = classify(valid, state).withColumn("batch_nr", batch)
    phase(scored, "training", paths.curated, paths.results, counts["curation"], publish)
    if not counts["raw"] == counts["validation"] + counts["quarantine"] or counts["training"] != counts["validation"]:
        raise RuntimeError(f"rows were lost: {counts}")
    refresh_summary(spark, paths.results, paths.summary, [int(moment.strftime("%Y%m%d"))])
    return counts
