"""Command line of the jobs: ``jobs.py curate|train|batch`` with the folders each needs."""

from __future__ import annotations

import argparse
from datetime import datetime

from riskloom.operators.columns import canonical_names
from riskloom.operators.encode import curate
from riskloom.plans.batch import Paths, run_batch
from riskloom.plans.train import Search, train_models
from riskloom.session import build_session
from riskloom.sources.files import read_parquet, write_parquet


def curate_table(spark, landed: str, curated: str) -> None:
    """Landed applicants to the curated feature table."""
    write_parquet(curate(canonical_names(read_parquet(spark, landed))), curated)


def parse(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("curate", help="landed parquet to curated parquet")
    job.add_argument("landed")
    job.add_argument("curated")
    job = jobs.add_parser("train", help="curated parquet to models and score tables")
    job.add_argument("curated")
    job.add_argument("models")
    job.add_argument("--fit-rows", type=int, help="labelled rows an iterative fit of the comparison learns from")
    job = jobs.add_parser("batch", help="one day's CSV files to published classes")
    job.add_argument("source")
    job.add_argument("lake")
    job.add_argument("day", type=lambda d: datetime.strptime(d, "%Y-%m-%d"))
    return parser.parse_args(words)


def main() -> None:
    asked = parse()
    spark = build_session(asked.job)
    if asked.job == "curate":
        curate_table(spark, asked.landed, asked.curated)
    elif asked.job == "train":
        train_models(spark, asked.curated, asked.models, Search(fit_rows=asked.fit_rows))
    else:
        run_batch(spark, Paths(asked.lake, asked.source), asked.day)


if __name__ == "__main__":
    main()
