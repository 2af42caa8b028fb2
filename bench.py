"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from riskloom.plans.catalog import QUERIES
from riskloom.session import build_session

HEADLINE = [
    "curated_features",
    "encode_all_strings",
    "conform_violations",
    "kfold_contiguous",
    "kfold_stratified",
    "classification_report",
    "roc_points",
    "gnb_scores",
    "gnb_cv_recall",
    "lda_scored",
    "union_cv_accuracy",
    "knn5_predict",
    "knn5_cv_recall",
    "anova_f",
    "profile_overview_lines",
    "profile_columns",
    "profile_numeric",
    "profile_quantiles_lines",
    "profile_top_values",
    "corr_pearson",
    "corr_spearman",
    "cramers_v",
    "lr_scored",
    "lr_cv_recall",
    "lda_cv_recall",
    "profile_by_batches",
    "sparse_indicators",
    "tree_scored",
    "rf_scored",
    "rff_svm_scored",
    "gbt_scored",
    "classified_dataset",
    "rf_grid",
    "published_summary",
    "daily_landing",
    "classified_by_bayes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the JVM and the Python workers before anything is timed.
    QUERIES["knn5_predict"](spark, sf_dir.replace("sf0.1", "sf0.001")).count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
