"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Every result is computed in full and
thrown away (the noop sink); file-backed queries include writing their input files.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from keepsake.plans.queries import QUERIES

HEADLINE = [
    "text_split_pick", "csv_header_scan", "churn_lines_typed", "renewal_lines_typed",
    "yes_no_flags", "safe_cast_zero", "null_audit", "impute_mean", "column_stats", "corr_topk",
    "corr_matrix", "category_counts", "class_weights", "label_index_multi", "onehot_features",
    "vector_assemble_dense", "auto_categorical_rows", "standardize", "split_hash", "split_exact",
    "score_softmax", "prediction_listing", "classification_report", "auc_roc", "auc_pr",
    "metric_table", "rf_churn", "rf_balanced", "logreg", "logreg_l1", "linear_svc",
    "mlp_churn_wide", "study_churn_forest", "study_churn_network_wide", "study_renewal_forest",
    "study_renewal_network_pair",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    # The first job of a session pays for starting it; no query should.
    spark.range(1_000_000).selectExpr("sum(id)").collect()

    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
