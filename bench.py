"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Every query is executed completely into Spark's ``noop`` sink (all rows are
produced, nothing is collected), one after another in a warm session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from rankforge.plans.catalogue import QUERIES  # noqa: E402
from rankforge.session import DEFAULT_CONF, ensure_checkpoint_dir  # noqa: E402

# Headline set: the oracle-checked queries but for the file round trips, and one
# model sweep.
HEADLINE = [
    "best_rank", "best_rank_stream", "classify_rankings", "class_histogram",
    "class_histogram_bins", "build_enriched", "classified_join",
    "classified_left_default", "date_range_filter", "fallback_lookup",
    "json_field", "drop_unidentified", "batch_enrich", "row_aligned_concat",
    "clean_text", "repair_lines", "dedupe_first", "shard_assign",
    "resume_anti_join", "cap_classes", "binary_relabel", "equalize_classes",
    "add_default_class_sample", "class_distribution", "hash_split",
    "exact_split", "scale_features", "confusion_matrix", "weighted_f1",
    "accuracy_micro_f1", "sweep_select", "lr_sweep",
    "feature_correlation", "feature_jaccard", "importance_of_rule", "knn_predict",
    "word_counts", "regression_metrics", "rank_bucket_confusion", "json_batch_enrich",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("rankforge-bench")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)

    # Warm-up on the smallest tables: JVM start, class loading, JIT and
    # whole-stage codegen compilation (cached per plan shape) are paid once
    # per long-running session, not per query.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in only or HEADLINE:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
