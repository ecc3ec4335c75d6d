"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
Each query is fully materialised with the no-op sink (every row and column computed, nothing
collected). Set BENCH_QUERIES=a,b,c to run a subset.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "knn_predict",            # Q1 end to end (flagship)
    "item_similarity",        # K2 over every needed pair
    "knn_top_k",              # K3
    "rmse",                   # A9 on the kNN predictions
    "error_histogram",        # A10
    "user_profile",           # P4
    "business_profile",       # P3
    "checkin_stats",          # P12
    "one_hot_attributes",     # E2
    "multi_hot_categories",   # E3
    "pca_attributes",         # E4
    "pca_categories",         # E5
    "wide_features",          # E7
    "union_one_hot",          # E8
    "hybrid_predict",         # Q2 (kNN + 100 boosted trees of depth 10)
    "feature_model_predict",  # Q3 (wide features + 300 boosted trees of depth 8)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from pyspark.sql import SparkSession

    from ratewise.plans.registry import QUERIES
    from ratewise.session import clear_scratch, get_session

    SparkSession.builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ratewise-bench-"))
    spark = get_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, app_name="ratewise-bench")
    spark.sparkContext.setLogLevel("ERROR")

    # Warm the JVM (class loading, JIT, codegen caches) with the flagship plan on the smallest
    # sibling scale when present, so no measured table is pre-read; else the lightest query.
    tiny = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(tiny) and os.path.abspath(tiny) != os.path.abspath(sf_dir):
        QUERIES["knn_predict"](spark, tiny).write.format("noop").mode("overwrite").save()
    else:
        QUERIES["item_mean"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # report, keep going
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        spark.catalog.clearCache()
        clear_scratch(spark)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
