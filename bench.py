"""Headline-query benchmark: prints one JSON line.

Runs the pipeline's stage queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``. Each query is executed to
each query gets one untimed warm-up run (JIT and codegen caches) before the
timed run; the value is the sum of the timed runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronoframe.plans.queries import SPARK_QUERIES  # noqa: E402
from chronoframe.session import drop_scratch, get_spark  # noqa: E402

HEADLINE = [
    "exclude_unrecorded_deaths",
    "filter_prevalent_from_origin",
    "hourly_mean",
    "pivot_hourly_grid",
    "rolling_12h_window",
    "rolling_12h_explode",
    "domain_window_features",
    "static_one_hot",
    "hourly_skeleton",
    "model_matrix",
    "train_split_rows",
    "auroc",
    "average_precision",
    "merge_datasets",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark()
    times = {}
    for name in names:
        SPARK_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        t0 = time.perf_counter()
        SPARK_QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "feature_pipeline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
