"""Headline queries timed on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

A query's time covers building its plan and running it to the end over all columns.
"""

from __future__ import annotations

import json
import os
import time

from tidepanel.catalog import QUERIES
from tidepanel.session import local_session

HEADLINE = (
    "acps_daily", "acps_hourly", "congestion_class", "hourly_movements", "gap_fill", "holiday_flags",
    "weather_daily", "join_weather", "lags_daily", "rolling_mean", "rolling_std", "chrono_split",
    "seasonal_decompose", "asof_history", "trailing_range", "lag_lookup", "seasonal_profiles",
    "target_correlation", "describe", "histogram", "snapshot_density", "density_grid", "flatten_board",
    "weather_unpack", "dq_report", "baseline_table", "regression_metrics", "class_report",
    "confusion_matrix", "residual_by_class", "scenario_features", "stream_hourly", "stream_dedupe",
    "arx_grid", "linear_regress",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed query starts the workers
    QUERIES["hourly_counts"](spark, root).write.format("noop").mode("overwrite").save()
    took: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
