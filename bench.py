"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated query names, or `all` (default: the headline queries)
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from squall.session import local_session  # noqa: E402
from suite import QUERIES  # noqa: E402

HEADLINE = (
    "time_axis", "regular_grid", "scan_csv", "ingest_hourly", "source_filter",
    "ffill", "interpolate_time", "fill_mean", "impute_by_rule",
    "iqr_bounds", "iqr_clip", "minmax_scale", "minmax_inverse", "quantiles",
    "calendar_features", "weather_flags_hourly", "wind_chill", "heat_index", "wind_category",
    "quantile_flags", "factorize", "rolling_mean_24h", "rolling_sum_24h",
    "correlation_matrix", "histogram", "kde", "boxplot_by_season", "profile_readings",
    "validate_suite", "error_metrics", "predict_batch_climatology",
    "sensitivity_climatology_hourly", "monitor_models", "train_models", "forecast_daily_climatology",
    "daily_preprocess", "daily_features", "hourly_preprocess", "hourly_features",
    "daily_end_to_end", "hourly_end_to_end",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not wanted else tuple(QUERIES) if wanted == "all" else wanted.split(",")
    spark = local_session(cpus, int(cpus))
    # One untimed query, so that the first timed one does not pay for starting the JVM.
    QUERIES["global_min_max"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
