"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pricefield.plans.catalog import QUERIES  # noqa: E402
from pricefield.session import build_session  # noqa: E402

HEADLINE = [
    "src_mandi", "unpivot_wide", "dedup_quotes", "filter_category", "fence_q01_q99", "fence_iqr", "ffill_bfill_rows",
    "daily_mean", "daily_median", "daily_weighted", "gap_fill_linear", "describe_prices", "boxplot_stats",
    "corr_matrix", "calendar_features", "sma", "rolling_median", "rolling_kurt", "ema", "macd", "rsi", "cci",
    "all_features", "log_return", "panel_rolling", "processed_panel", "global_index", "sequence_windows",
    "sequence_windows_global", "cv_folds", "scale_robust", "select_by_corr", "forecast_metrics",
    "information_coefficient", "ensemble_weighted", "error_ecdf", "holt_winters", "ar_select", "trend_seasonal_fit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(found.group(1)) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
