"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import re
import time

os.environ.setdefault("TZ", "UTC")

from dustline.registry import load  # noqa: E402
from dustline.session import build_session  # noqa: E402

HEADLINE = ("complete_station_days", "tiered_daily_summary", "region_daily_statistics", "fire_kernel_features",
            "dynamic_predictors", "colocation_pairs", "calibration_ratio_models", "held_out_neighbourhood",
            "nearest_station", "correlogram_pair_bins", "scheme_model_subset_scores", "nested_interval_coverage",
            "ensemble_candidates", "monthly_mean_grid", "encoded_and_decoded_day", "polygon_index_of_cells",
            "gaussian_neighbourhood", "latest_row_per_key")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(max(8, int(cpus))), "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1"})
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = load()
    catalogue["latest_row_per_key"].build(spark, sf_dir).count()  # start the executors
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
