"""Headline queries on one data folder; prints one JSON line.

Every query runs once to warm up and is then timed while writing all its rows to a
sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))
from eventloom.plans import QUERIES  # noqa: E402
from eventloom.session import tuned  # noqa: E402

HEADLINE = (
    "flagship_pt_spectrum",
    "a04_flatten_tracks",
    "a04_flatten_cells",
    "a10_table_profile",
    "b06_event_model_kinematics",
    "b17_pair_mass_hypotheses",
    "b18_impact_and_pointing",
    "c10_fired_class_names",
    "c13_trigger_expression",
    "c18_raw_event_selection",
    "d01_positional_join",
    "d07_best_valid_version",
    "d13_nearest_record",
    "d18_interactions_in_window",
    "d20_unreferenced_objects",
    "e01_histogram_momentum",
    "e08_robust_location",
    "e12_gaussian_fit",
    "e15_event_plane",
    "e16_multiplicity_estimators",
    "e19_run_length_error_log",
    "f01_overflow_correction",
    "f04_rate_and_error",
    "f09_luminosity",
    "f12_changes_only",
    "f17_closest_interaction",
    "f19_findable_rows",
    "f21_gap_clusters",
    "h01_concat",
    "k01_pile_up_flag",
    "k03_clean_pairs",
    "l07_posterior",
    "n01_root_ancestor",
    "n02_physical_primary",
    "p01_histograms_per_trigger_group",
    "p03_kolmogorov_test",
    "m01_local_fit",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = tuned(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    ).getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in HEADLINE:
        for run in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
