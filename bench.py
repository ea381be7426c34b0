"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS (default 3, the median counts) set the
tables, the cores and the repetitions.  Every query is run to the end on all
rows through the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from gradientlab.queries import REGISTRY
from gradientlab.session import local_session

HEADLINE = [
    "merge_community", "relative_cover", "relative_cover_residual", "residual_cover", "split_community",
    "cover_summary", "assign_treatment", "decode_cover_10", "build_ids", "collapse_duplicates", "site_meta",
    "site_species", "sql_origin_dest", "scalar_subquery_count", "inner_chain_sum", "semi_key", "effort_correction",
    "observer_correction", "point_fixes", "pool_observers", "pin_counts", "retro_correct", "quadrat_rollup",
    "biomass_rollup", "stem_relative", "attach_names", "resolve_fuzzy", "number_unresolved", "match_hierarchy",
    "attach_trait_db", "tidy_traits", "mean_of_means", "gapfill_traits", "seasonal_stats", "summer_climate",
    "monthly_long", "sample_grid", "tolerance_match", "stations_within", "null_census", "merge_audit", "plot_layout",
    "gather_wide", "first_per_key", "crosstab3", "topk_cover", "parse_mixed_dates", "csv_roundtrip", "parquet_sink",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, max(cpus, 1), "gradientlab-bench")
    REGISTRY["merge_community"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for name in names:
        laps = []
        for _ in range(runs):
            start = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps), 4)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 4), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
