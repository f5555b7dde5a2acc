"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then ``RUNS`` times into the no-op sink; the
median counts. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from silverloom.registered import load  # noqa: E402
from silverloom.session import build_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "flagship_user_profile", "tbl_01_deduplicate", "tbl_02_unpivot", "tbl_03_pivot_options", "tbl_05_union_relations",
    "tbl_08_date_spine", "scl_01_surrogate_key", "scl_05_width_bucket", "scl_09_url_parameter", "scl_15_capture",
    "rel_02_inner_join", "rel_07_semi_join", "rel_09_group_having", "rel_13_windows", "rel_14_mutual_best",
    "pat_01_positional_attribution", "pat_02_even_allocation", "pat_04_daily_rate_lookup", "pat_06_two_stage_dedupe",
    "pat_08_list_to_names", "pat_12_version_number", "dq_05_relationships_where", "dq_08_cardinality_equality",
    "dq_13_exclusive_ranges", "dq_19_sequential_values", "dq_20_unique_combination", "dq_23_suite", "src_06_csv_read",
    "chg_01_fingerprint", "snk_04_upsert_load", "fct_04_fact_editing", "fct_10_fact_purchase_cost",
    "fct_11_fact_revenue_by_resources", "fct_12_fact_revenue_distro", "fct_16_fact_view_yt", "dim_24_dim_stock",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "16g"}
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    wanted = sys.argv[1:] or HEADLINE
    took: dict[str, float] = {}
    for name in wanted:
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        took[name] = round(statistics.median(times[1:]), 4)
        print(f"{name}: {took[name]}", file=sys.stderr)
    spark.stop()
    total = round(sum(took.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    line = {"metric": "headline_total", "value": total, "unit": "sec", "queries": took, "sf": float(scale) if scale[:1].isdigit() else scale}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
