"""Time the headline queries; prints one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Each query runs once to warm up and then
``$BENCH_RUNS`` times (default 2) into a sink that drops the rows; the median counts. Cached data is
cleared before every run.
"""

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeloom.queries import QUERIES  # noqa: E402
from lakeloom.session import build_session, clear_scratch  # noqa: E402

HEADLINE = """
l2_lineage_stages l3_column_lineage_stages l5_recursive_lineage l6_lineage_paths l8_all_lineage_paths l9_lineage_flow
b1_date_dimension b3_expand_to_datetime b6_date_60_minute_view
c2_compare c2_compare_keyed c3_compare_all
d1_scd1 d2_scd2 d4_scd2_from_snapshots d5_contiguous_snapshots
q1_expect_warn q5_quarantine
g3_flatten h4_markets_gold h8_weather_aggregated i3_latest_schedules
w1_newest_per_key j4_left_star_join a11_column_summary u6_except_all u5_union_distinct
m4_merge m9_change_feed m13_clustered_layout n1_fake_customers
k1_write_folders s14_file_stream t7_stream_scd1
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            spark.catalog.clearCache()
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
            clear_scratch(spark)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name:28s} {seconds[name]:8.3f}  first {times[0]:.3f}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)$", folder.rstrip("/"))
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
