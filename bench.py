"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   data folder, default /root/testdata/sf0.1
BENCH_CPUS     local threads, default 8
BENCH_QUERIES  comma-separated names, or "all"
BENCH_TRIALS   runs per query, default 3; the median counts

The first run of a query also writes the inputs it derives (CSV, JSON, layouts, logs); what it takes
beyond the median is summed up as ``staging`` and given for each query under ``first``.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from millrace.plans import QUERIES
from millrace.session import local_session

HEADLINE = """
agg_count_avg agg_full_count agg_one_column agg_filtered_count
four_ways_sql four_ways_df four_ways_csv four_ways_udf four_ways_text
scan_csv_schema scan_csv_gzip scan_ndjson_events
agg_workload agg_month_count agg_entity_avg agg_having_min agg_share agg_distinct_counts
agg_two_stage five_number dedup_keys sort_desc
wc_combine wc_collect wc_topk
join_dim_broadcast join_fact_merge join_fact_shuffle_hash join_filtered_adaptive
join_left_nullkey join_left_broadcast join_salted join_skew_adaptive
key_profile partition_profile repartition_sweep
event_trim log_offsets log_decode log_retention alert_drop
stream_type_counts stream_hourly_sink stream_alert
sink_by_date sink_codecs build_corpus except_all
""".split()


def run(spark, name: str, data: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = local_session(cpus, partitions=cpus)
    run(spark, "agg_count_avg", data)  # starts the executors; not counted
    trials = int(os.environ.get("BENCH_TRIALS", "3"))
    runs = {name: [run(spark, name, data) for _ in range(trials)] for name in names}
    seconds = {name: round(statistics.median(r), 3) for name, r in runs.items()}
    first = {name: round(r[0], 3) for name, r in runs.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "staging": round(sum(max(0.0, first[n] - seconds[n]) for n in names), 3),
                "first": first,
                "sf": os.path.basename(data.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
