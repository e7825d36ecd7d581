"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs (median).
``python bench.py name ...`` times only those queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemill.plans import registry
from tidemill.session import build

HEADLINE = [
    "dau_first", "dau_hour", "new_devices", "dau_drop_seen",
    "first_order_flag", "user_state_lookup", "order_amount_hour", "province_sales",
    "order_detail_interval", "sale_detail", "latest_users", "product_sales",
    "keyword_match", "age_share", "sale_page", "kpi_board", "hour_compare_amount",
    "device_windows", "coupon_alerts_5min", "alerts_per_minute", "route_logs", "decode_orders",
]
# streams are timed once: each run starts its jobs from nothing
STREAMS = ["stream_dau", "stream_sale_detail", "stream_alerts_per_minute"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        began = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    wanted = sys.argv[1:] or HEADLINE + STREAMS
    times = {}
    for name in wanted:
        if name in STREAMS:
            times[name] = round(seconds(name), 3)
            continue
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, warm median; streams, one run", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
