"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   input directory (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_RUNS     timed runs per query after one warm-up (default 1; the median is reported)
BENCH_QUERIES  comma-separated keys instead of the headline set
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tallyline import catalog
from tallyline.session import get_session

HEADLINE = (
    "tonnage_by_org tonnage_load om_detail om_month_summary pa_invoice pa_revenue pa_cost account_plan "
    "invoice_stage sales_territory dim_sales_rep"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    keys = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = catalog.queries()
    seconds: dict[str, float] = {}
    for key in keys:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            # the whole result is produced and thrown away
            queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[key] = round(statistics.median(times[1:] or times), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
