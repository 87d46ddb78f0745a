"""Benchmark: build the warehouse, then run every mart, check, forecast and finding.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line. Each query is executed in full with the ``noop``
sink (no rows are collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopscope.plans.registry import (  # noqa: E402
    FORECAST_QUERIES, INSIGHT_QUERIES, QUALITY_QUERIES, RETENTION_QUERIES, REVENUE_QUERIES,
)
from shopscope.plans.warehouse import fresh_warehouse  # noqa: E402
from shopscope.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    timings: dict[str, float] = {}

    t0 = time.time()
    wh = fresh_warehouse(spark, sf_dir)
    timings["pipeline_clean"] = round(wh.seconds.get("clean", 0.0), 3)
    timings["pipeline_fact"] = round(wh.seconds.get("fact", 0.0), 3)
    timings["pipeline_total"] = round(time.time() - t0, 3)

    queries = {**REVENUE_QUERIES, **RETENTION_QUERIES, **QUALITY_QUERIES, **FORECAST_QUERIES,
               **INSIGHT_QUERIES}
    for name, fn in queries.items():
        t = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t, 3)

    total = round(timings["pipeline_total"] + sum(v for k, v in timings.items()
                                                  if not k.startswith("pipeline")), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "pipeline_and_all_queries_seconds", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "rows": wh.counts()}))
    spark.stop()


if __name__ == "__main__":
    main()
