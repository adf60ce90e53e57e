"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians), "unit",
"queries": {name: seconds}, "rows": {name: n}, "sf", "cpus"} (plus "errors"
if a query failed). Each query is run once to warm up, then $BENCH_REPEAT
times (default 3); the median is reported. A timed run builds the query and
writes its whole result to Spark's ``noop`` sink, so every column of every
row is computed and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.registry import REGISTRY  # noqa: E402
from tidemark.session import get_session  # noqa: E402

HEADLINE = [
    "metric_all_by_chain",
    "metric_volume_by_day",
    "metric_by_user_dimension",
    "fact_transactions",
    "dim_users",
    "latest_per_key",
    "cdc_compact",
    "cdc_merge",
    "cdc_insert_only_merge",
    "scd2_apply",
    "scd2_from_log",
    "as_of_join",
    "dq_summary",
    "api_flatten",
    "stream_upsert",
]


def run(df) -> None:
    # Write to the no-op sink: every column is computed, nothing is kept.
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    times, rows, errors = {}, {}, {}
    for name in names:
        fn = REGISTRY[name]
        try:
            run(fn(spark, sf_dir))  # warm-up
            samples = []
            for _ in range(repeat):
                t0 = time.perf_counter()
                run(fn(spark, sf_dir))
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 3)
            rows[name] = fn(spark, sf_dir).count()
        except Exception as e:  # noqa: BLE001 -- report, keep measuring the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "rows": rows, "sf": sf, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
