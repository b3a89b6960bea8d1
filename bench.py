"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query is forced to full execution with the
``noop`` sink (no collect to the driver).  ``pipeline`` is the reference's
whole run: raw tables written (ingestion), staging → tall mart (written) →
wide mart (written) → quality report.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelspark.plans import pipeline  # noqa: E402
from panelspark.plans.queries import AS_OF, QUERIES  # noqa: E402
from panelspark.session import local_session  # noqa: E402
from panelspark.sources import derived, tables  # noqa: E402

HEADLINE = [
    "mart_time_series",
    "mart_overview",
    "dq_report",
    "incremental_new_rows",
    "catalog_extract",
    "src_delimited_lines",
    "win_lag_year",
    "win_rolling_12",
    "win_chunked_skew",
    "win_hot_series",
    "latest_flag",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    scratch = tempfile.mkdtemp(prefix="panelspark-bench-")

    # Warm-up on the smallest scale: JVM JIT and codegen caches, so the
    # timings below measure the plans, not JVM start-up.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    raw_dir = f"{scratch}/raw"
    for k, df in derived.raw_tables(spark, sf_dir, stage=True).items():
        tables.materialize(df, f"{raw_dir}/{k}")
    res = pipeline.run(spark, pipeline.read_raw_tables(spark, raw_dir), f"{scratch}/marts", as_of=AS_OF, gate=False)
    timings["pipeline"] = round(time.perf_counter() - t0, 3)

    tall_rows = spark.read.parquet(res.time_series_path).count()
    wide_rows = spark.read.parquet(res.overview_path).count()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "rows": {"time_series": tall_rows, "overview": wide_rows},
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
