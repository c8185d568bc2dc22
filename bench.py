"""Time the headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarifa.plans.queries import QUERIES  # noqa: E402
from tarifa.plans.tables import Tables  # noqa: E402
from tarifa.session import build_session, save  # noqa: E402

HEADLINE = [
    "csv_to_parquet",
    "staging_filter",
    "reject_summary",
    "fact_flight_prices",
    "dim_routes",
    "dim_airlines",
    "ml_flight_pricing",
    "fare_features_train",
    "iqr_trim",
    "label_encode",
    "ordered_target_means",
    "incremental_upsert",
    "clustered_write",
    "interleaved_write",
    "dq_report",
    "price_requests",
    "price_batch",
    "generate_itineraries",
    "stream_upsert",
    "train_gbt",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compilers and the file system before timing.
    Tables(spark, folder).fact.limit(1).collect()
    seconds = {}

    def timed(name: str, run) -> None:
        """The second of two runs: the first compiles code."""
        run()
        started = time.time()
        run()
        seconds[name] = round(time.time() - started, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # Itineraries are derived from line items for want of given ones; that adapter has its own line, and the queries read a copy
    # stored once.
    timed("derive_itineraries", lambda: drain(Tables(spark, folder).raw))
    raw = save(Tables(spark, folder).raw.repartition(int(cpus)), "raw")

    def tables() -> Tables:
        found = Tables(spark, folder)
        found.raw = raw
        return found

    for name in HEADLINE:
        timed(name, lambda name=name: drain(QUERIES[name](tables())))
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
