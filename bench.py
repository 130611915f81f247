"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs once to warm up and then three times into a sink that discards its rows;
the median counts. ``--compare`` times instead two designs this library avoids:
a Python distance function per row, and one job per checked column.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time
from statistics import median

from pyspark.sql import functions as F

from cardwarden.functions import haversine_km
from cardwarden.operators import quality
from cardwarden.plans import adapters, catalog
from cardwarden.session import local_session

HEADLINE = (
    "kpi_category",
    "kpi_totals",
    "silver_refine",
    "silver_dedup",
    "haversine_km",
    "txn_time_delta",
    "fraud_alerts_permissive",
    "fraud_alerts_5km",
    "fraud_alerts_strict",
    "fraud_bi_metrics",
    "fraud_geo_physical",
    "device_mismatch",
    "shared_device",
    "shared_device_pairs",
    "reward_eligible",
    "alerts_daily_change",
    "dq_suite_results",
    "dq_quarantine",
    "dq_unique_rows",
    "dq_foreign_key",
)


def seconds(run, repeats: int = 3) -> float:
    run()
    taken = []
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(median(taken), 3)


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def headline(spark, sf_dir: str) -> dict[str, float]:
    return {
        name: seconds(lambda build=catalog.QUERIES[name]: discard(build(spark, sf_dir)))
        for name in HEADLINE
    }


def compare(spark, sf_dir: str) -> dict[str, float]:
    rows = adapters.transactions(spark, sf_dir).crossJoin(spark.range(10)).cache()
    rows.count()
    here = [F.col("latitude"), F.col("longitude"), F.lit(38.7223), F.lit(-9.1393)]

    @F.udf("double")
    def per_row(lat1, lon1, lat2, lon2):
        if lat1 is None or lon1 is None:
            return 0.0
        p1, p2 = math.radians(lat1), math.radians(lat2)
        h = math.sin((p2 - p1) / 2) ** 2
        h += math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
        return 12742.0 * math.asin(min(1.0, math.sqrt(h)))

    columns = ["transaction_id", "customer_id", "amount", "transaction_date", "category"]

    def job_per_column():
        for column in columns:
            rows.filter(F.col(column).isNull()).count()

    return {
        "distance_native": seconds(lambda: discard(rows.select(haversine_km(*here)))),
        "distance_python_per_row": seconds(lambda: discard(rows.select(per_row(*here)))),
        "nulls_one_aggregate": seconds(lambda: quality.null_counts(rows, columns).collect()),
        "nulls_job_per_column": seconds(job_per_column),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    measured = (compare if "--compare" in sys.argv else headline)(spark, sf_dir)
    report = {
        "metric": "sum of median query seconds",
        "value": round(sum(measured.values()), 3),
        "unit": "sec",
        "queries": measured,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
