"""Timings of the headline queries; prints one JSON line.

`batch_suite` is the reference workload: trips from files, zone names, and all five metric tables, on as many rows as
the published run (about 3.07 million; the trip table repeated into parquet first, which is not timed). The other
queries run on the given tables as they are. Sessions are warm, as in the published figures.
"""

from __future__ import annotations

import json
import os
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline import build_session, shared_dir
from kerbline.operators import metrics, quality
from kerbline.operators import trips as trips_of
from kerbline.plans import catalog, trip_tables
from kerbline.sources import standins, tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SUITE_ROWS = 3_066_766
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

QUERIES = (
    "trip_summary",
    "trips_hourly",
    "trips_by_borough",
    "trips_by_zone",
    "payment_tip_summary",
    "trip_suite",
    "trips_enriched",
    "dq_summary",
    "dq_issue_histogram",
    "dq_issue_rows",
    "dq_duplicates",
    "click_window_metrics",
    "click_window_sliding",
    "click_funnel",
    "click_alerts",
    "zscore_alerts",
    "stream_window_append",
    "stream_funnel_append",
    "stream_funnel_update",
    "layout_pruned_query",
    "compact_files",
    "zorder_content",
    "pipeline_comparison",
)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(repeats: int, run) -> float:
    times = []
    for _ in range(repeats):
        started = time.perf_counter()
        run()
        times.append(time.perf_counter() - started)
    return round(min(times), 3)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "4g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    trips = standins.trips(spark, SF_DIR)
    copies = max(1, round(SUITE_ROWS / trips.count()))
    path = shared_dir(spark, "bench-trips")
    # Copies differ in time and distance, so that a trip is a duplicate only where it is one in the table.
    shifted = [
        trips.withColumns(
            {
                "tpep_dropoff_datetime": F.col("tpep_dropoff_datetime") + F.make_dt_interval(secs=F.lit(k)),
                "trip_distance": F.col("trip_distance") + k / 1000,
            }
        )
        for k in range(copies)
    ]
    reduce(DataFrame.unionAll, shifted).repartition(int(CPUS)).write.parquet(path)
    zones_path = shared_dir(spark, "bench-zones")
    standins.zones(spark, SF_DIR).coalesce(1).write.option("header", True).csv(zones_path)

    def suite(year: int | None) -> None:
        read = tables.read_trips(spark, path)
        for table in trip_tables.all_tables(read, tables.read_zones(spark, zones_path), year).values():
            consume(table)

    def joined_suite() -> None:
        """As published: both ends of every trip are joined to a place before anything is counted."""
        prepared = trips_of.prepare(tables.read_trips(spark, path))
        named = trips_of.attach_zones(prepared, tables.read_zones(spark, zones_path))
        named = named.where(F.col("dropoff_zone").isNotNull() & F.col("pickup_zone").isNotNull())
        for build in (metrics.summary, metrics.hourly, metrics.by_borough, metrics.by_zone, metrics.by_payment):
            consume(build(named))

    def quality_summary() -> None:
        undated = trips_of.prepare(tables.read_trips(spark, path), keep_undated=True)
        named = trips_of.attach_zones(undated, tables.read_zones(spark, zones_path), ends=["pickup"])
        consume(quality.summary(named, quality.Limits(pickup_year=standins.TRIP_YEAR)))

    suite_rows = tables.read_trips(spark, path).count()
    timed = {
        "batch_suite_3m_one_year": best_of(REPEATS + 1, lambda: suite(standins.TRIP_YEAR)),
        "batch_suite_3m_all_years": best_of(REPEATS + 1, lambda: suite(None)),
        "batch_suite_3m_both_zones": best_of(REPEATS, joined_suite),
        "dq_summary_3m": best_of(REPEATS, quality_summary),
    }
    available = catalog.all_queries()
    for name in QUERIES:
        timed[name] = best_of(REPEATS, lambda: consume(available[name](spark, SF_DIR)))

    headline = timed["batch_suite_3m_all_years"]
    result = {
        "metric": "batch trip suite, load + zones + five metric tables, no year filter",
        "value": headline,
        "unit": "sec",
        "queries": timed,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "rows": suite_rows,
        "rows_per_second": round(suite_rows / headline),
        "cores": int(CPUS),
        "total_sec": round(sum(timed.values()), 3),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
