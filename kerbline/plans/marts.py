"""Comparison and dashboard marts over result tables and run reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.expressions import label_order
from kerbline.sources.reports import EVENT_ROWS_TYPE

# How the comparison table names its two kinds of work.
BATCH_WORKLOAD = "bounded NYC Taxi aggregation"
STREAM_WORKLOAD = "clickstream event burst"
UNNAMED_STREAM = "streaming_demo"
BATCH_UNIT = "rows/s"
STREAM_UNIT = "events/s"


def _per_second(amount: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, F.round(amount / seconds, 4))


# --- engines side by side -------------------------------------------------------------------------------------------


def engine_ratio(results: DataFrame, base: str = "pandas", other: str = "pyspark") -> DataFrame:
    """Seconds of two engines per workload size and their ratio; null where an engine has no run or no time.

    Of several runs the last by `position` counts; without that column the slowest.
    """
    order = "position" if "position" in results.columns else "duration_seconds"
    wide = (
        results.groupBy("row_limit_label")
        .pivot("engine", [base, other])
        .agg(F.max_by("duration_seconds", F.struct(order, "duration_seconds")))
        .withColumnsRenamed({"row_limit_label": "row_limit", base: f"{base}_seconds", other: f"{other}_seconds"})
    )
    base_seconds, other_seconds = F.col(f"{base}_seconds"), F.col(f"{other}_seconds")
    ratio = F.when(base_seconds > 0, F.round(other_seconds / base_seconds, 3))
    return wide.withColumn(f"spark_vs_{base}_ratio", ratio).orderBy(*label_order(F.col("row_limit")))


def throughput(results: DataFrame, startup_seconds: float | None = None, startup_engine: str = "pyspark") -> DataFrame:
    """Rows per second and time to the first result; only one engine has to start up."""
    seconds = F.col("duration_seconds").try_cast("double")
    startup = F.when(F.col("engine") == startup_engine, F.lit(startup_seconds).cast("double"))
    rows = F.col("row_count").try_cast("bigint")
    return results.select(
        "engine",
        "row_limit_label",
        rows.alias("row_count"),
        F.round(seconds, 4).alias("duration_seconds"),
        F.round(startup, 4).alias("startup_seconds"),
        F.round(seconds + F.coalesce(startup, F.lit(0.0)), 4).alias("time_to_first_result_seconds"),
        _per_second(rows, seconds).alias("rows_per_second"),
    )


def primary(profiles: DataFrame) -> DataFrame:
    """One profile per engine: the full run if there is one, else the largest. An aggregate, not a ranking window."""
    rank = F.struct(
        (F.col("row_limit_label") == "full").alias("full"),
        F.coalesce("row_count", F.lit(0)).alias("rows"),
        F.col("row_limit_label").alias("label"),  # settles what is left
    )
    best = profiles.groupBy("engine").agg(F.max_by(F.struct(*profiles.columns), rank).alias("best"))
    return best.select("best.*").orderBy("engine")


def preferred(results: DataFrame, engines: Sequence[str] = ("pyspark", "pandas")) -> DataFrame:
    """The result to show: a full run of the first engine that has one, else the last result by `position`."""
    place = reduce(
        lambda rest, item: F.when(F.col("engine") == item[1], F.lit(len(engines) - item[0])).otherwise(rest),
        reversed(list(enumerate(engines))),
        F.lit(0),
    )
    full = F.when(F.col("row_limit_label") == "full", place).otherwise(0)
    # Among full runs of one engine the first counts; among the rest, the last.
    order = F.when(full > 0, -F.col("position")).otherwise(F.col("position"))
    chosen = results.agg(F.max_by(F.struct(*results.columns), F.struct(full, order)).alias("row"))
    return chosen.where("row is not null").select("row.*")


# --- stream reports -------------------------------------------------------------------------------------------------


def timing(runs: DataFrame) -> DataFrame:
    """End-to-end time and rates from publish and processing time; null when either is unknown."""
    publish, processing = F.col("publish_seconds"), F.col("processing_seconds")
    total = F.round(publish + processing, 4)
    return runs.withColumns(
        {
            "publish_seconds": F.round(publish, 4),
            "processing_seconds": F.round(processing, 4),
            "end_to_end_seconds": total,
            "events_per_second": _per_second(F.col("event_count"), total),
            "sessions_per_second": _per_second(F.col("session_count"), total),
        }
    )


def _total(items: str, field: str) -> Column:
    """Sum of a field over an array of structs; nulls count as nothing, a missing array as zero."""
    zero = F.lit(0).cast("bigint")
    known = F.coalesce(F.transform(F.col(items), lambda x: x[field]), F.array().cast("array<bigint>"))
    return F.aggregate(known, zero, lambda total, n: total + F.coalesce(n, zero))


def _largest(items: str, field: str) -> Column:
    return F.array_max(F.transform(F.col(items), lambda x: x[field]))


def _latest_funnel() -> Column:
    """The funnel row of the last window of a report."""
    dated = F.transform(
        F.col("funnel_metrics"),
        lambda row: F.struct(F.coalesce(row["window_end"], row["window_start"], F.lit("")).alias("at"), row.alias("row")),
    )
    return F.array_max(dated)["row"]


def _unless_zero(number: Column) -> Column:
    return F.nullif(number, F.lit(0).cast("bigint"))


def _counts_by_type() -> Column:
    """Events per type over all windows of a report."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    zero = F.lit(0).cast("bigint")

    def added(counts: Column, row: Column) -> Column:
        kind, count = row["event_type"], F.coalesce(row["event_count"], zero)
        others = F.map_filter(counts, lambda key, _: key != kind)
        now = F.create_map(kind, F.coalesce(counts[kind], zero) + count)
        return F.when(kind.isNull(), counts).otherwise(F.map_concat(others, now))

    return F.aggregate(F.coalesce("event_metrics", F.array().cast(EVENT_ROWS_TYPE)), empty, added)


def complete_reports(reports: DataFrame) -> DataFrame:
    """Fill what older reports lack: counts from the window rows, timing from the slowest trigger."""
    given = F.col("scenario_summary")
    filled = reports.withColumn(
        "scenario_summary",
        F.struct(
            F.coalesce(_unless_zero(given["generated_event_count"]), _total("event_metrics", "event_count")).alias(
                "generated_event_count"
            ),
            F.coalesce(
                _unless_zero(given["generated_session_count"]),
                _unless_zero(_latest_funnel()["total_sessions"]),
                F.col("config.page_view_sessions"),
            ).alias("generated_session_count"),
            F.coalesce(_unless_zero(given["generated_user_count"]), _latest_funnel()["total_users"]).alias(
                "generated_user_count"
            ),
            F.when(F.size(given["event_type_counts"]) > 0, given["event_type_counts"])
            .otherwise(_counts_by_type())
            .alias("event_type_counts"),
        ),
    )
    slowest = _largest("query_progress", "trigger_execution_ms")
    seconds = F.when(slowest > 0, F.round(slowest / 1000.0, 4))
    derived = F.struct(
        F.lit(None).cast("double").alias("publish_seconds"),
        seconds.alias("processing_seconds"),
        seconds.alias("end_to_end_seconds"),
        _per_second(F.col("scenario_summary.generated_event_count"), seconds).alias("events_per_second"),
        _per_second(F.col("scenario_summary.generated_session_count"), seconds).alias("sessions_per_second"),
    )
    fields = ("publish_seconds", "processing_seconds", "end_to_end_seconds", "events_per_second", "sessions_per_second")
    known = F.coalesce(*[F.col(f"timing.{f}") for f in fields]).isNotNull()
    return filled.withColumn("timing", F.when(known, F.col("timing")).otherwise(derived))


def stream_profiles(reports: DataFrame, keep: Sequence[Column] = ()) -> DataFrame:
    """One row of headline figures per report, after the columns to `keep`."""
    seconds = ("publish_seconds", "processing_seconds", "end_to_end_seconds")
    rates = ("events_per_second", "sessions_per_second")
    return reports.select(
        *keep,
        F.col("config.query_name").alias("query_name"),
        F.coalesce("scenario_summary.generated_event_count", _total("event_metrics", "event_count")).alias(
            "generated_event_count"
        ),
        F.coalesce("scenario_summary.generated_session_count", "config.page_view_sessions").alias(
            "generated_session_count"
        ),
        *[F.round(f"timing.{name}", 4).alias(name) for name in (*seconds, *rates)],
        F.round(_largest("query_progress", "processed_rows_per_second"), 4).alias("observed_processed_rows_per_second"),
        _total("anomaly_alerts", "alert_count").alias("alert_count"),
        F.try_element_at(F.col("anomaly_alerts"), F.lit(1))["severity"].alias("severity"),
    )


def pipeline_comparison(primary_profiles: DataFrame, streams: DataFrame) -> DataFrame:
    """Batch engines and stream runs in one table; units differ and are named."""
    batch = primary_profiles.select(
        F.lit("batch").alias("pipeline"),
        F.concat_ws(" / ", "engine", "row_limit_label").alias("variant"),
        F.lit(BATCH_WORKLOAD).alias("workload"),
        F.col("time_to_first_result_seconds").alias("latency_seconds"),
        F.col("rows_per_second").alias("throughput"),
        F.lit(BATCH_UNIT).alias("throughput_unit"),
        F.col("row_count").alias("record_count"),
    )
    stream = streams.select(
        F.lit("streaming").alias("pipeline"),
        F.coalesce("query_name", F.lit(UNNAMED_STREAM)).alias("variant"),
        F.lit(STREAM_WORKLOAD).alias("workload"),
        F.col("end_to_end_seconds").alias("latency_seconds"),
        F.col("events_per_second").alias("throughput"),
        F.lit(STREAM_UNIT).alias("throughput_unit"),
        F.col("generated_event_count").alias("record_count"),
    )
    return batch.unionByName(stream)


def fastest_batch(comparison: DataFrame) -> DataFrame:
    batch = comparison.where(F.col("pipeline") == "batch")
    return batch.orderBy(F.asc_nulls_last("latency_seconds"), "variant").limit(1)


# --- dashboard ------------------------------------------------------------------------------------------------------


def transposed(row: DataFrame) -> DataFrame:
    """A one-row table as (metric, value) text."""
    text = row.select(*[F.col(c).cast("string").alias(c) for c in row.columns])
    return text.unpivot([], row.columns, "metric", "value")


def readiness(sections: Mapping[str, DataFrame | None]) -> DataFrame:
    """Which sections have data. Looks at one row of each."""

    def state(name: str, df: DataFrame) -> DataFrame:
        found = F.when(F.count(F.lit(1)) > 0, "ready").otherwise("missing")
        return df.limit(1).agg(found.alias("status")).select(F.lit(name).alias("section"), "status")

    present = [(name, df) for name, df in sections.items() if df is not None]
    session = present[0][1].sparkSession
    absent = [(name, "missing") for name, df in sections.items() if df is None]
    frames = [state(name, df) for name, df in present]
    if absent:
        frames.append(session.createDataFrame(absent, "section string, status string"))
    return reduce(DataFrame.unionByName, frames)


def headline(summary: DataFrame, events: DataFrame, alerts: DataFrame) -> DataFrame:
    """The dashboard's four figures in one row."""
    return summary.select(
        F.col("row_count").alias("batch_rows"),
        F.col("sum_total_amount").alias("total_revenue"),
        events.select("generated_event_count").scalar().alias("streaming_events"),
        alerts.agg(F.coalesce(F.sum("alert_count"), F.lit(0))).scalar().alias("streaming_alerts"),
    )
