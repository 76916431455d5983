"""Clickstream: parsing, windowed metrics, session funnel, alerts.

Nothing here asks whether a frame is a stream. Distinct counts are approximate by default, as a stream in update mode
needs; `exact=True` counts in two levels, for bounded frames and for streams in append mode.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.expressions import percent
from kerbline.sources.events import EVENT_SCHEMA, FUNNEL_STAGES


@dataclass(frozen=True)
class Windowing:
    """Window length, step between windows, and how late an event may be."""

    duration: str = "5 minutes"
    slide: str = "5 minutes"
    watermark: str = "10 minutes"


@dataclass(frozen=True)
class AlertLimits:
    """When a window is worth an alert."""

    spike_sessions: int = 20
    drop_sessions: int = 2
    min_sessions: int = 5
    min_page_conversion: float = 3.0
    min_cart_conversion: float = 20.0
    z_threshold: float = 2.0
    z_stddev_floor: float = 0.1


# --- parsing --------------------------------------------------------------------------------------------------------


def decode(envelope: DataFrame) -> DataFrame:
    """Broker records → payload columns, broker time and event time; unreadable parts are null, nothing is dropped."""
    payload = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    opened = envelope.select(payload.alias("event"), F.col("timestamp").alias("kafka_timestamp"), "value")
    return (
        opened.select("event.*", "kafka_timestamp", "value")
        .withColumn("event_timestamp", F.try_to_timestamp("timestamp"))
        .drop("timestamp")
    )


def parse(envelope: DataFrame) -> DataFrame:
    """Events with a readable time."""
    return decode(envelope).where(F.col("event_timestamp").isNotNull()).drop("value")


def rejects(envelope: DataFrame) -> DataFrame:
    """Records `parse` leaves out, as they came, for a quarantine table."""
    return (
        decode(envelope)
        .where(F.col("event_timestamp").isNull())
        .select(F.col("value").cast("string").alias("value"), "kafka_timestamp")
    )


# --- windows --------------------------------------------------------------------------------------------------------


FUNNEL_COUNTS = ("total_sessions", "total_users", *[f"{stage}_sessions" for stage in FUNNEL_STAGES])


def bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def window(shape: Windowing) -> Column:
    return F.window("event_timestamp", shape.duration, shape.slide)


def event_metrics(events: DataFrame, shape: Windowing = Windowing(), *, exact: bool = False) -> DataFrame:
    """Events, users and sessions per window and event type."""
    if exact:
        return _exact_event_metrics(events, shape)
    return (
        events.withWatermark("event_timestamp", shape.watermark)
        .groupBy(window(shape), "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("user_id").alias("approx_unique_users"),
            F.approx_count_distinct("session_id").alias("approx_unique_sessions"),
        )
        .select(*bounds(), "event_type", "event_count", "approx_unique_users", "approx_unique_sessions")
    )


def funnel(events: DataFrame, shape: Windowing = Windowing(), *, exact: bool = False) -> DataFrame:
    """Sessions and users per window, sessions that reached each stage, and the rates between stages.

    Stages are independent: a rate may exceed 100 when sessions skip a stage inside the window.
    """
    if exact:
        return with_rates(_exact_stage_counts(events, shape))
    session = F.col("session_id")
    counted = (
        events.withWatermark("event_timestamp", shape.watermark)
        .groupBy(window(shape))
        .agg(
            F.approx_count_distinct(session).alias("total_sessions"),
            F.approx_count_distinct("user_id").alias("total_users"),
            *[
                F.approx_count_distinct(F.when(F.col("event_type") == stage, session)).alias(f"{stage}_sessions")
                for stage in FUNNEL_STAGES
            ],
        )
    )
    return with_rates(counted.select(*bounds(), *FUNNEL_COUNTS))


def with_rates(counts: DataFrame) -> DataFrame:
    """Stage-to-stage percentages, null where nobody reached the earlier stage. Unrounded."""

    def between(earlier: str, later: str) -> Column:
        return percent(F.col(f"{later}_sessions"), F.col(f"{earlier}_sessions"))

    return counts.withColumns(
        {
            "page_to_product_rate": between("page_view", "product_view"),
            "product_to_cart_rate": between("product_view", "add_to_cart"),
            "cart_to_purchase_rate": between("add_to_cart", "purchase"),
            "page_to_purchase_rate": between("page_view", "purchase"),
        }
    )


def _per_member(events: DataFrame, shape: Windowing, extra: tuple[str, ...], *aggregates: Column) -> DataFrame:
    """One row per window and session, and one per window and user (`_who`), in one shuffle.

    The first level of exact distinct counting: members are unique afterwards, so the second level only counts rows.
    It combines on the map side; a window or session that holds a large share of the events is no heavier to shuffle.
    On a stream the two levels are two stateful steps, which Spark allows in append mode.
    """
    shaped = events.withWatermark("event_timestamp", shape.watermark).select(
        window(shape).alias("window"), "session_id", "user_id", "event_type"
    )
    keys = ["window", *extra]
    by = [[*keys, "session_id"], [*keys, "user_id"]]
    return (
        shaped.groupingSets(by, *keys, "session_id", "user_id")
        .agg((F.grouping("user_id") == 1).alias("_by_session"), *aggregates)
        .withColumn("_known", F.coalesce("session_id", "user_id").isNotNull())
    )


def _exact_event_metrics(events: DataFrame, shape: Windowing) -> DataFrame:
    members = _per_member(events, shape, ("event_type",), F.count(F.lit(1)).alias("_events"))
    session = F.col("_by_session")
    counted = members.groupBy("window", "event_type").agg(
        F.sum(F.when(session, F.col("_events"))).alias("event_count"),
        F.count_if(~session & F.col("_known")).alias("unique_users"),
        F.count_if(session & F.col("_known")).alias("unique_sessions"),
    )
    return counted.select(*bounds(), "event_type", "event_count", "unique_users", "unique_sessions")


def _exact_stage_counts(events: DataFrame, shape: Windowing) -> DataFrame:
    reached = [
        F.max(F.coalesce(F.col("event_type") == stage, F.lit(False))).alias(f"_{stage}") for stage in FUNNEL_STAGES
    ]
    members = _per_member(events, shape, (), *reached)
    session = F.col("_by_session") & F.col("_known")
    counted = members.groupBy("window").agg(
        F.count_if(session).alias("total_sessions"),
        F.count_if(~F.col("_by_session") & F.col("_known")).alias("total_users"),
        *[F.count_if(session & F.col(f"_{stage}")).alias(f"{stage}_sessions") for stage in FUNNEL_STAGES],
    )
    return counted.select(*bounds(), *FUNNEL_COUNTS)


# --- alerts ---------------------------------------------------------------------------------------------------------

SPIKE = "traffic_spike"
DROP = "traffic_drop"
LOW_CONVERSION = "low_purchase_conversion"
CART_RISK = "cart_abandonment_risk"


def alert_types(limits: AlertLimits, z: Column | None = None) -> Column:
    """Names of the alerts a funnel row raises.

    Where a z-score is known it decides about traffic; the fixed session limits decide where it is not.
    """
    total = F.col("total_sessions")
    spike = total >= limits.spike_sessions
    drop = (total > 0) & (total <= limits.drop_sessions)
    if z is not None:
        spike = F.when(z.isNotNull(), z >= limits.z_threshold).otherwise(spike)
        drop = F.when(z.isNotNull(), z <= -limits.z_threshold).otherwise(drop)

    def poor(base: str, rate: str, least: float) -> Column:
        return (F.col(base) >= limits.min_sessions) & (F.coalesce(F.col(rate), F.lit(0.0)) < least)

    raised = (
        (SPIKE, spike),
        (DROP, drop),
        (LOW_CONVERSION, poor("page_view_sessions", "page_to_purchase_rate", limits.min_page_conversion)),
        (CART_RISK, poor("add_to_cart_sessions", "cart_to_purchase_rate", limits.min_cart_conversion)),
    )
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in raised]))


def severity(alerts: Column) -> Column:
    return (
        F.when(F.array_contains(alerts, SPIKE) | F.array_contains(alerts, LOW_CONVERSION), "high")
        .when(F.array_contains(alerts, CART_RISK), "medium")
        .otherwise("low")
    )


def raise_alerts(rows: DataFrame, limits: AlertLimits, z: Column | None = None) -> DataFrame:
    """Rows with at least one alert, with its names, their number and the severity."""
    named = rows.withColumn("alert_types", alert_types(limits, z))
    return (
        named.withColumn("alert_count", F.size("alert_types"))
        .where(F.col("alert_count") > 0)
        .withColumn("severity", severity(F.col("alert_types")))
    )


ALERT_COLUMNS = (
    "window_start",
    "window_end",
    "total_sessions",
    "page_view_sessions",
    "add_to_cart_sessions",
    "purchase_sessions",
    "page_to_purchase_rate",
    "cart_to_purchase_rate",
)


def alerts(funnel_rows: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Rule-based alerts of a funnel table or stream."""
    raised = raise_alerts(funnel_rows, limits)
    return raised.select(*ALERT_COLUMNS, "alert_types", "alert_count", "severity")


# --- reports over window tables -------------------------------------------------------------------------------------


def latest_window(rows: DataFrame) -> DataFrame:
    """The row of the last window. An aggregate, not a sort: each task keeps one row."""
    order = F.coalesce("window_end", "window_start")
    return rows.agg(F.max_by(F.struct(*rows.columns), order).alias("row")).where("row is not null").select("row.*")


def latest_event_mix(metrics: DataFrame) -> DataFrame:
    """Events per type in the last window of an event-metrics table."""
    last = metrics.agg(F.max("window_end")).scalar()
    return (
        metrics.where(F.col("window_end") == last)
        .groupBy("event_type")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy("event_type")
    )


def funnel_stages(rows: DataFrame) -> DataFrame:
    """The last window as (stage, sessions)."""
    named = latest_window(rows).select(*[F.col(f"{stage}_sessions").alias(stage) for stage in FUNNEL_STAGES])
    return named.unpivot([], list(FUNNEL_STAGES), "stage", "sessions")


def event_totals(events: DataFrame) -> DataFrame:
    """Events, sessions and users over everything."""
    return events.agg(
        F.count(F.lit(1)).alias("generated_event_count"),
        F.countDistinct("session_id").alias("generated_session_count"),
        F.countDistinct("user_id").alias("generated_user_count"),
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count")).orderBy("event_type")
