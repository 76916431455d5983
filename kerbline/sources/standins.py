"""The test tables seen as trips, zones and clickstream events (FIXTURES.md, part C)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.functions.expressions import row_count_label
from kerbline.sources.events import encode
from kerbline.sources.reports import SUMMARY_TYPE, TIMING_TYPE

TRIP_YEAR = 1997

EVENT_TYPE_NAMES = {"view": "page_view", "click": "product_view", "signup": "add_to_cart", "purchase": "purchase"}
EVENT_PAGES = {"view": "home", "click": "product", "signup": "cart", "purchase": "checkout"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _twice_when(df: DataFrame, again: Column) -> DataFrame:
    """Rows that satisfy `again` appear a second time, from the same scan."""
    copies = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _twice_when(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") % 97 == 0)
    hour = (F.col("l_orderkey") % 24).cast("int")
    left = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=hour)
    ride = F.make_dt_interval(mins=F.col("l_quantity").cast("int"))
    fare = F.col("l_extendedprice") * (F.lit(0.085) - F.col("l_discount")) / 100
    tip = F.col("l_extendedprice") * F.col("l_tax") / 100
    return items.select(
        (F.col("l_linenumber") % 2 + 1).cast("bigint").alias("VendorID"),
        F.when(F.col("l_partkey") % 211 != 0, left).alias("tpep_pickup_datetime"),
        (left + ride).alias("tpep_dropoff_datetime"),
        F.when(F.col("l_partkey") % 50 != 0, (F.col("l_quantity").cast("int") % 10).cast("double")).alias(
            "passenger_count"
        ),
        (F.col("l_quantity") * 4.2).alias("trip_distance"),
        F.col("l_suppkey").alias("PULocationID"),
        (F.col("l_partkey") % 120).alias("DOLocationID"),
        F.col("l_linenumber").cast("bigint").alias("payment_type"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        (fare + tip).alias("total_amount"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "supplier").where("s_suppkey % 17 <> 3")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return (
        places.join(nations, places["s_nationkey"] == nations["n_nationkey"])
        .join(regions, nations["n_regionkey"] == regions["r_regionkey"])
        .select(
            F.col("s_suppkey").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.concat(F.lit("SZ-"), (F.col("s_nationkey") % 3).cast("string")).alias("service_zone"),
        )
    )


def _named(column: str, names: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for item in names.items() for part in item])[F.col(column)]


def click_columns(events: DataFrame) -> DataFrame:
    """Event rows → clickstream payload columns; `events` may be a stream."""
    moment = F.col("ts").cast("timestamp")
    user = F.col("user_id").cast("string")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        user.alias("user_id"),
        F.concat_ws("-", user, F.date_format(moment, "yyyyMMddHH")).alias("session_id"),
        F.coalesce(_named("event_type", EVENT_TYPE_NAMES), F.col("event_type")).alias("event_type"),
        _named("event_type", EVENT_PAGES).alias("page"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        moment.alias("sent_at"),
        (F.col("value") - 5).alias("total_amount"),
    )


def clicks(spark: SparkSession, sf_dir: str, *, redelivered: bool = False) -> DataFrame:
    """Clickstream payloads; with `redelivered`, some of them twice, as a broker may deliver them."""
    events = table(spark, sf_dir, "events")
    return click_columns(_twice_when(events, F.col("event_id") % 89 == 0) if redelivered else events)


def click_stream(spark: SparkSession, sf_dir: str, *, redelivered: bool = False) -> DataFrame:
    """The events table as an unbounded source, in payload columns."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return click_columns(_twice_when(events, F.col("event_id") % 89 == 0) if redelivered else events)


def envelope(payloads: DataFrame) -> DataFrame:
    """Payloads in the broker's shape."""
    return encode(payloads, "sent_at")


def damaged(payloads: DataFrame) -> DataFrame:
    """The same, where some records carry an unreadable time and some are cut off."""
    number = F.col("event_id").cast("bigint")
    late = F.when(number % 103 == 0, F.lit("yesterday")).otherwise(F.col("timestamp"))
    records = encode(payloads.withColumn("timestamp", late), "sent_at")
    sent = F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("bigint")
    return records.withColumn("value", F.when(sent % 101 == 0, F.substring("value", 1, 20)).otherwise(F.col("value")))


# --- result tables and reports, measured on the tables instead of on a clock ----------------------------------------


def engine_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run results per engine and workload size: return flags stand for engines, line numbers for sizes."""
    items = table(spark, sf_dir, "lineitem")
    engine = F.when(F.col("l_returnflag") == "A", "pandas").when(F.col("l_returnflag") == "R", "pyspark")
    limit = F.when(F.col("l_linenumber") < 7, F.col("l_linenumber").cast("bigint") * 100_000)
    return items.groupBy(
        engine.otherwise("other").alias("engine"), row_count_label(limit).alias("row_limit_label")
    ).agg(
        F.round(F.sum("l_quantity") / 1000, 4).alias("duration_seconds"),
        F.count(F.lit(1)).alias("row_count"),
        F.max("l_orderkey").alias("position"),
    )


def stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish and processing time per day of events; days of the month divisible by 7 lack a publish time."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    return (
        events.groupBy(day.alias("run_day"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("user_id").alias("session_count"),
            (F.count_if(F.col("event_type") == "view") / 1000).alias("_publish"),
            (F.count_if(F.col("event_type") == "click") / 100).alias("processing_seconds"),
        )
        .withColumn("publish_seconds", F.when(F.dayofmonth("run_day") % 7 != 0, F.col("_publish")))
        .drop("_publish")
    )


def stream_reports(event_metrics: DataFrame, funnel: DataFrame, alerts: DataFrame) -> DataFrame:
    """One report document per day from hourly window tables, without the summary fields older reports lack."""
    day = F.to_date("window_start").alias("run_day")
    bounds = [F.col(c).cast("string").alias(c) for c in ("window_start", "window_end")]
    mixes = event_metrics.groupBy(day).agg(
        F.collect_list(F.struct(*bounds, "event_type", "event_count")).alias("event_metrics"),
        F.sum("event_count").alias("_events"),
    )
    windows = funnel.groupBy(day).agg(
        F.collect_list(F.struct(*bounds, "total_sessions", "total_users")).alias("funnel_metrics")
    )
    raised = alerts.groupBy(day).agg(
        F.sort_array(F.collect_list(F.struct("window_start", "alert_count", "severity"))).alias("_alerts")
    )
    joined = mixes.join(windows, "run_day", "left").join(raised, "run_day", "left")
    name = F.concat(F.lit("clicks-"), F.date_format("run_day", "yyyyMMdd"))

    def alert(a: Column) -> Column:
        return F.struct(a["alert_count"].cast("bigint").alias("alert_count"), a["severity"].alias("severity"))

    return joined.select(
        "run_day",
        F.struct(name.alias("query_name"), F.lit(1).cast("bigint").alias("page_view_sessions")).alias("config"),
        F.lit(None).cast(SUMMARY_TYPE).alias("scenario_summary"),
        F.lit(None).cast(TIMING_TYPE).alias("timing"),
        "event_metrics",
        "funnel_metrics",
        F.array(
            F.struct(
                name.alias("query_name"),
                (F.col("_events") / 4).alias("processed_rows_per_second"),
                (F.col("_events") * 1.5).alias("trigger_execution_ms"),
            )
        ).alias("query_progress"),
        F.transform("_alerts", alert).alias("anomaly_alerts"),
    )
