"""Every operator as a query over the test tables: name → (spark, table folder) → DataFrame.

Results are shown in plain types (text for times and arrays, rounded doubles), so that another engine can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.functions.expressions import rate
from kerbline.operators import baseline, clicks, layout, metrics, quality, sketches, trips, versions
from kerbline.operators.clicks import Windowing
from kerbline.plans import batch, marts, trip_tables
from kerbline.session import settle, shared_dir
from kerbline.sources import reports, sinks, standins, tables, trip_files
from kerbline.streaming import jobs, pipeline

Query = Callable[[SparkSession, str], DataFrame]

HOURS = Windowing("1 hour", "1 hour", "10 minutes")
QUARTERS = Windowing("15 minutes", "15 minutes", "10 minutes")
HALF_DAYS = Windowing("12 hours", "12 hours", "10 minutes")
SLIDING = Windowing("1 hour", "15 minutes", "10 minutes")
LIMITS = quality.Limits(pickup_year=standins.TRIP_YEAR)
AS_OF = datetime(1998, 6, 1)
STARTUP_SECONDS = 9.127

_QUERIES: dict[str, Query] = {}
_DIGITS: dict[str, int] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def row_query(build: Query) -> Query:
    """A query of single rows: amounts keep all their decimals."""
    _DIGITS[build.__name__] = 8
    return query(build)


def all_queries() -> dict[str, Query]:
    return {name: _shown(build, _DIGITS.get(name, 4)) for name, build in _QUERIES.items()}


def _plain(field: T.StructField, digits: int) -> Column:
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(kind, T.ArrayType):
        return F.array_join(column, ",")
    if isinstance(kind, T.DoubleType):
        return F.round(column, 2 if field.name.startswith("sum_") else digits)
    return column


def _shown(build: Query, digits: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = build(spark, sf_dir)
        return df.select(*[_plain(field, digits).alias(field.name) for field in df.schema.fields])

    return run


# --- trips ----------------------------------------------------------------------------------------------------------


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip with a pickup time."""
    return trips.prepare(standins.trips(spark, sf_dir))


def _year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.in_year(_dated(spark, sf_dir), standins.TRIP_YEAR)


def _undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.prepare(standins.trips(spark, sf_dir), keep_undated=True)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules know the pickup place only."""
    zones = settle(standins.zones(spark, sf_dir), "zones")
    return quality.summary(trips.attach_zones(_undated(spark, sf_dir), zones, ends=["pickup"]), LIMITS)


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, zones = _undated(spark, sf_dir), settle(standins.zones(spark, sf_dir), "zones")
    return quality.flag(trips.attach_zones(quality.mark_duplicates(prepared), zones), LIMITS, duplicates=False)


def _by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = trip_tables.rollup(_dated(spark, sf_dir), [trip_tables.PLACE])
    return trip_tables.by_zone(rolled, standins.zones(spark, sf_dir))


@row_query
def trips_enriched(spark, sf_dir):
    """The year's trips with place names, labels and tip shares."""
    named = trips.attach_zones(_year(spark, sf_dir), standins.zones(spark, sf_dir))
    places = [f"{end}_{part}" for end in ("pickup", "dropoff") for part in ("borough", "zone", "service_zone")]
    return named.select(
        "pickup_ts", "pickup_date", "pickup_hour", "PULocationID", "DOLocationID", *places,
        "payment_type_label", "passenger_count", "trip_distance", "fare_amount", "tip_ratio", "tip_pct",
    )


@query
def trip_summary(spark, sf_dir):
    """A1 from partial rows per day and per place."""
    rolled = trip_tables.rollup(_dated(spark, sf_dir), [trip_tables.DAY, trip_tables.PLACE])
    return trip_tables.summary(rolled, standins.zones(spark, sf_dir), days=trip_tables.DAY)


@query
def trips_hourly(spark, sf_dir):
    """A2."""
    return metrics.hourly(_dated(spark, sf_dir))


@query
def trips_by_borough(spark, sf_dir):
    """A3: trips are grouped by place id before the zones join."""
    rolled = trip_tables.rollup(_dated(spark, sf_dir), [trip_tables.PLACE])
    return trip_tables.by_borough(rolled, standins.zones(spark, sf_dir))


@query
def trips_by_zone(spark, sf_dir):
    """A4."""
    return _by_zone(spark, sf_dir)


@query
def payment_tip_summary(spark, sf_dir):
    """A5."""
    return metrics.by_payment(_dated(spark, sf_dir))


@query
def trip_suite(spark, sf_dir):
    """A1-A5 from one scan, as one long table."""
    built = trip_tables.all_tables(standins.trips(spark, sf_dir), standins.zones(spark, sf_dir), standins.TRIP_YEAR)
    keys = {
        "summary": F.lit(""),
        "hourly": F.concat_ws(" ", F.date_format("pickup_date", "yyyy-MM-dd"), F.format_string("%02d", "pickup_hour")),
        "borough_summary": F.col("pickup_borough"),
        "zone_summary": F.concat_ws("/", "pickup_borough", "pickup_zone", "pickup_service_zone"),
        "payment_tip_summary": F.concat_ws("/", F.col("payment_type").cast("string"), "payment_type_label"),
    }
    measures = ("sum_total_amount", "avg_passenger_count", "avg_trip_distance", "avg_tip_pct", "tip_to_fare_pct")
    parts = [
        built[name].select(
            F.lit(name).alias("table_name"),
            key.alias("row_key"),
            F.col("row_count" if name == "summary" else "trip_count").alias("trips"),
            *[m for m in measures if m in built[name].columns],
        )
        for name, key in keys.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@query
def top10_zones(spark, sf_dir):
    """O7."""
    return metrics.top(_by_zone(spark, sf_dir), "sum_total_amount", 10)


@query
def top_payment_tip_share(spark, sf_dir):
    """O7 on the payment table."""
    shares = metrics.top(metrics.by_payment(_dated(spark, sf_dir)), "tip_to_fare_pct", 10)
    return shares.select("payment_type_label", "payment_type", "tip_to_fare_pct")


@query
def hourly_series(spark, sf_dir):
    """O10."""
    return metrics.hour_series(metrics.hourly(_dated(spark, sf_dir))).select("hour_bucket", "trip_count")


@query
def summary_transpose(spark, sf_dir):
    """M9."""
    shown = metrics.summary(_dated(spark, sf_dir)).select("row_count", "active_days", "min_pickup_ts", "max_pickup_ts")
    return marts.transposed(shown)


@row_query
def first_trips(spark, sf_dir):
    """A row limit that picks the same rows every time."""
    key = ("pickup_ts", "PULocationID", "DOLocationID", "fare_amount")
    chosen = tables.first_rows(_dated(spark, sf_dir), 500, key)
    return chosen.select(*key, "total_amount")


# --- trip quality ---------------------------------------------------------------------------------------------------


@query
def dq_summary(spark, sf_dir):
    """DQ1-DQ9 A6 in one shuffle."""
    return _summary(spark, sf_dir)


@query
def dq_summary_audited(spark, sf_dir):
    """DQ1-DQ9 A6 W1: the summary observed while the repeated signatures are written."""
    zones = settle(standins.zones(spark, sf_dir), "zones")
    return quality.audit(trips.attach_zones(_undated(spark, sf_dir), zones, ends=["pickup"]), LIMITS)[0]


@query
def dq_summary_observed(spark, sf_dir):
    """DQ12 A6 K4: the summary observed while the issue rows are written; no scan of its own."""
    watch = Observation("flags")
    flagged = _flagged(spark, sf_dir)
    issues = quality.issue_rows(quality.observed_flags(flagged, watch))
    sinks.write_issue_rows(issues, shared_dir(spark, "issues"))
    return quality.observed_summary(watch, quality.flag_counts(flagged))


@query
def dq_issue_histogram(spark, sf_dir):
    """A12."""
    return quality.issue_histogram(_summary(spark, sf_dir))


@query
def dq_issue_report(spark, sf_dir):
    """A12 with its totals: one report from one summary."""
    report = quality.issue_report(_summary(spark, sf_dir))
    listed = F.transform(F.map_entries("issue_types"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return report.withColumn("issue_types", F.array_sort(listed))


@row_query
def dq_issue_rows(spark, sf_dir):
    """DQ12 W1 P8: every row with an issue."""
    return quality.issue_rows(_flagged(spark, sf_dir))


@row_query
def dq_worst_rows(spark, sf_dir):
    """The rows with most issues."""
    return quality.worst_first(quality.issue_rows(_flagged(spark, sf_dir)), 200)


@query
def dq_issue_combinations(spark, sf_dir):
    """DQ12: which issues occur together."""
    flagged = _flagged(spark, sf_dir)
    return flagged.groupBy("dq_issue_names", "dq_issue_count").agg(F.count(F.lit(1)).alias("rows"))


@row_query
def dq_duplicates(spark, sf_dir):
    """DQ9: repeated signatures."""
    return quality.duplicate_signatures(trips.prepare(standins.trips(spark, sf_dir)))


@query
def dq_future_ts(spark, sf_dir):
    """DQ13."""
    return quality.summary(_undated(spark, sf_dir), quality.Limits(as_of=AS_OF)).select("total_rows", "no_future_trip_datetime_rows")


@query
def batch_job(spark, sf_dir):
    """The whole job from files to files, and what its seven outputs hold. Trips lie in two
    folders; the zone CSV repeats some ids and has `N/A` as a name."""
    base = shared_dir(spark, "batch-job")
    taken = standins.trips(spark, sf_dir)
    for folder, rest in (("early", 0), ("late", 1)):
        taken.where(F.col("payment_type") % 2 == rest).write.parquet(f"{base}/trips/{folder}")
    zones = standins.zones(spark, sf_dir).withColumn(
        "Zone", F.when(F.col("LocationID") % 17 == 5, "N/A").otherwise(F.col("Zone"))
    )
    again = zones.where(F.col("LocationID") % 3 == 0)
    zones.unionByName(again).write.option("header", True).csv(f"{base}/zones")
    batch.run(spark, f"{base}/trips", f"{base}/zones", f"{base}/out", limits=LIMITS)
    shown = {
        "summary": ("row_count", "sum_total_amount"),
        "hourly": ("trip_count", "sum_total_amount"),
        "borough_summary": ("trip_count", "sum_total_amount"),
        "zone_summary": ("trip_count", "sum_total_amount"),
        "payment_tip_summary": ("trip_count", "sum_total_amount"),
        "quality_summary": ("total_rows", None),
        "quality_issue_rows": (None, "total_amount"),
    }
    parts = []
    for name, (trips_, amount) in shown.items():
        found = spark.read.parquet(f"{base}/out/{name}")
        parts.append(
            found.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("table_rows"),
                F.sum(F.col(trips_) if trips_ else F.lit(1)).alias("trips"),
                F.sum(F.col(amount) if amount else F.lit(None).cast("double")).alias("sum_amount"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# --- clickstream ----------------------------------------------------------------------------------------------------


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.parse(standins.envelope(standins.clicks(spark, sf_dir)))


def _funnel(spark: SparkSession, sf_dir: str, shape: Windowing = HOURS) -> DataFrame:
    return clicks.funnel(_clicks(spark, sf_dir), shape, exact=True)


def _metrics(spark: SparkSession, sf_dir: str, shape: Windowing = HOURS) -> DataFrame:
    return clicks.event_metrics(_clicks(spark, sf_dir), shape, exact=True)


@query
def event_json_roundtrip(spark, sf_dir):
    """K9 ST1 P9: encode as the broker carries it, and parse again."""
    return _clicks(spark, sf_dir)


@query
def click_rejects(spark, sf_dir):
    """Records without a readable time, kept aside."""
    left_out = clicks.rejects(standins.damaged(standins.clicks(spark, sf_dir)))
    return left_out.select("kafka_timestamp", F.get_json_object("value", "$.page").alias("page_of_readable_json"))


@query
def click_dq_report(spark, sf_dir):
    """A11 DQ10 DQ11."""
    return quality.event_report(standins.clicks(spark, sf_dir), amounts=("total_amount",))


@query
def click_dq_missing_fields(spark, sf_dir):
    """DQ10: which required fields are missing together."""
    events = standins.clicks(spark, sf_dir)
    named = events.withColumn("missing_fields", quality.missing_fields(columns=events.columns))
    return named.groupBy("missing_fields").agg(F.count(F.lit(1)).alias("rows"))


@query
def click_negative_values(spark, sf_dir):
    """DQ11: the negative fields of a record with their values."""
    events = standins.clicks(spark, sf_dir)
    found = events.withColumn("negative", quality.negative_values(("total_amount",)))
    return found.where(F.size("negative") > 0).select(
        "event_id", F.map_keys("negative").alias("fields"), F.map_values("negative")[0].alias("value")
    )


@query
def click_duplicate_ids(spark, sf_dir):
    """DQ14 on a table."""
    return quality.repeated_ids(standins.clicks(spark, sf_dir, redelivered=True))


@query
def click_window_metrics(spark, sf_dir):
    """ST3 A8, tumbling, exact."""
    return _metrics(spark, sf_dir)


@query
def click_window_sliding(spark, sf_dir):
    """ST3, sliding, exact."""
    return _metrics(spark, sf_dir, SLIDING)


@query
def click_window_approx(spark, sf_dir):
    """ST3 as the stream computes it: approximate distinct counts, which do not change when events come twice."""
    keys, counts = ["window_start", "window_end", "event_type"], ["approx_unique_users", "approx_unique_sessions"]
    once = clicks.event_metrics(_clicks(spark, sf_dir), HOURS)
    again = clicks.parse(standins.envelope(standins.clicks(spark, sf_dir, redelivered=True)))
    twice = clicks.event_metrics(again, HOURS).select(*keys, *[F.col(c).alias(f"_{c}") for c in counts])
    same = [(F.col(c) == F.col(f"_{c}")).alias(f"{c.removeprefix('approx_')}_same") for c in counts]
    return once.join(twice, keys).select(*keys, "event_count", *same)


def _sketched(spark: SparkSession, sf_dir: str, shape: Windowing) -> DataFrame:
    """Sketches per window, stored."""
    return settle(sketches.window_sketches(_clicks(spark, sf_dir), shape), "window-sketches")


@query
def click_days_from_hours(spark, sf_dir):
    """ST4 A9: a day's funnel from the stored sketches of its hours."""
    return sketches.counted(sketches.rewindowed(_sketched(spark, sf_dir, HOURS), "1 day"), ["event_count"])


@query
def click_sliding_from_quarters(spark, sf_dir):
    """ST3 ST4: hours that slide by a quarter, from the stored sketches of quarters."""
    return sketches.counted(sketches.rewindowed(_sketched(spark, sf_dir, QUARTERS), "1 hour", "15 minutes"))


@query
def click_skipped_stages(spark, sf_dir):
    """Sessions of a day that reached a stage without the one before it, by sketch difference."""
    return sketches.skipped(sketches.rewindowed(_sketched(spark, sf_dir, HOURS), "1 day"))


@query
def click_funnel(spark, sf_dir):
    """ST4 A9, exact."""
    return _funnel(spark, sf_dir)


@query
def funnel_rate_report(spark, sf_dir):
    """2.9 rate: a report's rates, at four decimals, null without anyone in the earlier stage."""
    rows = _funnel(spark, sf_dir)

    def between(earlier: str, later: str) -> Column:
        return rate(F.col(f"{later}_sessions"), F.col(f"{earlier}_sessions")).alias(f"{earlier}_to_{later}")

    return rows.select("window_start", *[between(*step) for step in sketches.STAGE_STEPS], between("page_view", "purchase"))


@query
def click_alerts(spark, sf_dir):
    """ST5 ST6."""
    return clicks.alerts(_funnel(spark, sf_dir))


@query
def click_totals(spark, sf_dir):
    """A13."""
    return clicks.event_totals(_clicks(spark, sf_dir))


@query
def click_type_counts(spark, sf_dir):
    """The type histogram."""
    return clicks.event_type_counts(_clicks(spark, sf_dir))


@query
def event_mix_latest(spark, sf_dir):
    """A15."""
    return clicks.latest_event_mix(settle(_metrics(spark, sf_dir), "event-metrics"))


@query
def funnel_unpivot(spark, sf_dir):
    """W2 M8."""
    return clicks.funnel_stages(_funnel(spark, sf_dir))


@query
def traffic_zscore(spark, sf_dir):
    """Every window against the twelve before it."""
    scored = baseline.rolling_baseline(settle(_funnel(spark, sf_dir), "funnel"))
    return scored.select(
        "window_start", "total_sessions", "baseline_window_count", "baseline_session_mean",
        "baseline_session_stddev", "traffic_z_score",
    )


@query
def traffic_zscore_recent(spark, sf_dir):
    """W3 ST7 by time: event counts per type against the six hours before, on series with gaps."""
    counts = settle(_metrics(spark, sf_dir, QUARTERS).select("window_start", "event_type", "event_count"), "event-metrics")
    return baseline.recent_baseline(counts, seconds=6 * 3600, value="event_count", series=["event_type"])


@query
def zscore_alerts(spark, sf_dir):
    """ST7 for every window."""
    return baseline.z_alerts(baseline.rolling_baseline(settle(_funnel(spark, sf_dir), "funnel")))


@query
def zscore_alerts_latest(spark, sf_dir):
    """ST8: the alert of the last half day against the twelve before it, at a sensitive threshold."""
    scored = baseline.rolling_baseline(settle(_funnel(spark, sf_dir, HALF_DAYS), "funnel"))
    return baseline.latest_z_alert(scored, clicks.AlertLimits(z_threshold=0.8))


@query
def traffic_baseline(spark, sf_dir):
    """A14."""
    return baseline.baseline_stats(_funnel(spark, sf_dir))


# --- streams --------------------------------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.parse(standins.envelope(standins.click_stream(spark, sf_dir)))


def _to_files(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over all its input into parquet files and read them."""
    spark = df.sparkSession
    base = shared_dir(spark, name)
    jobs.drain([jobs.start(df, name, sink="parquet", output=base, checkpoints=f"{base}/checkpoints")])
    return spark.read.schema(df.schema).parquet(f"{base}/{name}")


@query
def stream_window_append(spark, sf_dir):
    """ST2 ST3 ST9 ST11 ST14 ST15 K8: windows the watermark has closed."""
    closed = _to_files(clicks.event_metrics(_stream(spark, sf_dir), HOURS), "window_append")
    return closed.select("window_start", "window_end", "event_type", "event_count")


@query
def stream_memory(spark, sf_dir):
    """The same into a table in memory."""
    name = f"window_memory_{uuid.uuid4().hex}"
    closed = clicks.event_metrics(_stream(spark, sf_dir), HOURS)
    checkpoints = shared_dir(spark, "memory")
    jobs.drain([jobs.start(closed, name, sink="memory", checkpoints=checkpoints, mode="append")])
    return jobs.memory_rows(spark, name).select("window_start", "window_end", "event_type", "event_count")


ROUNDS = 6


def _rounds(spark: SparkSession, sf_dir: str, base: str, *, damaged: bool = False) -> Iterator[DataFrame]:
    """The events in six parts by time, each written to a folder with all its partitions; some come two parts late. After
    each part the folder as a stream of broker records. An empty table has no part."""
    events = standins.table(spark, sf_dir, "events")
    moment = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(moment), F.max(moment)).head()
    if first is None:
        return
    own = F.floor((moment - first) / F.lit((last - first) // ROUNDS + 1)).cast("int")
    late = (F.col("event_id") % 37 == 0) & (own < ROUNDS - 2)
    part = F.when(late, own + 2).otherwise(own)
    events.withColumn("part", part).write.partitionBy("part").parquet(f"{base}/parts")
    placed = spark.read.schema(events.schema).parquet(f"{base}/parts")
    for k in range(ROUNDS):
        placed.where(F.col("part") == k).drop("part").write.mode("append").parquet(f"{base}/source")
        records = standins.click_columns(spark.readStream.schema(events.schema).parquet(f"{base}/source"))
        yield standins.damaged(records) if damaged else standins.envelope(records)


def _late_run(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    """The job over late events, which stops after every part and goes on from its checkpoint: its folder, the windows it
    has written, and its updates."""
    base = shared_dir(spark, "restart")
    counts = clicks.event_metrics(_clicks(spark, sf_dir), HOURS).limit(0)
    updates = spark.createDataFrame([], jobs.LOG_SCHEMA)
    for k, envelope in enumerate(_rounds(spark, sf_dir, base)):
        log = jobs.ProgressLog(spark, f"{base}/updates", ["late"])
        counts = clicks.event_metrics(clicks.parse(envelope), HOURS)
        jobs.drain([jobs.start(counts, "late", sink="parquet", output=base, checkpoints=f"{base}/checkpoints")])
        updates = log.close()
    columns = ["window_start", "window_end", "event_type", "event_count"]
    written = spark.read.schema(counts.schema).parquet(f"{base}/late") if counts.isStreaming else counts
    return base, written.select(*columns), updates


@query
def stream_restart(spark, sf_dir):
    """ST13 ST14: six parts, a run each; some events come two parts late; each run goes on from the checkpoint."""
    return _late_run(spark, sf_dir)[1]


@query
def stream_open_windows(spark, sf_dir):
    """ST15: windows that were written next to those still open, read from the query's state."""
    base, closed, updates = _late_run(spark, sf_dir)
    states = closed.withColumn("state", F.lit("closed"))
    if updates.isEmpty():
        return states
    held = jobs.open_groups(spark, f"{base}/checkpoints/late")
    found = held.select(*clicks.bounds(), "event_type", F.col("count").alias("event_count"), F.lit("open").alias("state"))
    return states.unionByName(found)


@query
def stream_dropped_rows(spark, sf_dir):
    """ST14: what came too late: groups of window and type as the state operator counts them, and events, which are those
    read that no window has, closed or open."""
    base, closed, updates = _late_run(spark, sf_dir)
    if updates.isEmpty():
        return updates.select("dropped_groups", F.lit(0).cast("long").alias("dropped_events"))
    per_batch = updates.groupBy("batch_id").agg(F.max("dropped_groups").alias("groups"), F.max("num_input_rows").alias("read"))
    held = jobs.open_groups(spark, f"{base}/checkpoints/late").select(F.col("count").alias("event_count"))
    counted = closed.select("event_count").unionByName(held).agg(F.sum("event_count")).scalar()
    totals = per_batch.agg(F.sum("groups").alias("dropped_groups"), F.sum("read").alias("_read"))
    return totals.select("dropped_groups", (F.col("_read") - counted).alias("dropped_events"))


@query
def stream_funnel_append(spark, sf_dir):
    """ST4 with exact counts, in two stateful steps."""
    return _to_files(clicks.funnel(_stream(spark, sf_dir), HOURS, exact=True), "funnel_append")


@query
def stream_alerts(spark, sf_dir):
    """ST5 over the closed windows of the exact stream funnel."""
    return clicks.alerts(_to_files(clicks.funnel(_stream(spark, sf_dir), HOURS, exact=True), "alert_funnel"))


@query
def stream_funnel_update(spark, sf_dir):
    """ST4 ST10: the whole job in update mode; current windows with their counts, rates and scores."""
    outputs = pipeline.Outputs(shared_dir(spark, "clickstream"))
    jobs.drain(pipeline.start_all(standins.damaged(standins.click_stream(spark, sf_dir)), outputs, shape=HOURS))
    return pipeline.scored_windows(spark, outputs.windows).drop(*sketches.SKETCHES)


LATE_HOURS = Windowing("1 hour", "1 hour", "15 days")


@query
def stream_alerts_update(spark, sf_dir):
    """ST7 ST8 ST10: the alerts that hold after six runs of the job, when events two parts late have raised, replaced and
    withdrawn some."""
    base = shared_dir(spark, "alerts")
    outputs = pipeline.Outputs(base)
    for envelope in _rounds(spark, sf_dir, base, damaged=True):
        jobs.drain(pipeline.start_all(envelope, outputs, shape=LATE_HOURS))
    return pipeline.current_alerts(spark, outputs.alerts)


@query
def stream_dq_report(spark, sf_dir):
    """A11 on a stream: records, incomplete ones and negative amounts, observed while the records are written."""
    base = shared_dir(spark, "observed")
    events = standins.click_stream(spark, sf_dir)
    watched = events.observe("records", *quality.event_counts(events.columns, amounts=("total_amount",)))
    log = jobs.ProgressLog(spark, f"{base}/updates", ["observed"])
    jobs.drain([jobs.start(watched, "observed", sink="parquet", output=base, checkpoints=f"{base}/checkpoints")])
    names = ("total_records", "missing_required_rows", "negative_value_rows")
    seen = jobs.observed(log.close(), "records", ", ".join(f"{name} long" for name in names))
    return seen.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])


@query
def stream_rejects(spark, sf_dir):
    """P15 on a stream: records as they came, those without a readable time and those cut off."""
    left_out = clicks.rejects(standins.damaged(standins.click_stream(spark, sf_dir)))
    kept = _to_files(left_out, "rejects")
    return kept.select("kafka_timestamp", *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("event_id", "timestamp")])


@query
def stream_first_delivery(spark, sf_dir):
    """DQ14 on a stream: redeliveries are dropped."""
    events = clicks.parse(standins.envelope(standins.click_stream(spark, sf_dir, redelivered=True)))
    return _to_files(quality.first_delivery(events, within="1 hour"), "unique").select("event_id", "event_timestamp")


@query
def stream_progress(spark, sf_dir):
    """ST12 A17: input rows and number of batches per query."""
    base = shared_dir(spark, "progress")
    log = jobs.ProgressLog(spark, f"{base}/updates", ["watched"])
    started = jobs.start(
        clicks.event_metrics(_stream(spark, sf_dir), HOURS), "watched", sink="parquet", output=base, checkpoints=base
    )
    jobs.drain([started])
    return log.close().groupBy("query_name").agg(F.sum("num_input_rows").alias("input_rows"))


# --- layouts and versions -------------------------------------------------------------------------------------------

LAYOUTS = {
    layout.BASELINE_LAYOUT: (),
    "by_month": ("ship_month",),
    "by_month_flag": ("ship_month", "l_returnflag"),
}
WANTED = {"ship_month": "1997-03", "l_returnflag": "A"}


def _layouts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    items = standins.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice").alias("total_amount"), "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM").alias("ship_month"),
    )
    paths = layout.write_layouts(items, shared_dir(spark, "layouts"), LAYOUTS)
    return {name: layout.read_layout(spark, path, items.schema) for name, path in paths.items()}


@query
def layout_pruned_query(spark, sf_dir):
    """The same question to three layouts."""
    found = [
        layout.matched(df, WANTED).select(F.lit(name).alias("layout"), *WANTED, "matched_rows", "sum_total_amount")
        for name, df in _layouts(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def layout_improvement(spark, sf_dir):
    """V10 J4, with rows to scan as the cost."""
    costs = [
        layout.scanned_rows(df, WANTED, LAYOUTS[name]).select(F.lit(name).alias("layout"), "scanned_rows")
        for name, df in _layouts(spark, sf_dir).items()
    ]
    return layout.improvement(reduce(DataFrame.unionByName, costs), "scanned_rows")


@query
def layout_timing(spark, sf_dir):
    """Repeated measurements per layout; return flags stand for layouts, line numbers for runs."""
    items = standins.table(spark, sf_dir, "lineitem")
    runs = items.groupBy(F.col("l_returnflag").alias("layout"), "l_linenumber").agg(
        (F.sum("l_quantity") / 1000).alias("seconds")
    )
    return layout.timing_summary(runs)


def _versions(spark: SparkSession, sf_dir: str) -> str:
    """Orders committed in three steps by date; the priority column appears with the second."""
    orders = standins.table(spark, sf_dir, "orders")
    base = shared_dir(spark, "orders-table")
    steps = (
        orders.where("o_orderdate < '1997-01-01'").drop("o_orderpriority"),
        orders.where("o_orderdate >= '1997-01-01' and o_orderdate < '1998-01-01'"),
        orders.where("o_orderdate >= '1998-01-01'"),
    )
    for step in steps:
        versions.commit(step, base)
    return base


@query
def version_as_of(spark, sf_dir):
    """V2 V3: the first version, with the columns it had."""
    return versions.as_of(spark, _versions(spark, sf_dir), 0)


@query
def schema_evolved_read(spark, sf_dir):
    """The latest version, old rows null in the new column."""
    return versions.as_of(spark, _versions(spark, sf_dir))


@query
def schema_diff(spark, sf_dir):
    """V4 U3 P18."""
    base = _versions(spark, sf_dir)
    return versions.schema_change(versions.as_of(spark, base, 0), versions.as_of(spark, base))


@query
def version_history(spark, sf_dir):
    """V7 O9, after a compaction."""
    base = _versions(spark, sf_dir)
    versions.compact(spark, base)
    return versions.history(spark, base).select("version", "operation", "replaces", "num_rows")


@query
def version_compare(spark, sf_dir):
    """V8 A19."""
    return versions.compare_versions(spark, _versions(spark, sf_dir), [0, 1, 2])


@query
def migrate_reconcile(spark, sf_dir):
    """A partitioned copy and its checksum."""
    target = shared_dir(spark, "migrated")
    return versions.migrate(spark, f"{sf_dir}/orders.parquet", target, partition_by=["o_orderstatus"])


@query
def compact_files(spark, sf_dir):
    """V5: fewer files, the same rows."""
    base = _versions(spark, sf_dir)
    change = versions.compact(spark, base)

    def of(state: str, name: str):
        return F.max(F.when(F.col("state") == state, F.col(name)))

    fewer = change.agg(
        of("after", "rows").alias("rows_after"), (of("after", "files") < of("before", "files")).alias("fewer_files")
    )
    same = versions.reconcile(versions.as_of(spark, base, 2), versions.as_of(spark, base)).select("content_match")
    return fewer.withColumn("content_match", same.scalar())


@query
def zorder_files_touched(spark, sf_dir):
    """V6: a point predicate on a date as text, a channel or a number touches a layer or two of the 64 files after
    clustering by all three: 32 at most. A table too large for 64 files has more, and their own bound."""
    base = shared_dir(spark, "clustered")
    items = standins.table(spark, sf_dir, "lineitem")
    day = F.date_format("l_shipdate", "yyyy-MM-dd").alias("event_date")
    versions.commit(items.select(day, F.col("l_linenumber").cast("string").alias("channel"), "l_partkey"), base)
    files = layout.files_held(versions.as_of(spark, base), 64)
    versions.cluster(spark, base, ["event_date", "channel", "l_partkey"], files=64)
    wanted = {"event_date": "1997-03-05", "channel": "3", "l_partkey": 50}
    touched = layout.files_touched(versions.as_of(spark, base), wanted)
    most = layout.touched_at_most(files, len(wanted))
    return touched.select("column", (F.col("touched") <= most).alias("within_bound"))


@query
def zorder_content(spark, sf_dir):
    """V6: clustering changes no row."""
    base = shared_dir(spark, "clustered")
    source = standins.table(spark, sf_dir, "lineitem")
    versions.commit(source, base)
    versions.cluster(spark, base, ["l_partkey", "l_returnflag", "l_shipdate"], files=8)
    return versions.reconcile(source, versions.as_of(spark, base))


# --- dataset inspection ---------------------------------------------------------------------------------------------


def _trip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "trips")
    standins.trips(spark, sf_dir).write.parquet(path)
    return tables.read_trips(spark, path)


@query
def dataset_profile(spark, sf_dir):
    """Variant, time column and rows of a trip dataset."""
    profile = tables.dataset_profile(_trip_files(spark, sf_dir))
    has_files = (F.col("file_count") > 0).alias("has_files")
    return profile.select("dataset_variant", "pickup_timestamp_column", "total_rows", has_files)


def _with_rows(described: DataFrame, data: DataFrame) -> DataFrame:
    """A description of a dataset's columns next to its number of rows, as the inspection report has them."""
    return described.withColumn("total_rows", data.agg(F.count(F.lit(1))).scalar())


@query
def mixed_trip_files(spark, sf_dir):
    """One folder of files that differ in types and spelling, read as one table."""
    base, taken = shared_dir(spark, "mixed-trips"), standins.trips(spark, sf_dir)
    other = {
        "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime", "VendorID": "vendor_id",
        "PULocationID": "PUlocationID", "DOLocationID": "DOlocationID",
    }
    forms = (
        taken,
        taken.withColumnsRenamed(other).withColumns(
            {c: F.col(c).cast("int") for c in ("passenger_count", "payment_type", "PUlocationID")}
        ),
        taken.withColumns({c: F.col(c).cast("string") for c in ("tpep_pickup_datetime", "fare_amount", "passenger_count")}),
    )
    for k, form in enumerate(forms):
        form.where(F.col("payment_type") % 3 == k).write.parquet(f"{base}/form-{k}")
    read = trips.prepare(trip_files.read_mixed_trips(spark, base))
    return read.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("passenger_count").alias("avg_passenger_count"),
        F.sum("fare_amount").alias("sum_fare_amount"),
        F.min("pickup_ts").alias("min_pickup_ts"),
        F.max("tpep_dropoff_datetime").alias("max_dropoff_ts"),
        F.countDistinct("VendorID").alias("vendors"),
        F.countDistinct("PULocationID", "DOLocationID").alias("routes"),
    )


@query
def role_recommendation(spark, sf_dir):
    """P17."""
    raw = standins.trips(spark, sf_dir)
    return _with_rows(tables.recommended_columns(raw), raw)


@query
def schema_table(spark, sf_dir):
    """P18."""
    orders = standins.table(spark, sf_dir, "orders")
    return _with_rows(tables.schema_rows(orders).drop("nullable"), orders)


@query
def table_preview(spark, sf_dir):
    """Some columns of a table for display, and of one that is not there."""
    columns = ("o_orderkey", "o_orderstatus")
    there = tables.preview(spark, f"{sf_dir}/orders.parquet", columns, None).withColumn("found", F.lit(True))
    gone = tables.preview(spark, f"{sf_dir}/no_such_table.parquet", columns, None)
    return there.unionByName(gone.select(F.col("o_orderkey").cast("bigint"), "o_orderstatus", F.lit(False).alias("found")))


# --- marts ----------------------------------------------------------------------------------------------------------


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    funnel = settle(_funnel(spark, sf_dir), "funnel")
    mix = settle(_metrics(spark, sf_dir), "event-metrics")
    return standins.stream_reports(mix, funnel, clicks.alerts(funnel))


@query
def variant_pivot_ratio(spark, sf_dir):
    """M1 O8."""
    return marts.engine_ratio(standins.engine_results(spark, sf_dir))


@query
def throughput_profile(spark, sf_dir):
    """M2."""
    return marts.throughput(standins.engine_results(spark, sf_dir), STARTUP_SECONDS)


@query
def best_variant(spark, sf_dir):
    """M3 W4."""
    return marts.primary(marts.throughput(standins.engine_results(spark, sf_dir), STARTUP_SECONDS))


@query
def preferred_result(spark, sf_dir):
    """M11."""
    return marts.preferred(standins.engine_results(spark, sf_dir)).select("engine", "row_limit_label", "row_count")


@query
def pipeline_comparison(spark, sf_dir):
    """M5 U4."""
    profiles = marts.primary(marts.throughput(standins.engine_results(spark, sf_dir), STARTUP_SECONDS))
    return marts.pipeline_comparison(profiles, marts.stream_profiles(marts.complete_reports(_reports(spark, sf_dir))))


@query
def fastest_batch(spark, sf_dir):
    """M10."""
    profiles = marts.primary(marts.throughput(standins.engine_results(spark, sf_dir), STARTUP_SECONDS))
    streams = marts.stream_profiles(marts.complete_reports(_reports(spark, sf_dir)))
    return marts.fastest_batch(marts.pipeline_comparison(profiles, streams)).select("variant", "latency_seconds")


@query
def timing_summary(spark, sf_dir):
    """M6."""
    return marts.timing(standins.stream_runs(spark, sf_dir))


@query
def report_backfill(spark, sf_dir):
    """Summary and timing of reports that lack them."""
    done = marts.complete_reports(_reports(spark, sf_dir))
    counts = F.map_entries("scenario_summary.event_type_counts")
    listed = F.array_sort(F.transform(counts, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))))
    return done.select(
        "run_day", F.col("scenario_summary.*"), listed.alias("counts_by_type"), F.col("timing.*")
    ).drop("event_type_counts")


@query
def report_json(spark, sf_dir):
    """Reports written as one JSON document each, read again and profiled."""
    base = shared_dir(spark, "reports")
    written = _reports(spark, sf_dir).repartition("run_day").write.partitionBy("run_day")
    written.option("maxRecordsPerFile", 1).json(base)
    return marts.stream_profiles(marts.complete_reports(tables.read_reports(spark, base, reports.REPORT_SCHEMA)))


@query
def report_variant(spark, sf_dir):
    """Reports of changing shape: some have fields that no schema knows, some carry counts as text, some are cut
    off. Unknown fields survive, counts are read either way, broken documents are set aside."""
    base = shared_dir(spark, "reports")
    day, whole = F.dayofmonth("run_day"), _reports(spark, sf_dir)
    text = F.to_json(F.struct(*[c for c in whole.columns if c != "run_day"]))
    as_text = F.regexp_replace(text, r'"(event_count|total_sessions|total_users)":(\d+)', r'"$1":"$2"')
    more = F.concat(F.lit('{"host":"node-1","tags":["a",{"b":2}],'), F.substring(text, 2, 1 << 30))
    cut = F.substring(text, F.lit(1), (F.char_length(text) / 2).cast("int"))
    shaped = F.when(day % 5 == 0, cut).when(day % 5 == 1, as_text).when(day % 5 == 2, more).otherwise(text)
    written = whole.select("run_day", shaped.alias("value")).repartition("run_day").write.partitionBy("run_day")
    written.option("maxRecordsPerFile", 1).text(base)

    documents = tables.read_documents(spark, base)
    run_day = F.regexp_extract("path", r"run_day=([0-9-]+)", 1).alias("run_day")
    good = marts.complete_reports(reports.typed(documents))
    extra = F.to_json("extra").alias("extra")
    read = marts.stream_profiles(good, keep=[run_day, extra]).withColumn("state", F.lit("read"))
    broken = tables.quarantined(documents).select(run_day, F.lit("broken").alias("state"))
    return read.unionByName(broken, allowMissingColumns=True)


@query
def stream_profile(spark, sf_dir):
    """M4 A17."""
    return marts.stream_profiles(marts.complete_reports(_reports(spark, sf_dir)))


@query
def readiness(spark, sf_dir):
    """M12."""
    sections = {
        "Batch summary": metrics.summary(_dated(spark, sf_dir)),
        "Streaming demo": _funnel(spark, sf_dir),
        "No such year": trips.in_year(_dated(spark, sf_dir), 1901),
        "Not built": None,
    }
    return marts.readiness(sections)


@query
def kpi_headline(spark, sf_dir):
    """M13."""
    events = _clicks(spark, sf_dir)
    summary = metrics.summary(_dated(spark, sf_dir))
    return marts.headline(summary, clicks.event_totals(events), clicks.alerts(_funnel(spark, sf_dir)))
