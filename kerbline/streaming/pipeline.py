"""The clickstream job: one query for event metrics, one for funnel, baseline and alerts, one for rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kerbline.operators import baseline, clicks, sketches
from kerbline.operators.clicks import AlertLimits, Windowing
from kerbline.streaming import jobs, window_table

WINDOW_KEY = ("window_start", "window_end")
_RATES = ("page_to_product_rate", "product_to_cart_rate", "cart_to_purchase_rate", "page_to_purchase_rate")

#: A funnel window as the stream emits it: counts, rates, and the sketches they come from.
FUNNEL_SCHEMA = T.StructType(
    [T.StructField(c, T.TimestampType()) for c in WINDOW_KEY]
    + [T.StructField(c, T.LongType()) for c in clicks.FUNNEL_COUNTS]
    + [T.StructField(c, T.DoubleType()) for c in _RATES]
    + [T.StructField(c, T.BinaryType()) for c in sketches.SKETCHES]
    + [T.StructField("event_count", T.LongType())]
)
_BASELINE = [
    T.StructField("baseline_window_count", T.LongType()),
    T.StructField("baseline_session_mean", T.DoubleType()),
    T.StructField("baseline_session_stddev", T.DoubleType()),
    T.StructField("traffic_z_score", T.DoubleType()),
]
SCORED_SCHEMA = T.StructType(FUNNEL_SCHEMA.fields + _BASELINE)
ALERT_SCHEMA = T.StructType(
    [FUNNEL_SCHEMA[c] for c in clicks.ALERT_COLUMNS]
    + _BASELINE
    + [
        T.StructField("alert_types", T.ArrayType(T.StringType())),
        T.StructField("alert_count", T.IntegerType()),
        T.StructField("severity", T.StringType()),
        T.StructField("anomaly_model", T.StringType()),
    ]
)


def scored_batches(
    windows: str,
    alerts: str,
    *,
    lookback: int = baseline.LOOKBACK_WINDOWS,
    min_windows: int = baseline.MIN_WINDOWS,
    limits: AlertLimits = AlertLimits(),
) -> jobs.BatchWriter:
    """Keep funnel windows with their baseline and z-score at `windows`, and what that does to their alerts at `alerts`.

    A changed window changes the baseline of the windows after it. A micro-batch therefore scores the days it touches and
    those after them that look back on them, over the days before that they look back on; what it reads and writes
    depends on the look-back and on how late events are, not on how long the stream has run. Both outputs follow from the
    state before the batch and its own windows, so a batch that is run again after a failure changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.persist()
        scored = None
        try:
            changed = {row[0] for row in fresh.select(F.to_date("window_start")).distinct().collect()}  # days, not windows
            if not changed:
                return
            stored = window_table.days(spark, windows, before_batch=batch_id)
            again, past = window_table.needed(stored, changed, lookback)
            known = window_table.read(spark, windows, SCORED_SCHEMA, [d for d in stored if d.day in again | past])
            kept = known.join(fresh.select(*WINDOW_KEY), list(WINDOW_KEY), "left_anti")
            rows = kept.select(*FUNNEL_SCHEMA.names).unionByName(fresh.select(*FUNNEL_SCHEMA.names))
            scored = baseline.rolling_baseline(
                rows, lookback=lookback, min_windows=min_windows, floor=limits.z_stddev_floor
            )
            touched = F.to_date("window_start").isin(sorted(again))
            scored = scored.select(*SCORED_SCHEMA.names).where(touched).persist()
            before, after = (baseline.z_alerts(state, limits) for state in (known.where(touched), scored))
            window_table.append(window_table.changes(before, after, WINDOW_KEY), alerts, batch_id)
            window_table.write(scored, windows, batch_id)
            window_table.expire(spark, windows, batch_id)
        finally:
            fresh.unpersist()
            if scored is not None:
                scored.unpersist()

    return write


def scored_windows(spark: SparkSession, path: str) -> DataFrame:
    """Current funnel windows with baseline and sketches; feed to clicks.alerts, baseline.z_alerts or sketches.rewindowed."""
    return window_table.read(spark, path, SCORED_SCHEMA, window_table.days(spark, path))


def current_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts that hold now, one row per window."""
    return window_table.current(spark, path, ALERT_SCHEMA, WINDOW_KEY)


def alert_history(spark: SparkSession, path: str) -> DataFrame:
    """Every alert raised, replaced or withdrawn, with its batch."""
    return window_table.history(spark, path, ALERT_SCHEMA)


@dataclass(frozen=True)
class Outputs:
    """Where a run keeps its tables and checkpoints; all below folders every executor can reach."""

    base: str
    name: str = "clickstream_metrics"

    @property
    def checkpoints(self) -> str:
        return f"{self.base}/checkpoints"

    @property
    def windows(self) -> str:
        return f"{self.base}/scored_windows"

    @property
    def events(self) -> str:
        return f"{self.base}/{jobs.query_name(self.name, 'events')}"

    @property
    def alerts(self) -> str:
        return f"{self.base}/{jobs.query_name(self.name, 'anomalies')}"

    @property
    def rejects(self) -> str:
        return f"{self.base}/{jobs.query_name(self.name, 'rejects')}"


def start_all(
    envelope: DataFrame,
    outputs: Outputs,
    *,
    shape: Windowing = Windowing(),
    limits: AlertLimits = AlertLimits(),
    every_seconds: int | None = None,
) -> list[StreamingQuery]:
    """Start the job's queries. Funnel and alerts share one query and one state, and have an output each."""
    events = clicks.parse(envelope)
    options = {"checkpoints": outputs.checkpoints, "every_seconds": every_seconds}
    return [
        jobs.start(
            clicks.event_metrics(events, shape),
            jobs.query_name(outputs.name, "events"),
            sink="parquet",
            output=outputs.base,
            **options,
        ),
        jobs.start_batches(
            sketches.counted(sketches.window_sketches(events, shape), [*sketches.SKETCHES, "event_count"]),
            jobs.query_name(outputs.name, "funnel"),
            scored_batches(outputs.windows, outputs.alerts, limits=limits),
            **options,
        ),
        jobs.start(
            clicks.rejects(envelope),
            jobs.query_name(outputs.name, "rejects"),
            sink="parquet",
            output=outputs.base,
            **options,
        ),
    ]
