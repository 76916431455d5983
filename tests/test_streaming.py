"""Streams over several files: same answers as the batch, late rows, revisions, reruns, rejects."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from kerbline import shared_dir
from kerbline.operators import baseline, clicks, quality, sketches
from kerbline.operators.clicks import Windowing
from kerbline.sources import events as E
from kerbline.sources import standins
from kerbline.streaming import jobs, pipeline, window_table

HOURS = Windowing("1 hour", "1 hour", "10 minutes")
START = datetime(2026, 3, 9, 10, 0)


def record(number, minute, kind="page_view", session="s1", broken=None):
    at = START + timedelta(minutes=minute)
    payload = {
        "event_id": f"e{number}", "user_id": f"u-{session}", "session_id": session, "event_type": kind,
        "page": "home", "timestamp": at.isoformat() + "Z",
    }
    if broken == "time":
        payload["timestamp"] = "soon"
    text = "{not json" if broken == "json" else json.dumps(payload)
    return (bytearray(text, "utf-8"), at)


def write_batches(spark, batches):
    """One file per batch, read in this order."""
    path = shared_dir(spark, "envelopes")
    for rows in batches:
        frame = spark.createDataFrame(rows, E.ENVELOPE_SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(path)
    return path


def run_parquet(df, name="out"):
    base = shared_dir(df.sparkSession, name)
    jobs.drain([jobs.start(df, name, sink="parquet", output=base, checkpoints=f"{base}/cp")])
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")


def in_three_batches(spark, sf_dir, late_share=0):
    """The events table as three broker files, cut in the middle of a day; of every `late_share` records one comes a
    file late."""
    events = standins.clicks(spark, sf_dir)
    day = F.dayofmonth(F.col("sent_at") - F.expr("interval 7 hours 20 minutes"))
    batch = F.when(day > 30, 0).when(day <= 10, 0).when(day <= 20, 1).otherwise(2)
    if late_share:
        late = F.when(F.col("event_id").cast("long") % late_share == 0, 1).otherwise(0)
        batch = F.least(batch + late, F.lit(2))
    path = shared_dir(spark, "three")
    for i in range(3):
        standins.envelope(events.where(batch == i)).coalesce(1).write.mode("append").parquet(path)
    return path


def test_bad_records_are_kept_aside(spark):
    rows = [record(1, 0), record(2, 1, broken="json"), record(3, 2, broken="time"), record(4, 3)]
    envelope = E.envelope_stream(spark, write_batches(spark, [rows]))
    assert run_parquet(clicks.parse(envelope), "good").count() == 2
    kept = [r["value"] for r in run_parquet(clicks.rejects(envelope), "bad").orderBy("kafka_timestamp").collect()]
    assert kept[0] == "{not json"
    assert json.loads(kept[1])["event_id"] == "e3"


def test_event_type_and_empty_session(spark):
    rows = [record(1, 0, session=""), record(2, 1, kind="error", session="s2")]
    parsed = clicks.parse(spark.createDataFrame(rows, E.ENVELOPE_SCHEMA))
    report = quality.event_report(parsed, E.REQUIRED_FIELDS[:-1]).head()
    assert tuple(report) == (2, 1, 0)
    assert clicks.funnel(parsed, HOURS, exact=True).head()["page_view_sessions"] == 1


def test_append_writes_closed_windows_once_and_drops_late_rows(spark):
    batches = [
        [record(1, 0), record(2, 30)],
        [record(3, 90)],
        [record(4, 95)],
        [record(5, 5), record(6, 200)],
        [record(7, 210)],
    ]
    stream = clicks.parse(E.envelope_stream(spark, write_batches(spark, batches), files_per_batch=1))
    rows = run_parquet(clicks.event_metrics(stream, HOURS)).orderBy("window_start").collect()
    assert [(r["window_start"].hour, r["event_count"]) for r in rows] == [(10, 2), (11, 2)]


def test_memory_sink_keeps_every_refinement(spark):
    batches = [[record(1, 0)], [record(2, 1)]]
    stream = clicks.parse(E.envelope_stream(spark, write_batches(spark, batches), files_per_batch=1))
    name = jobs.query_name("refine", "events")
    log = jobs.ProgressLog(spark, shared_dir(spark, "updates"), [name])
    started = jobs.start(
        clicks.event_metrics(stream, HOURS), name, sink="memory", checkpoints=shared_dir(spark, "cp")
    )
    jobs.drain([started])
    assert [r["event_count"] for r in jobs.memory_rows(spark, name, "event_count").collect()] == [1, 2]
    assert [r["query_name"] for r in jobs.progress(spark, [started]).collect()] == [name]
    updates = log.close()
    assert updates.agg(F.sum("num_input_rows")).head()[0] == 2
    assert {r["query_name"] for r in updates.collect()} == {name}


def test_all_updates_are_kept(spark, monkeypatch):
    """More batches than Spark's own list of progress holds, written in several goes."""
    monkeypatch.setattr(jobs, "PROGRESS_HELD", 40)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        batches = [[record(k, 0)] for k in range(12)]
        stream = clicks.rejects(E.envelope_stream(spark, write_batches(spark, batches), files_per_batch=1))
        name = jobs.query_name("many", "rejects")
        log = jobs.ProgressLog(spark, shared_dir(spark, "updates"), [name])
        jobs.drain([jobs.start(stream, name, sink="memory", checkpoints=shared_dir(spark, "cp"), mode="append")])
        assert log.close().where("num_input_rows > 0").count() == 12
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_only_the_ends_of_watched_queries_count(spark, monkeypatch):
    monkeypatch.setattr(jobs, "LISTENER_SECONDS", 3.0)
    log = jobs.ProgressLog(spark, shared_dir(spark, "updates"), ["slow", "quick"])
    run = {name: SimpleNamespace(name=name, runId=f"run-{name}") for name in ("slow", "quick", "stranger")}
    for event in run.values():
        log.onQueryStarted(event)
    for name in ("quick", "stranger"):
        log.onQueryTerminated(run[name])
    with pytest.raises(TimeoutError, match="slow"):
        log.close()
    log.onQueryTerminated(run["slow"])
    assert log.close().count() == 0


def test_console_sink(spark):
    stream = E.envelope_stream(spark, write_batches(spark, [[record(1, 0)]]))
    shown = jobs.start(clicks.parse(stream), "shown", sink="console", checkpoints=shared_dir(spark, "cp"), mode="append")
    jobs.drain([shown])
    assert shown.exception() is None


def test_failure_stops_the_other_queries(spark):
    stream = E.envelope_stream(spark, write_batches(spark, [[record(1, 0)]]))
    base = shared_dir(spark, "failing")

    def fail(batch, batch_id):
        raise RuntimeError("no room left")

    endless = jobs.start_batches(stream, "endless", lambda b, i: None, checkpoints=base, every_seconds=1, mode="append")
    broken = jobs.start_batches(stream, "broken", fail, checkpoints=base, mode="append")
    with pytest.raises(Exception, match="no room left"):
        jobs.drain([endless, broken])
    assert not endless.isActive


def test_unknown_sink(spark):
    stream = E.envelope_stream(spark, write_batches(spark, [[record(1, 0)]]))
    with pytest.raises(ValueError, match="unknown sink"):
        jobs.start(stream, "x", sink="tape", checkpoints=shared_dir(spark, "cp"))


@pytest.mark.parametrize("build", [clicks.funnel, clicks.event_metrics])
def test_exact_stream_equals_batch(spark, sf_dir, build):
    path = in_three_batches(spark, sf_dir)
    batch = build(clicks.parse(spark.read.schema(E.ENVELOPE_SCHEMA).parquet(path)), HOURS, exact=True)
    stream = run_parquet(build(clicks.parse(E.envelope_stream(spark, path, 1)), HOURS, exact=True))
    last = clicks.parse(spark.read.schema(E.ENVELOPE_SCHEMA).parquet(path)).agg(F.max("event_timestamp")).head()[0]
    closed = batch.where(F.col("window_end") <= last - timedelta(minutes=10))
    assert stream.count() > 0
    assert stream.exceptAll(closed).count() == 0
    assert closed.exceptAll(stream).count() == 0


def test_whole_job_equals_batch_after_revisions(spark, sf_dir):
    """Micro-batches that cut windows in two and bring late rows for old ones: what is kept at the end, scores and alerts
    included, equals one batch over everything, and the counts are the exact ones."""
    path = in_three_batches(spark, sf_dir, late_share=5)
    days = Windowing("1 day", "1 day", "15 days")
    outputs = pipeline.Outputs(shared_dir(spark, "job"))
    jobs.drain(pipeline.start_all(E.envelope_stream(spark, path, 1), outputs, shape=days))
    kept = pipeline.scored_windows(spark, outputs.windows).drop(*sketches.SKETCHES, "event_count")
    events = clicks.parse(spark.read.schema(E.ENVELOPE_SCHEMA).parquet(path))
    whole = baseline.rolling_baseline(clicks.funnel(events, days, exact=True)).select(*kept.columns)
    assert kept.exceptAll(whole).count() == 0
    assert whole.exceptAll(kept).count() == 0
    alerts = pipeline.current_alerts(spark, outputs.alerts)
    assert alerts.exceptAll(baseline.z_alerts(whole)).count() == 0
    assert baseline.z_alerts(whole).exceptAll(alerts).count() == 0
    assert len(window_table.finished(spark, outputs.windows)) >= 3
    assert spark.read.parquet(outputs.rejects).count() == 0


def test_redelivery_is_dropped(spark):
    batches = [[record(1, 0), record(1, 0), record(2, 1)], [record(1, 0), record(3, 2)]]
    stream = clicks.parse(E.envelope_stream(spark, write_batches(spark, batches), files_per_batch=1))
    unique = run_parquet(quality.first_delivery(stream, within="1 hour"))
    assert sorted(r["event_id"] for r in unique.collect()) == ["e1", "e2", "e3"]


def test_events_without_an_id_are_no_copies(spark):
    batches = [[record(1, 0)] * 2 + [record(2, 1)] * 3, [record(2, 2)] * 2]
    stream = clicks.parse(E.envelope_stream(spark, write_batches(spark, batches), files_per_batch=1))
    unnamed = stream.withColumn("event_id", F.when(F.col("event_id") != "e2", F.col("event_id")))
    unique = run_parquet(quality.first_delivery(unnamed, within="1 hour"))
    assert sorted(str(r["event_id"]) for r in unique.collect()) == ["None"] * 5 + ["e1"]


def test_approximate_counts_are_close(spark, sf_dir):
    """A bound of the sketch holds for a share of the windows: three standard errors (of 5 %) for nearly all of them."""
    events = clicks.parse(standins.envelope(standins.clicks(spark, sf_dir)))
    day = Windowing("1 day", "1 day", "10 minutes")
    near = clicks.funnel(events, day).select("window_start", F.col("total_sessions").alias("near"))
    exact = clicks.funnel(events, day, exact=True).select("window_start", "total_sessions")
    off = F.abs(F.col("near") / F.col("total_sessions") - 1)
    within, most = near.join(exact, "window_start").agg(F.avg((off <= 0.15).cast("int")), F.max(off)).head()
    assert within >= 0.95
    assert most < 0.3


def test_encode_parses_back(spark):
    rows = [("e1", "u", "s", "purchase", "checkout", None, "2026-03-09T10:00:00Z")]
    events = spark.createDataFrame(rows, E.EVENT_SCHEMA)
    back = clicks.parse(E.encode(events)).head()
    assert (back["event_id"], back["product_id"], back["event_timestamp"]) == ("e1", None, START)


def test_kafka_connector_is_optional(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        E.kafka_stream(spark, "localhost:1", "topic")
