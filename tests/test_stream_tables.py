"""Window tables and alert changes that micro-batches keep: reruns, half-written batches, retractions, bounded reads; open
windows, dropped rows and observed metrics; sketches that merge."""

from __future__ import annotations

import random
import subprocess
import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kerbline import shared_dir
from kerbline.operators import baseline, clicks, quality, sketches, trips
from kerbline.operators.clicks import AlertLimits, Windowing
from kerbline.sources import events as E
from kerbline.sources import standins
from kerbline.streaming import jobs, pipeline, window_table
from kerbline.streaming.window_table import Day
from tests.test_streaming import HOURS, record, run_parquet, write_batches

START = datetime(2026, 3, 9, 10, 0)
LIMITS = AlertLimits()


def window_rows(spark, sessions, *, at=START, step=timedelta(hours=1), start=0):
    """Funnel windows in a row with these session counts; null counts leave a window out."""
    rows = []
    for k, n in enumerate(sessions, start):
        if n is not None:
            begin = at + k * step
            rows.append((begin, begin + step, n, n, n, 0, 0, 0, None, None, None, 0.0, *[b""] * 6, n))
    return spark.createDataFrame(rows, pipeline.FUNNEL_SCHEMA)


def places(spark):
    base = shared_dir(spark, "kept")
    return f"{base}/windows", f"{base}/alerts"


def counts(df):
    return {r["window_start"]: (r["total_sessions"], r["baseline_window_count"]) for r in df.collect()}


def same(found, wanted):
    columns = wanted.columns
    return found.select(*columns).exceptAll(wanted).isEmpty() and wanted.exceptAll(found.select(*columns)).isEmpty()


def test_rerun_of_a_batch_changes_nothing(spark):
    windows, alerts = places(spark)
    write = pipeline.scored_batches(windows, alerts)
    write(window_rows(spark, [5]), 0)
    write(window_rows(spark, [5, 9]), 1)
    kept, told = pipeline.scored_windows(spark, windows).collect(), pipeline.alert_history(spark, alerts).collect()
    write(window_rows(spark, [5, 9]), 1)
    assert sorted(pipeline.scored_windows(spark, windows).collect()) == sorted(kept)
    assert sorted(pipeline.alert_history(spark, alerts).collect(), key=str) == sorted(told, key=str)
    assert counts(pipeline.scored_windows(spark, windows)) == {START: (5, 0), START + timedelta(hours=1): (9, 1)}


def test_half_written_batches_are_not_read(spark):
    """A batch without Spark's mark is invisible, to readers and to the batch itself when it runs again."""
    windows, alerts = places(spark)
    write = pipeline.scored_batches(windows, alerts)
    write(window_rows(spark, [5, 6]), 0)
    half = pipeline.scored_windows(spark, windows).withColumn("total_sessions", F.lit(99).cast("long"))
    half = half.withColumns({"window_day": F.to_date("window_start"), "windows": F.lit(2)})
    half.write.partitionBy("window_day", "windows").parquet(f"{windows}/batch_id=1")
    window_table._delete(spark, f"{windows}/batch_id=1/_SUCCESS")
    assert {n for n, _ in counts(pipeline.scored_windows(spark, windows)).values()} == {5, 6}
    write(window_rows(spark, [7], start=1), 1)
    assert {n for n, _ in counts(pipeline.scored_windows(spark, windows)).values()} == {5, 7}


def test_failure_between_the_two_outputs(spark, monkeypatch):
    """Alerts are written, windows are not: the batch runs again from the state before it."""
    windows, alerts = places(spark)
    write = pipeline.scored_batches(windows, alerts)
    write(window_rows(spark, [1]), 0)

    def fail(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(window_table, "write", fail)
        with pytest.raises(RuntimeError):
            write(window_rows(spark, [6]), 1)
    assert counts(pipeline.scored_windows(spark, windows)) == {START: (1, 0)}
    write(window_rows(spark, [6]), 1)
    assert counts(pipeline.scored_windows(spark, windows)) == {START: (6, 0)}
    changes = {(r["batch_id"], r["change"]) for r in pipeline.alert_history(spark, alerts).collect()}
    assert (0, window_table.RAISED) in changes and len(changes) == 2


def test_alerts_are_raised_replaced_and_withdrawn(spark):
    windows, alerts = places(spark)
    quiet = AlertLimits(min_sessions=1000)
    write = pipeline.scored_batches(windows, alerts, limits=quiet)
    write(window_rows(spark, [10, 10, 10, 10, 30, 10]), 0)
    spike = START + timedelta(hours=4)
    held = {r["window_start"]: r for r in pipeline.current_alerts(spark, alerts).collect()}
    assert set(held) == {spike} and held[spike]["alert_types"] == ["traffic_spike"]
    write(window_rows(spark, [40], start=4), 1)
    again = {r["window_start"]: r for r in pipeline.current_alerts(spark, alerts).collect()}
    assert again[spike]["total_sessions"] == 40 and again[spike]["traffic_z_score"] > held[spike]["traffic_z_score"]
    # Late events before the spike make it ordinary, and raise an alert of their own.
    write(window_rows(spark, [60], start=1), 2)
    current = pipeline.current_alerts(spark, alerts)
    assert same(current, baseline.z_alerts(pipeline.scored_windows(spark, windows), quiet))
    assert spike not in {r["window_start"] for r in current.collect()}
    told = pipeline.alert_history(spark, alerts).where(F.col("window_start") == spike).orderBy("batch_id").collect()
    assert [r["change"] for r in told] == [window_table.RAISED, window_table.REPLACED, window_table.WITHDRAWN]


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_windows_gives_the_batch_scores(spark, seed):
    """Windows of three weeks, a few at a time and revised, with gaps of days: always the scores of one batch."""
    draw = random.Random(seed)
    windows, alerts = places(spark)
    write = pipeline.scored_batches(windows, alerts, lookback=5)
    step, known = timedelta(hours=7), {}
    for batch_id in range(4):
        start = draw.randrange(60)
        sessions = [draw.randrange(1, 40) if draw.random() < 0.6 else None for _ in range(draw.randrange(1, 12))]
        known |= {start + k: n for k, n in enumerate(sessions) if n is not None}
        write(window_rows(spark, sessions, step=step, start=start), batch_id)
    everything = window_rows(spark, [known.get(k) for k in range(80)], step=step)
    whole = baseline.rolling_baseline(everything, lookback=5)
    assert same(pipeline.scored_windows(spark, windows), whole)
    assert same(pipeline.current_alerts(spark, alerts), baseline.z_alerts(whole, LIMITS))


def test_rows_read_do_not_grow_with_history(spark, monkeypatch):
    """Every batch brings a new day; what it reads is the same after one day and after five."""
    windows, alerts = places(spark)
    write = pipeline.scored_batches(windows, alerts)
    taken, read = [], window_table.read

    def counting(spark, path, schema, chosen):
        chosen = list(chosen)
        taken.append(sum(day.windows for day in chosen))
        return read(spark, path, schema, chosen)

    monkeypatch.setattr(window_table, "read", counting)
    for k in range(6):
        write(window_rows(spark, [9] * 24, at=datetime(2026, 3, 1) + timedelta(days=k)), k)
    assert taken == [0] + [24] * 5


def test_needed_days():
    days = [Day(date(2026, 3, d), 0, n, "") for d, n in ((1, 10), (2, 3), (5, 2), (6, 9), (9, 4), (20, 50))]
    again, past = window_table.needed(days, {date(2026, 3, 5)}, 4)
    assert (again, past) == ({date(2026, 3, 5), date(2026, 3, 6)}, {date(2026, 3, 1), date(2026, 3, 2)})
    again, past = window_table.needed(days, {date(2026, 3, 30)}, 60)
    assert again == {date(2026, 3, 30)} and past == {date(2026, 3, 20), date(2026, 3, 9), date(2026, 3, 6)}
    assert window_table.needed([], {date(2026, 3, 1)}, 12) == ({date(2026, 3, 1)}, set())


def test_replaced_days_expire(spark, monkeypatch):
    monkeypatch.setattr(window_table, "KEPT_BATCHES", 1)
    windows, alerts = places(spark)
    write = pipeline.scored_batches(windows, alerts)
    for batch_id in range(4):
        write(window_rows(spark, [batch_id + 1]), batch_id)
    left = window_table._folders(spark, windows, None)
    assert [found.batch_id for found in left] == [1, 2, 3]
    assert counts(pipeline.scored_windows(spark, windows)) == {START: (4, 0)}


def test_empty_batch_and_empty_tables(spark):
    windows, alerts = places(spark)
    pipeline.scored_batches(windows, alerts)(window_rows(spark, []), 0)
    assert pipeline.scored_windows(spark, windows).isEmpty()
    assert pipeline.current_alerts(spark, alerts).isEmpty()


# --- open windows, late rows, observed metrics ----------------------------------------------------------------------


def test_open_windows_and_dropped_groups(spark):
    batches = [
        [record(1, 0), record(2, 30)],
        [record(3, 90), record(4, 95, kind="purchase")],
        [record(5, 100)],
        [record(6, 5), record(7, 6), record(8, 7, kind="purchase"), record(9, 110)],
    ]
    base = shared_dir(spark, "open")
    stream = clicks.parse(E.envelope_stream(spark, write_batches(spark, batches), files_per_batch=1))
    counted = clicks.event_metrics(stream, HOURS)
    log = jobs.ProgressLog(spark, f"{base}/updates", ["windows"])
    jobs.drain([jobs.start(counted, "windows", sink="parquet", output=base, checkpoints=f"{base}/cp")])
    dropped = log.close().groupBy("batch_id").agg(F.max("dropped_groups").alias("n")).agg(F.sum("n")).head()[0]
    closed = spark.read.schema(counted.schema).parquet(f"{base}/windows")
    held = jobs.open_groups(spark, f"{base}/cp/windows").select("window.start", "event_type", "count").collect()
    assert [(r["event_type"], r["event_count"]) for r in closed.collect()] == [("page_view", 2)]
    assert sorted((r["start"].hour, r["event_type"], r["count"]) for r in held) == [(11, "page_view", 3), (11, "purchase", 1)]
    assert dropped == 2  # two types in one window; three events


def test_observed_metrics_of_a_stream(spark):
    batches = [[record(1, 0), record(2, 1, session="")], [record(3, 2, session="")], []]
    base = shared_dir(spark, "observed")
    events = clicks.parse(E.envelope_stream(spark, write_batches(spark, batches), files_per_batch=1))
    watched = events.observe("records", *quality.event_counts(events.columns, E.REQUIRED_FIELDS[:-1]))
    log = jobs.ProgressLog(spark, f"{base}/updates", ["watched"])
    jobs.drain([jobs.start(watched, "watched", sink="parquet", output=base, checkpoints=f"{base}/cp")])
    seen = jobs.observed(log.close(), "records", "total_records long, missing_required_rows long")
    assert sorted((r["total_records"], r["missing_required_rows"]) for r in seen.where("total_records > 0").collect()) == [(1, 1), (2, 1)]


def test_observed_summary_needs_no_scan(spark, sf_dir, plan, capsys):
    prepared = quality.flag(trips.prepare(standins.trips(spark, sf_dir)))
    counted = quality.summary_of_flagged(prepared).head()
    watch = Observation("flags")
    quality.issue_rows(quality.observed_flags(prepared, watch)).write.parquet(shared_dir(spark, "issues"))
    found = quality.observed_summary(watch, quality.flag_counts(prepared))
    assert "Scan parquet" not in plan(found, capsys)
    assert found.head() == counted


RERUN = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import Observation, functions as F
from kerbline import build_session
spark = build_session("rerun", "local[2,4]", conf={{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
spark.sparkContext.setLogLevel("OFF")

def once(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

watch = Observation("rows")
rows = spark.range(0, 1000, 1, 4).observe(watch, F.count(F.lit(1)).alias("n"), F.count_if(F.expr("id % 10 = 0")).alias("tens"))
rows.mapInArrow(once, "id long").write.parquet(sys.argv[1])
print("FOUND", watch.get["n"], watch.get["tens"], spark.read.parquet(sys.argv[1]).count())
"""


def test_tasks_that_run_again_count_once(tmp_path):
    """Every task fails after its last row, once; the counts are those of the table."""
    root = str(Path(__file__).resolve().parents[1])
    script = tmp_path / "rerun.py"
    script.write_text(RERUN.format(root=root))
    done = subprocess.run([sys.executable, str(script), str(tmp_path / "out")], capture_output=True, text=True, timeout=240)
    assert "FOUND 1000 100 1000" in done.stdout, done.stderr[-2000:]


# --- sketches -------------------------------------------------------------------------------------------------------


def test_merged_sketches_equal_those_of_the_events(spark, sf_dir):
    events = clicks.parse(standins.envelope(standins.clicks(spark, sf_dir)))
    hours = sketches.window_sketches(events, HOURS)
    for duration, slide in (("1 day", None), ("3 hours", "1 hour")):
        merged = sketches.counted(sketches.rewindowed(hours, duration, slide), ["event_count"])
        shape = Windowing(duration, slide or duration)
        direct = sketches.counted(sketches.window_sketches(events, shape), ["event_count"])
        assert same(merged, direct)
        assert same(merged.drop("event_count"), clicks.funnel(events, shape, exact=True))


def test_sketches_beyond_their_exact_size(spark):
    """Past 2^bits members the count is an estimate; nearly all of many windows are within three standard errors."""
    at = F.timestamp_seconds(1_772_323_200 + F.col("id") % 200 * 3600)
    events = spark.range(200 * 900).select(
        at.alias("event_timestamp"), F.col("id").cast("string").alias("session_id"), F.lit("u").alias("user_id"),
        F.lit("page_view").alias("event_type"),
    )
    found = sketches.counted(sketches.window_sketches(events, HOURS, bits=8))
    off = F.abs(F.col("total_sessions") / 900 - 1) <= 3 / 16
    assert found.agg(F.avg(off.cast("int"))).head()[0] >= 0.97
    assert found.where("total_users <> 1 OR purchase_sessions <> 0").isEmpty()


def test_skipped_stages(spark):
    rows = [
        record(1, 0, session="a"), record(2, 1, kind="product_view", session="a"), record(3, 2, kind="purchase", session="a"),
        record(4, 3, kind="add_to_cart", session="b"), record(5, 4, kind="purchase", session="b"), record(6, 5, session=None),
    ]
    events = clicks.parse(spark.createDataFrame(rows, E.ENVELOPE_SCHEMA))
    row = sketches.skipped(sketches.window_sketches(events, HOURS)).head()
    found = (row["product_view_without_page_view"], row["add_to_cart_without_product_view"], row["purchase_without_add_to_cart"])
    assert found == (0, 1, 1)


def test_sketch_stream_equals_batch(spark):
    batches = [[record(k, k * 7 % 180, session=f"s{k % 5}") for k in range(9)], [record(99, 400)]]
    path = write_batches(spark, batches)
    stream = sketches.counted(sketches.window_sketches(clicks.parse(E.envelope_stream(spark, path, 1)), HOURS))
    table = clicks.parse(spark.read.schema(E.ENVELOPE_SCHEMA).parquet(path))
    closed = clicks.funnel(table, HOURS, exact=True).where(F.col("window_end") < START + timedelta(minutes=380))
    assert same(run_parquet(stream, "sketched"), closed)
