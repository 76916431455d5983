"""Sources, sinks, versioned tables and layouts."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbline import shared_dir
from kerbline.functions.expressions import row_count_label
from kerbline.operators import layout, metrics, quality, trips, versions
from kerbline.plans import batch, marts, trip_tables
from kerbline.sources import sinks, standins, tables
from kerbline.sources.reports import REPORT_SCHEMA


def write_text(spark, folder, text):
    path = shared_dir(spark, folder)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_zone_file(spark):
    text = (
        "LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n264,Unknown,N/A,N/A\n265,,Outside,\n"
        "1,EWR,Newark Airport,EWR"
    )
    zones = tables.read_zones(spark, write_text(spark, "zones", text))
    rows = {r["LocationID"]: (r["Borough"], r["Zone"]) for r in zones.collect()}
    assert rows == {1: ("EWR", "Newark Airport"), 264: ("Unknown", "N/A"), 265: (None, "Outside")}
    assert dict(zones.dtypes)["LocationID"] == "bigint"


def test_missing_paths(spark):
    nowhere = shared_dir(spark, "nowhere")
    assert tables.read_zones(spark, nowhere) is None
    assert tables.preview(spark, nowhere).collect() == []
    assert tables.preview(spark, nowhere, ["pickup_ts", "fare_amount"]).columns == ["pickup_ts", "fare_amount"]
    with pytest.raises(AnalysisException):
        tables.read_trips(spark, nowhere)


def test_small_trip_schema_gives_the_tables_it_can(spark):
    rows = [("2023-01-01 00:00:00", 1, 10.0, 2.0), ("2023-01-02 05:00:00", 2, 20.0, 3.0), ("bad", 1, 1.0, 1.0)]
    raw = spark.createDataFrame(
        rows, "pickup_datetime string, passenger_count long, total_amount double, trip_distance double"
    )
    built = trip_tables.all_tables(raw, None, 2023)
    assert set(built) == {"summary", "hourly"}
    row = built["summary"].head()
    assert (row["row_count"], row["active_days"], row["sum_total_amount"]) == (2, 2, 30.0)
    assert "avg_tip_pct" not in row.asDict()
    prepared = trips.prepare(raw)
    assert metrics.by_borough(prepared) is None
    assert metrics.by_zone(prepared) is None
    assert metrics.by_payment(prepared) is None
    assert trips.attach_zones(prepared, None).columns == prepared.columns
    with pytest.raises(ValueError, match="pickup time"):
        trips.prepare(raw.drop("pickup_datetime"))


def test_other_column_spellings(spark):
    raw = spark.createDataFrame(
        [("2023-01-01 00:00:00", 1, 2)], "lpep_pickup_datetime string, PUlocationID long, DOlocationID long"
    )
    zones = spark.createDataFrame([(1, "Queens", "A", "x")], tables.ZONE_SCHEMA)
    row = trips.attach_zones(trips.prepare(raw), zones).head()
    assert (row["pickup_borough"], row["dropoff_borough"], row["dropoff_zone"]) == ("Queens", "Unknown", "Unknown")


def test_profile_of_a_folder_tree(spark, sf_dir):
    path = shared_dir(spark, "profile")
    raw = standins.trips(spark, sf_dir)
    for month in ("01", "02"):
        raw.coalesce(1).write.parquet(f"{path}/2023/{month}")
    read = tables.read_trips(spark, path)
    profile = tables.dataset_profile(read).head()
    assert (profile["dataset_variant"], profile["file_count"]) == ("yellow", 2)
    assert profile["total_rows"] == 2 * raw.count()
    assert profile["total_size_mb"] == round(profile["total_size_bytes"] / 1024**2, 2)
    files = tables.file_profile(read)
    assert files.count() == 2
    assert tables.recommended_columns(read).count() == 10


def test_limits_and_labels(spark):
    df = spark.range(100)
    assert [r["id"] for r in tables.first_rows(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert tables.first_rows(df, None).count() == 100
    labels = spark.createDataFrame([(None,), (100_000,)], "n long").select(row_count_label(F.col("n")))
    assert [r[0] for r in labels.collect()] == ["full", "100,000"]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_outputs(spark, sf_dir, fmt, capsys):
    base = shared_dir(spark, "outputs")
    outputs = {"hourly": metrics.hourly(trips.prepare(standins.trips(spark, sf_dir)))}
    sinks.write_outputs(outputs, base, fmt=fmt)
    sinks.write_outputs(outputs, base, fmt=fmt)
    assert spark.read.format(fmt).load(f"{base}/hourly").count() == outputs["hourly"].count()
    sinks.show("hourly", outputs["hourly"], 2)
    sinks.show("absent", None, 2)
    shown = capsys.readouterr().out
    assert "hourly" in shown
    assert "absent" not in shown
    assert len(sinks.head(outputs["hourly"], 3)) == 3


def test_batch_job(spark, sf_dir, capsys):
    base = shared_dir(spark, "job")
    standins.trips(spark, sf_dir).write.parquet(f"{base}/in")
    standins.zones(spark, sf_dir).write.option("header", True).csv(f"{base}/zones")
    limits = quality.Limits(pickup_year=1997)
    built = batch.run(
        spark, f"{base}/in", f"{base}/zones", f"{base}/out", limits=limits, issues_path=f"{base}/issues", show_rows=2
    )
    assert set(built) == {
        "summary", "hourly", "borough_summary", "zone_summary", "payment_tip_summary", "quality_summary",
        "quality_issue_rows",
    }
    for name in set(built) - {"quality_issue_rows"}:
        assert spark.read.parquet(f"{base}/out/{name}").count() == built[name].count()
    counts = spark.read.parquet(f"{base}/out/quality_summary").head()
    assert spark.read.parquet(f"{base}/issues").count() == counts["issue_rows"]
    assert counts["missing_pickup_timestamp_rows"] > 0
    assert "zone_summary" in capsys.readouterr().out
    placeless = batch.build(tables.read_trips(spark, f"{base}/in"), None, limits)
    assert set(built) - set(placeless) == {"borough_summary", "zone_summary"}


def test_issue_rows_go_where_told(spark, sf_dir):
    base, other = shared_dir(spark, "issues"), shared_dir(spark, "other")
    rows = quality.issue_rows(quality.flag(trips.prepare(standins.trips(spark, sf_dir)), quality.Limits(1997)))
    sinks.write_issue_rows(rows, base)
    sinks.write_issue_rows(rows, base, path=other)
    assert spark.read.parquet(f"{base}/quality_issue_rows").count() == rows.count()
    assert spark.read.parquet(other).count() == rows.count()
    assert tables.preview(spark, other, ["pickup_ts", "dq_issue_count"], 20).count() == 20


def test_report_files(spark):
    document = {"config": {"query_name": "q"}, "funnel_metrics": [{"window_end": "b", "total_sessions": 3}]}
    path = write_text(spark, "report", json.dumps(document))
    report = marts.complete_reports(tables.read_reports(spark, path, REPORT_SCHEMA)).head()
    assert report["scenario_summary"]["generated_session_count"] == 3
    assert report["config"]["query_name"] == "q"


# --- versions -------------------------------------------------------------------------------------------------------

BEFORE = "order_id string, user_id string, amount double, event_date string"
SEED = [(f"ord-00{i}", f"user-0{i}", 10.0 * i, "2026-03-09") for i in (1, 2, 3)]
EVOLVED = [(f"ord-00{i}", f"user-0{i}", 10.0 * i, "2026-03-10", channel) for i, channel in ((4, "ads"), (5, "email"))]


@pytest.fixture
def orders(spark):
    base = shared_dir(spark, "orders")
    versions.commit(spark.createDataFrame(SEED, BEFORE), base)
    versions.commit(spark.createDataFrame(EVOLVED, BEFORE + ", channel string"), base)
    return base


def test_as_of_and_evolution(spark, orders):
    first, last = versions.as_of(spark, orders, 0), versions.as_of(spark, orders)
    assert (first.count(), len(first.columns)) == (3, 4)
    assert (last.count(), len(last.columns)) == (5, 5)
    assert last.where("channel is null").count() == 3
    with pytest.raises(ValueError, match="no version 7"):
        versions.as_of(spark, orders, 7)
    with pytest.raises(ValueError, match="no versioned table"):
        versions.as_of(spark, shared_dir(spark, "none"))


def test_optimize_keeps_rows_and_old_versions(spark, orders):
    change = {r["state"]: r for r in versions.compact(spark, orders).collect()}
    assert change["after"]["files"] == 1
    assert change["before"]["rows"] == change["after"]["rows"] == 5
    versions.cluster(spark, orders, files=2)
    history = [(r["version"], r["operation"], r["num_rows"]) for r in versions.history(spark, orders).collect()]
    assert history == [(0, "WRITE", 3), (1, "WRITE", 2), (2, "OPTIMIZE", 5), (3, "ZORDER", 5)]
    assert [r["version"] for r in versions.history(spark, orders, 2).collect()] == [2, 3]
    assert versions.as_of(spark, orders, 0).count() == 3
    for version in (1, 2, 3):
        same = versions.reconcile(versions.as_of(spark, orders, 1), versions.as_of(spark, orders, version)).head()
        assert same["content_match"]


def test_append_after_optimize_and_overwrite(spark, orders):
    versions.compact(spark, orders)
    versions.commit(spark.createDataFrame(SEED, BEFORE), orders)
    assert versions.as_of(spark, orders).count() == 8
    versions.commit(spark.createDataFrame(SEED, BEFORE), orders, mode="overwrite")
    latest = versions.as_of(spark, orders)
    assert (latest.count(), len(latest.columns)) == (3, 4)


def test_commit_refuses_what_it_cannot_keep(spark, orders):
    with pytest.raises(ValueError, match="amount is double"):
        versions.commit(spark.createDataFrame([("1",)], "amount string"), orders)
    with pytest.raises(ValueError, match="evolve"):
        versions.commit(spark.createDataFrame([("1",)], "extra string"), orders, evolve=False)
    with pytest.raises(ValueError, match="partition"):
        versions.commit(spark.createDataFrame(SEED, BEFORE), orders, partition_by=["event_date"])
    assert versions.as_of(spark, orders).count() == 5


def test_unfinished_write_is_invisible(spark, orders):
    spark.createDataFrame(SEED, BEFORE).write.parquet(f"{orders}/data/version=2")
    assert versions.as_of(spark, orders).count() == 5
    assert versions.commit(spark.createDataFrame(SEED[:1], BEFORE), orders) == 2
    assert versions.as_of(spark, orders).count() == 6


def test_partitioned_table(spark, sf_dir):
    base = shared_dir(spark, "partitioned")
    source = standins.table(spark, sf_dir, "orders")
    half = F.col("o_orderkey") % 2 == 0
    versions.commit(source.where(half), base, partition_by=["o_orderstatus"])
    versions.commit(source.where(~half), base)
    table = versions.as_of(spark, base)
    assert table.dtypes == source.dtypes
    assert versions.reconcile(source, table).head()["content_match"]


def test_reconcile_sees_a_changed_row(spark):
    a = spark.createDataFrame(SEED, BEFORE)
    b = spark.createDataFrame([*SEED[:2], ("ord-003", "user-03", 99.0, "2026-03-09")], BEFORE)
    row = versions.reconcile(a, b).head()
    assert row["rows_match"]
    assert not row["content_match"]
    twice = versions.reconcile(a, a.unionByName(a)).head()
    assert not twice["rows_match"]
    assert versions.reconcile(a.limit(0), a.limit(0)).head()["content_match"]


def test_zorder_narrows_both_columns(spark, sf_dir):
    base = shared_dir(spark, "zorder")
    versions.commit(standins.table(spark, sf_dir, "lineitem"), base)
    versions.cluster(spark, base, ["l_partkey", "l_suppkey"], files=16)
    touched = layout.files_touched(versions.as_of(spark, base), {"l_partkey": 50, "l_suppkey": 5}).collect()
    assert all(row["files"] == 16 and row["touched"] <= 10 for row in touched)


def test_zorder_splits_a_hot_value(spark):
    """All rows share one z-value; the clustered table still has files of similar size."""
    base = shared_dir(spark, "hot")
    versions.commit(spark.range(8000).select(F.lit("same").alias("channel"), F.lit(1).alias("event_date")), base)
    versions.cluster(spark, base, ["channel", "event_date"], files=4)
    sizes = [r["rows"] for r in tables.file_profile(versions.as_of(spark, base)).collect()]
    assert sum(sizes) == 8000
    assert len(sizes) == 4
    assert max(sizes) < 4000


@pytest.mark.parametrize(("bound", "most"), [("FILE_VALUES", 2500), ("TARGET_FILE_BYTES", 4000)])
def test_zorder_cuts_files_that_one_task_should_not_sort(spark, monkeypatch, bound, most):
    """Of a table too large for the files asked for, a file still has a bounded number of rows, and no row is lost."""
    k = F.col("id")
    rows = spark.range(8000).select((k * 7919 % 8000).alias("number"), (k % 40).alias("day"), F.sha2(k.cast("string"), 256).alias("text"))
    base = shared_dir(spark, "large")
    versions.commit(rows, base)
    monkeypatch.setattr(layout, bound, most)
    assert layout.files_held(versions.as_of(spark, base), 2) >= 16
    versions.cluster(spark, base, ["number", "day"], files=2)
    table = versions.as_of(spark, base)
    sizes = [r["rows"] for r in tables.file_profile(table).collect()]
    assert len(sizes) >= 12
    assert max(sizes) <= 1500
    assert versions.reconcile(rows, table).head()["content_match"]


def test_zorder_keeps_the_files_asked_for(spark):
    base = shared_dir(spark, "small")
    versions.commit(spark.range(100).withColumn("day", F.col("id") % 7), base)
    assert layout.files_held(versions.as_of(spark, base), 8) == 8
    versions.commit(spark.range(0).withColumn("day", F.col("id") % 7), base, mode="overwrite")
    assert layout.files_held(versions.as_of(spark, base), 3) == 3


def test_zorder_tells_long_common_starts_apart(spark):
    """Text that differs only after 20 bytes, dates as text and as times, and a number, each by itself and together."""
    base = shared_dir(spark, "text")
    k = F.col("id")
    rows = spark.range(4000).select(
        F.format_string("a-common-start-of-20-%05d", k * 7919 % 4000).alias("word"),
        F.date_format(F.timestamp_seconds(1_772_323_200 + k % 31 * 86_400), "yyyy-MM-dd").alias("event_date"),
        F.timestamp_seconds(k * 104_729 % 4000).cast("timestamp_ntz").alias("at"),
        (k * 31 % 4000).alias("number"),
    )
    versions.commit(rows, base)
    wanted = {"word": "a-common-start-of-20-00500", "event_date": "2026-03-11", "number": 77}
    for columns in (["word"], ["number"], ["event_date", "word"], ["word", "event_date", "number"]):
        versions.cluster(spark, base, columns, files=16)
        touched = layout.files_touched(versions.as_of(spark, base), {c: wanted[c] for c in columns}).collect()
        most = {1: 1, 2: 8, 3: 10}[len(columns)]
        assert all(row["files"] == 16 and row["touched"] <= most for row in touched), (columns, touched)
    versions.cluster(spark, base, ["at", "number"], files=8)
    assert versions.as_of(spark, base).count() == 4000


def test_files_for():
    assert layout.files_for(0) == 1
    assert layout.files_for(10, 4) == 3


def test_repeated_timings(spark):
    runs = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 0.33333)], "layout string, seconds double")
    rows = {r["layout"]: tuple(r)[1:] for r in layout.timing_summary(runs).collect()}
    assert rows == {"a": (1.5, 1.0, 2.0), "b": (0.3333, 0.3333, 0.3333)}
