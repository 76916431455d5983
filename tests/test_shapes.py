"""Files and documents whose shape differs from run to run, and layouts that do not."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from kerbline import shared_dir
from kerbline.operators import layout, quality, trips, versions
from kerbline.plans import batch
from kerbline.sources import reports, standins, tables, trip_files


def written(spark, frames):
    base = shared_dir(spark, "shapes")
    for k, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{base}/{k:02}")
    return base


# --- trip files -----------------------------------------------------------------------------------------------------


def test_files_of_one_schema_are_one_scan(spark, sf_dir, plan, capsys):
    taken = standins.trips(spark, sf_dir)
    as_long = taken.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
    base = written(spark, [taken, as_long, taken, as_long, taken.drop("tip_amount")])
    groups = trip_files.schema_groups(spark, trip_files.list_files(spark, base))
    assert sorted(len(files) for files, _ in groups) == [2, 3]
    read = trip_files.read_mixed_trips(spark, base)
    assert read.count() == 5 * taken.count()
    assert read.where("tip_amount IS NULL").count() == taken.count()
    text = plan(read.groupBy("payment_type").agg(F.sum("passenger_count")), capsys)
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert len(schemas) == 2 and all(line.count(":") == 3 for line in schemas), schemas


def test_spellings_types_and_unknown_columns(spark):
    times = "to_timestamp('2026-03-09 10:00:00')"
    frames = [
        spark.sql(f"SELECT {times} tpep_pickup_datetime, 1L PULocationID, 2.5D fare_amount, 1 extra, 'Y' flag"),
        spark.sql("SELECT '2026-03-09 11:00:00' pickup_datetime, 2 PUlocationID, '3.5' fare_amount, 2.5D extra, 7 flag"),
        spark.sql(f"SELECT {times} lpep_pickup_datetime, '3' PULocationID, 'free' fare_amount, 3 extra, 'N' flag"),
    ]
    read = trip_files.read_mixed_trips(spark, written(spark, frames))
    assert dict(read.dtypes) == {
        "tpep_pickup_datetime": "timestamp", "PULocationID": "bigint", "fare_amount": "double", "extra": "double", "flag": "string",
    }
    rows = sorted((r["PULocationID"], r["tpep_pickup_datetime"].hour, r["fare_amount"], r["extra"], r["flag"]) for r in read.collect())
    assert rows == [(1, 10, 2.5, 1.0, "Y"), (2, 11, 3.5, 2.5, "7"), (3, 10, None, 3.0, "N")]


def test_no_files(spark):
    path = shared_dir(spark, "empty")
    spark.range(1).write.json(path)
    with pytest.raises(ValueError, match="no parquet files"):
        trip_files.read_mixed_trips(spark, path)


# --- reports --------------------------------------------------------------------------------------------------------


def test_documents_of_any_shape(spark):
    documents = {
        "plain": {"config": {"query_name": "q", "page_view_sessions": 3}, "scenario_summary": {"generated_event_count": 5}},
        "text": {"config": {"query_name": "q", "page_view_sessions": "3"}, "event_metrics": [{"event_count": "12"}, {"event_count": "x"}]},
        "more": {"config": {"query_name": "q", "new": [1]}, "host": {"name": "n1"}},
        "wrong": {"config": "gone", "event_metrics": "none", "timing": [1], "scenario_summary": {"event_type_counts": {"a": "4", "b": None}}},
    }
    texts = {name: json.dumps(document) for name, document in documents.items()}
    texts |= {"cut": texts["plain"][:30], "list": "[1, 2]", "empty": "", "twice": '{"a": 1, "a": 2}', "lines": json.dumps(documents["plain"], indent=2)}
    base = shared_dir(spark, "documents")
    frame = spark.createDataFrame(list(texts.items()), "name string, value string").repartition("name")
    frame.write.partitionBy("name").option("maxRecordsPerFile", 1).text(base)
    read = tables.read_documents(spark, base)
    name = F.regexp_extract("path", "name=([a-z]+)", 1).alias("name")
    broken = {r["name"]: r["text"] for r in tables.quarantined(read).select(name, "text").collect()}
    assert set(broken) == {"cut", "list", "twice", "empty"} and broken["cut"].strip() == texts["cut"]
    rows = {r["name"]: r for r in reports.typed(read).withColumn("extra", F.to_json("extra")).select(name, "*").collect()}
    assert set(rows) == {"plain", "text", "more", "wrong", "lines"}
    assert rows["plain"]["config"] == rows["lines"]["config"] == ("q", 3) and rows["text"]["config"] == ("q", 3)
    assert [item["event_count"] for item in rows["text"]["event_metrics"]] == [12, None]
    assert json.loads(rows["more"]["extra"]) == {"host": {"name": "n1"}} and rows["plain"]["extra"] == "{}"
    assert rows["wrong"]["config"] is None and rows["wrong"]["event_metrics"] is None and rows["wrong"]["timing"] is None
    assert rows["wrong"]["scenario_summary"]["event_type_counts"] == {"a": 4, "b": None}
    assert rows["plain"]["scenario_summary"]["generated_event_count"] == 5


# --- layouts --------------------------------------------------------------------------------------------------------


def clustered(spark, source, columns, files):
    base = shared_dir(spark, "layout")
    versions.commit(source, base)
    versions.cluster(spark, base, columns, files=files)
    return versions.as_of(spark, base)


def test_ranges_do_not_depend_on_cores_or_files(spark, sf_dir):
    """The same table from one file and one core's worth of tasks, and from many: the same ranges, three times."""
    items = standins.table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_shipdate")
    columns, found = ["l_partkey", "l_returnflag", "l_shipdate"], []
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, parts in (("2", 1), ("7", 5), ("13", 3)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            table = clustered(spark, items.repartition(parts), columns, 16)
            ranges = layout.file_ranges(table, columns).drop("path").collect()
            found.append(sorted(ranges, key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert found[0] == found[1] == found[2] and 12 <= len(found[0]) <= 16


@pytest.mark.parametrize("columns", [["l_partkey"], ["l_partkey", "l_shipdate"], ["l_partkey", "l_suppkey", "l_shipdate"]])
def test_point_predicates_touch_a_layer(spark, sf_dir, columns):
    items = standins.table(spark, sf_dir, "lineitem").select(*columns)
    table = clustered(spark, items, columns, 27)
    middle = items.agg(*[F.percentile_approx(c, 0.4).alias(c) if c != "l_shipdate" else F.mode(c).alias(c) for c in columns]).head()
    touched = layout.files_touched(table, middle.asDict()).collect()
    most = layout.touched_at_most(27, len(columns))
    assert all(row["touched"] <= most for row in touched), touched
    sizes = [r["rows"] for r in tables.file_profile(table).collect()]
    assert sum(sizes) == items.count() and max(sizes) <= 2.5 * sum(sizes) / 27


def test_edges_are_exact(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 500).alias("x"))
    known = sorted(k % 500 for k in range(1000) if k % 10)
    wanted = [known[k * len(known) // 8] for k in range(1, 8)]
    assert layout._edges(rows, "x", 8) == wanted
    hot = spark.range(1000).select(F.when(F.col("id") < 900, F.lit("a")).otherwise(F.lit("b")).alias("x"))
    assert layout._edges(hot, "x", 4) == ["a"]
    assert layout._edges(hot.where("false"), "x", 4) == [] and layout._edges(hot.select(F.lit(None).cast("int").alias("x")), "x", 4) == []


def test_clustering_nothing(spark, sf_dir):
    empty = standins.table(spark, sf_dir, "lineitem").where("false")
    assert clustered(spark, empty, ["l_partkey", "l_shipdate"], 4).count() == 0


# --- one signature aggregate ----------------------------------------------------------------------------------------


def test_audit_equals_its_parts(spark, sf_dir):
    prepared = trips.prepare(standins.trips(spark, sf_dir), keep_undated=True)
    summary, repeated = quality.audit(prepared)
    assert summary.collect() == quality.summary(prepared).collect()
    assert repeated.exceptAll(quality.repeated_signatures(prepared)).isEmpty()
    assert repeated.count() == quality.duplicate_signatures(prepared).count()
    flagged = quality.flag(prepared, repeated=repeated)
    assert quality.summary_of_flagged(flagged).collect() == summary.select(*quality.summary_of_flagged(flagged).columns).collect()


def test_audit_without_signatures_or_rows(spark, sf_dir):
    few = trips.prepare(standins.trips(spark, sf_dir).select("tpep_pickup_datetime", "trip_distance"))
    summary, repeated = quality.audit(few)
    assert repeated is None and summary.collect() == quality.summary(few).collect()
    empty = trips.prepare(standins.trips(spark, sf_dir).where("false"))
    summary, repeated = quality.audit(empty)
    assert summary.collect() == quality.summary(empty).collect() and repeated.isEmpty()


def test_quality_reads_trips_twice_and_shuffles_signatures_once(spark, sf_dir, monkeypatch, plan, capsys):
    """Of the batch job's quality part: one job over the trips for summary and repeated signatures, one for issue rows."""
    path = shared_dir(spark, "trips")
    standins.trips(spark, sf_dir).write.parquet(path)
    plans, settle = [], quality.settle

    def seen(df, purpose):
        plans.append(plan(df, capsys))
        return settle(df, purpose)

    monkeypatch.setattr(quality, "settle", seen)
    outputs = batch.build(tables.read_trips(spark, path), standins.zones(spark, sf_dir))
    plans.append(plan(outputs["quality_issue_rows"], capsys))
    everything = "\n".join(plans)
    assert "Scan" not in plan(outputs["quality_summary"], capsys).replace("Scan ExistingRDD", "")
    trip_scans = [line for line in everything.splitlines() if line.startswith("Location") and path in line]
    assert len(trip_scans) == 2
    assert sum("_sig_" in line for line in everything.splitlines() if "hashpartitioning" in line) == 1
