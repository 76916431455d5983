"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kerbline import shared_dir
from kerbline.operators import clicks, layout, quality, trips
from kerbline.plans import trip_tables
from kerbline.sources import standins, tables


@pytest.fixture(scope="module")
def files(spark, sf_dir):
    path = shared_dir(spark, "trip-files")
    standins.trips(spark, sf_dir).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def zones(spark, sf_dir):
    path = shared_dir(spark, "zones")
    standins.zones(spark, sf_dir).write.option("header", True).csv(path)
    return tables.read_zones(spark, path)


def test_year_range_reaches_the_scan(spark, files, plan, capsys):
    text = plan(trips.in_year(trips.prepare(tables.read_trips(spark, files)), 1997), capsys)
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text
    assert "LessThan(tpep_pickup_datetime" in text


def test_metrics_read_only_their_columns(spark, files, plan, capsys):
    rolled = trip_tables.rollup(trips.prepare(tables.read_trips(spark, files)), [trip_tables.PAYMENT])
    text = plan(rolled, capsys)
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "payment_type" in schema
    for absent in ("VendorID", "DOLocationID", "passenger_count", "tpep_dropoff_datetime"):
        assert absent not in schema


def test_grains_share_one_scan(spark, files, plan, capsys):
    grains = [trip_tables.HOUR, trip_tables.PLACE, trip_tables.PAYMENT]
    text = plan(trip_tables.rollup(trips.prepare(tables.read_trips(spark, files)), grains), capsys)
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "partial_sum" in text


def test_small_zones_are_broadcast_and_large_ones_are_not(spark, files, zones, plan, capsys):
    prepared = trips.prepare(tables.read_trips(spark, files))
    assert "BroadcastHashJoin LeftOuter" in plan(trips.attach_zones(prepared, zones), capsys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = trips.attach_zones(prepared, zones, max_broadcast_rows=3)
        assert "SortMergeJoin LeftOuter" in plan(named, capsys)
        few = trips.attach_zones(prepared, zones)
        assert named.select(*few.columns).exceptAll(few).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicates_need_no_window(spark, files, plan, capsys):
    prepared = trips.prepare(tables.read_trips(spark, files))
    for frame in (quality.summary(prepared), quality.flag(prepared), quality.duplicate_signatures(prepared)):
        text = plan(frame, capsys)
        assert "Window" not in text
        assert "CartesianProduct" not in text
        assert "NestedLoopJoin" not in text


def test_unused_flags_cost_nothing(spark, files, plan, capsys):
    flagged = quality.flag(trips.prepare(tables.read_trips(spark, files)), duplicates=False)
    assert "Exchange" not in plan(flagged, capsys)


def test_partition_filters(spark, sf_dir, plan, capsys):
    rows = standins.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.year("l_shipdate").alias("ship_year"), F.col("l_tax").alias("total_amount")
    )
    paths = layout.write_layouts(
        rows, shared_dir(spark, "layouts"), {"unpartitioned": (), "both": ("ship_year", "l_returnflag")}
    )
    wanted = {"ship_year": 1997, "l_returnflag": "A"}
    results = []
    for name, path in paths.items():
        found = layout.matched(layout.read_layout(spark, path, rows.schema), wanted)
        text = plan(found, capsys)
        if name == "both":
            filters = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
            assert "ship_year" in filters
            assert "l_returnflag" in filters
        results.append([(r[0], r[1], r[2], round(r[3], 6)) for r in found.collect()])
    assert results[0] == results[1]
    assert dict(layout.read_layout(spark, paths["both"], rows.schema).dtypes) == dict(rows.dtypes)


def test_extremes_of_text_per_file_need_no_sort_of_the_rows(spark, plan, capsys):
    path = shared_dir(spark, "files")
    rows = [("b", 3, b"x"), ("a", 1, b"y"), (None, None, None), ("c", 2, None)]
    spark.createDataFrame(rows, "name string, size int, raw binary").repartitionByRange(2, "size").write.parquet(path)
    ranges = layout.file_ranges(spark.read.parquet(path), ["name", "size", "raw"])
    assert ranges.columns == ["path", "min_name", "max_name", "min_size", "max_size", "min_raw", "max_raw"]
    text = plan(layout.files_touched(spark.read.parquet(path), {"name": "b", "size": 2}), capsys)
    assert "ObjectHashAggregate" in text and "SortAggregate" not in text
    # Dropping the set again must not bring the sort back.
    text = plan(ranges, capsys)
    assert "ObjectHashAggregate" in text and "SortAggregate" not in text
    found = sorted((r.min_size, r.max_size, r.min_name, r.max_name) for r in ranges.collect())
    assert found == [(1, 1, "a", "a"), (2, 3, "b", "c")]


def test_no_python_in_the_core(spark, sf_dir, plan, capsys):
    from kerbline.plans.catalog import all_queries

    for name in ("trips_enriched", "trip_summary", "dq_issue_rows", "click_funnel", "click_negative_values"):
        text = plan(all_queries()[name](spark, sf_dir), capsys)
        for step in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
            assert step not in text


def test_exact_funnel_is_two_aggregations_over_one_scan(spark, sf_dir, plan, capsys):
    text = plan(clicks.funnel(clicks.parse(standins.envelope(standins.clicks(spark, sf_dir))), exact=True), capsys)
    assert text.count("Scan parquet") == 2
    assert text.count("Exchange (") <= 4
    assert "Join" not in text
