"""Hot keys, copies and nulls against brute force."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbline.functions import expressions as X
from kerbline.operators import baseline, clicks, lookup, metrics, quality, trips
from kerbline.operators.clicks import Windowing
from kerbline.plans import trip_tables
from kerbline.sources import standins

TRIP = (
    "VendorID long, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID long,"
    " DOLocationID long, passenger_count double, trip_distance double, fare_amount double, tip_amount double,"
    " total_amount double, payment_type long"
)
ZONE = "LocationID long, Borough string, Zone string, service_zone string"
FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

amounts = st.one_of(st.none(), st.sampled_from([-5.0, 0.0, 1.0, 2.5, 250.0]))
trip_rows = st.lists(
    st.tuples(
        st.sampled_from([1, 2, None]),
        st.sampled_from([None, datetime(2023, 1, 1, 5), datetime(2022, 6, 1, 7)]),
        st.sampled_from([None, datetime(2023, 1, 1, 6)]),
        st.sampled_from([1, 2, 3, None]),
        st.sampled_from([1, 9]),
        st.sampled_from([None, 0.0, 1.0, 9.0]),
        amounts,
        amounts,
        amounts,
        amounts,
        st.sampled_from([1, 7, None]),
    ),
    min_size=1,
    max_size=60,
)


def brute_issues(row, copies):
    vendor, ts, off, pu, do, people, distance, fare, tip, total, _ = row
    names = []
    if ts is None:
        names.append("missing_pickup_timestamp")
    if None in (ts, people, distance, fare, total):
        names.append("missing_required_fields")
    if any(x is not None and x < 0 for x in (fare, tip, total, distance)):
        names.append("negative_numeric_values")
    if people is not None and (people <= 0 or people > 8):
        names.append("invalid_passenger_count")
    if distance is not None and distance > 200:
        names.append("invalid_trip_distance")
    pct = tip / fare * 100 if fare is not None and fare > 0 and tip is not None else None
    if pct is not None and (pct < 0 or pct > 100):
        names.append("invalid_tip_pct")
    if ts is not None and ts.year != 2023:
        names.append("pickup_year_mismatch")
    if pu not in (1, 2):
        names.append("unresolved_pickup_zone")
    key = (vendor, ts, off, pu, do, people, distance, fare, total)
    if None not in key and copies[key] > 1:
        names.append("duplicate_taxi_record")
    return names


@FEW
@given(rows=trip_rows)
def test_flags_and_summary_match_brute_force(spark, rows):
    zones = spark.createDataFrame([(1, "Queens", "A", "x"), (2, "Bronx", "B", "y")], ZONE)
    raw = spark.createDataFrame(rows, TRIP)
    named = trips.attach_zones(trips.prepare(raw, keep_undated=True), zones)
    limits = quality.Limits(pickup_year=2023)
    copies = Counter((r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[9]) for r in rows)
    expected = [brute_issues(row, copies) for row in rows]

    flagged = quality.flag(named, limits)
    found = Counter(tuple(r["dq_issue_names"]) for r in flagged.select("dq_issue_names").collect())
    assert found == Counter(tuple(names) for names in expected)

    summary = quality.summary(named, limits).head().asDict()
    assert summary == quality.summary_of_flagged(flagged).head().asDict()
    assert summary["issue_rows"] == sum(bool(names) for names in expected)
    counts = Counter(name for names in expected for name in names)
    assert {k: summary[f"{k}_rows"] for k in counts} == dict(counts)
    histogram = {r["issue"]: r["rows"] for r in quality.issue_histogram(quality.summary(named, limits)).collect()}
    assert histogram == dict(counts)


@FEW
@given(rows=trip_rows)
def test_rolled_up_tables_equal_the_direct_ones(spark, rows):
    zones = spark.createDataFrame([(1, "Queens", "A", "x"), (2, "Bronx", "B", "y")], ZONE)
    prepared = trips.prepare(spark.createDataFrame(rows, TRIP))
    named = trips.attach_zones(prepared, zones)
    rolled = trip_tables.rollup(prepared, [trip_tables.HOUR, trip_tables.PLACE, trip_tables.PAYMENT])
    pairs = [
        (trip_tables.summary(rolled, zones), metrics.summary(named)),
        (trip_tables.hourly(rolled), metrics.hourly(named)),
        (trip_tables.by_borough(rolled, zones), metrics.by_borough(named)),
        (trip_tables.by_zone(rolled, zones), metrics.by_zone(named)),
        (trip_tables.by_payment(rolled), metrics.by_payment(named)),
    ]
    for coarse, direct in pairs:
        assert sorted(coarse.columns) == sorted(direct.columns)
        shown = [
            Counter(
                tuple(round(v, 6) if isinstance(v, float) else v for v in row)
                for row in frame.select(*sorted(direct.columns)).collect()
            )
            for frame in (coarse, direct)
        ]
        assert shown[0] == shown[1]


@pytest.mark.parametrize("hot", ["complete", "incomplete"])
def test_a_third_of_all_rows_are_copies_of_one(spark, hot):
    """Many copies of one signature: every copy is flagged, or none when the signature is incomplete."""
    at = datetime(2023, 1, 1)
    copies, others = 20_000, 40_000
    row = F.when(F.col("id") < copies, F.lit(-1)).otherwise(F.col("id"))
    unknown = F.lit(None).cast("long")
    vendor = F.lit(1).cast("long") if hot == "complete" else F.when(F.col("id") < copies, unknown).otherwise(1)
    raw = spark.range(copies + others).select(
        vendor.alias("VendorID"),
        F.lit(at).alias("tpep_pickup_datetime"),
        F.lit(at).alias("tpep_dropoff_datetime"),
        row.alias("PULocationID"),
        *[F.lit(1.0).alias(c) for c in ("passenger_count", "trip_distance", "fare_amount", "total_amount")],
    )
    prepared = trips.prepare(raw, keep_undated=True)
    expected = copies if hot == "complete" else 0
    assert quality.flag(prepared).where("dq_duplicate_taxi_record").count() == expected
    shuffled = quality.mark_duplicates(prepared, max_broadcast_rows=0)
    assert shuffled.count() == copies + others
    assert shuffled.where("dq_duplicate_taxi_record").count() == expected
    summary = quality.summary(prepared).head()
    assert (summary["total_rows"], summary["duplicate_taxi_record_rows"]) == (copies + others, expected)
    assert quality.duplicate_signatures(prepared).count() == (1 if expected else 0)


def test_hot_location_with_a_dimension_too_large_to_broadcast(spark, monkeypatch):
    """A third of the trips start at one place and a third at none; the shuffle join gives what the broadcast gives."""
    monkeypatch.setattr(lookup, "HOT_ROWS", 100)
    monkeypatch.setattr(lookup, "HOT_KEYS", 2)
    place = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 500).cast("long")
    raw = spark.range(3000).select(
        F.lit("2023-01-01 00:00:00").alias("pickup_datetime"),
        place.alias("PULocationID"),
        (F.col("id") % 50).alias("DOLocationID"),
        F.col("id").alias("fare_amount"),
    )
    zones = spark.range(0, 500, 2).select(
        F.col("id").alias("LocationID"),
        *[F.concat(F.lit(c[0]), F.col("id").cast("string")).alias(c) for c in ("Borough", "Zone", "service_zone")],
    ).unionByName(spark.createDataFrame([(7, "hot", "hot", None)], ZONE))
    prepared = trips.prepare(raw)
    near = trips.attach_zones(prepared, zones)
    far = trips.attach_zones(prepared, zones, max_broadcast_rows=10)
    assert far.columns == [c for c in far.columns if c in near.columns]
    far = far.select(*near.columns)
    assert far.count() == 3000
    assert near.exceptAll(far).count() == 0
    assert near.where("pickup_borough = 'hot'").count() >= 1000


def test_duplicates_by_shuffle_equal_those_by_broadcast(spark, sf_dir, monkeypatch):
    prepared = trips.prepare(standins.trips(spark, sf_dir), keep_undated=True)
    monkeypatch.setattr(lookup, "HOT_ROWS", 2)
    monkeypatch.setattr(lookup, "HOT_KEYS", 10)
    near, far = quality.mark_duplicates(prepared), quality.mark_duplicates(prepared, max_broadcast_rows=5)
    assert near.where("dq_duplicate_taxi_record").count() > 20
    assert near.count() == far.count()
    assert near.exceptAll(far).count() == 0


@pytest.mark.parametrize("bits", [64, 1 << 26])
def test_only_rows_that_may_repeat_are_shuffled(spark, monkeypatch, bits):
    """Of 5,000 trips 200 are copies, some by amounts of -0.0; a sieve of 64 bits lets about all through, a large one
    few others. The marks are the broadcast's, and rows without a copy stay where they are."""
    monkeypatch.setattr(lookup, "SIEVE_BITS", bits)
    number = F.when(F.col("id") < 200, F.col("id") % 100).otherwise(F.col("id"))
    zero = F.when(F.col("id") < 100, F.lit(-0.0)).otherwise(0.0)
    raw = spark.range(5000).select(
        F.when(F.col("id") % 10 != 9, 1).alias("VendorID"),
        F.lit("2023-01-01 00:00:00").alias("tpep_pickup_datetime"),
        F.lit("2023-01-01 00:10:00").alias("tpep_dropoff_datetime"),
        number.alias("PULocationID"),
        *[zero.alias(c) for c in ("passenger_count", "trip_distance", "fare_amount", "total_amount")],
    )
    prepared = trips.prepare(raw)
    near, far = quality.mark_duplicates(prepared), quality.mark_duplicates(prepared, max_broadcast_rows=0)
    assert far.columns == near.columns and far.count() == 5000
    assert near.exceptAll(far).isEmpty() and far.where("dq_duplicate_taxi_record").count() == 180
    shuffled = []
    shuffle = lookup.left_by_shuffle

    def seen(facts, *rest):
        shuffled.append(facts.count())
        return shuffle(facts, *rest)

    monkeypatch.setattr(lookup, "left_by_shuffle", seen)
    quality.mark_duplicates(prepared, max_broadcast_rows=0)
    assert len(shuffled) == 1 and (180 <= shuffled[0] < 300 if bits > 64 else shuffled[0] > 2000)


def test_nearly_equal_amounts_are_the_same_trip(spark):
    at = datetime(2023, 1, 1)
    rows = [(1, at, at, 1, 1, 1.0, 0.1 + 0.2, 5.0, 1.0, 6.0, 1), (1, at, at, 1, 1, 1.0, 0.3, 5.0, 1.0, 6.0, 1)]
    flagged = quality.flag(trips.prepare(spark.createDataFrame(rows, TRIP)))
    assert flagged.where("dq_duplicate_taxi_record").count() == 2


def test_hot_session_and_sliding_windows_match_brute_force(spark):
    start = datetime(2026, 1, 1)
    kinds = ["page_view", "product_view", "add_to_cart", "purchase", "error", None]
    rows = []
    for i in range(3000):
        session = "hot" if i % 3 else f"s{i % 50}"
        user = None if i % 97 == 0 else f"u{session}"
        rows.append((user, None if i % 89 == 0 else session, kinds[i % 6], start + timedelta(seconds=37 * i)))
    events = spark.createDataFrame(
        rows, "user_id string, session_id string, event_type string, event_timestamp timestamp"
    )
    shape = Windowing("1 hour", "20 minutes", "10 minutes")
    expected = {}
    for user, session, kind, at in rows:
        floor = at.replace(minute=at.minute // 20 * 20, second=0)
        for step in range(3):
            cell = expected.setdefault(floor - timedelta(minutes=20 * step), {"s": set(), "u": set(), "k": {}})
            if session is not None:
                cell["s"].add(session)
                cell["k"].setdefault(kind, set()).add(session)
            if user is not None:
                cell["u"].add(user)
    found = clicks.funnel(events, shape, exact=True).collect()
    assert len(found) == len(expected)
    for row in found:
        cell = expected[row["window_start"]]
        assert row["total_sessions"] == len(cell["s"])
        assert row["total_users"] == len(cell["u"])
        for kind in kinds[:4]:
            assert row[f"{kind}_sessions"] == len(cell["k"].get(kind, ()))
    counts = clicks.event_metrics(events, shape, exact=True)
    assert counts.agg(F.sum("event_count")).head()[0] == 3 * len(rows)


@pytest.mark.parametrize("block_rows", [12, 16, 4096])
def test_blocks_do_not_change_the_baseline(spark, block_rows):
    start = datetime(2026, 1, 1)
    values = {name: [(i * 7 + len(name)) % 23 + i // 40 for i in range(120)] for name in ("a", "bb")}
    gaps = [i + (50 if i > 60 else 0) for i in range(120)]
    rows = [(name, start + timedelta(hours=gaps[i]), v) for name, vs in values.items() for i, v in enumerate(vs)]
    table = spark.createDataFrame(rows, "page string, window_start timestamp, total_sessions long")
    found = baseline.rolling_baseline(table, series=["page"], block_rows=block_rows)
    assert found.count() == len(rows)
    for name, vs in values.items():
        ordered = found.where(F.col("page") == name).orderBy("window_start").collect()
        for i, row in enumerate(ordered):
            before = vs[max(0, i - 12) : i]
            assert row["baseline_window_count"] == len(before)
            if len(before) < 2:
                assert row["traffic_z_score"] is None
                continue
            mean = sum(before) / len(before)
            spread = (sum((x - mean) ** 2 for x in before) / len(before)) ** 0.5
            assert row["baseline_session_mean"] == pytest.approx(mean, abs=1e-4)
            assert row["baseline_session_stddev"] == pytest.approx(spread, abs=1e-4)
            score = (vs[i] - round(mean, 4)) / max(round(spread, 4), 0.1)
            assert row["traffic_z_score"] == pytest.approx(score, abs=2e-3)


def test_lookback_longer_than_a_block(spark):
    start = datetime(2026, 1, 1)
    rows = [(start + timedelta(hours=i), i) for i in range(60)]
    table = spark.createDataFrame(rows, "window_start timestamp, total_sessions long")
    found = baseline.rolling_baseline(table, lookback=50, block_rows=10).orderBy("window_start").collect()
    assert [r["baseline_window_count"] for r in found] == [min(i, 50) for i in range(60)]


@pytest.mark.parametrize("by_time", [False, True])
def test_baseline_keeps_rows_without_series_or_time(spark, by_time):
    start = datetime(2026, 1, 1)
    rows = [(s, start + timedelta(hours=h), h) for s in ("a", None) for h in (0, 1, 2, 30, 31)] + [("a", None, 9), (None, None, 9)]
    table = spark.createDataFrame(rows, "page string, window_start timestamp, total_sessions long")
    if by_time:
        scored = baseline.recent_baseline(table, seconds=2 * 3600, series=["page"], block_seconds=3 * 3600)
    else:
        scored = baseline.rolling_baseline(table, series=["page"], lookback=2)
    found = scored.collect()
    assert len(found) == len(rows)
    counts = [0, 1, 2, 0, 1] if by_time else [0, 1, 2, 2, 2]
    for series in ("a", None):
        own = sorted((r for r in found if r["page"] == series and r["window_start"]), key=lambda r: r["window_start"])
        assert [r["baseline_window_count"] for r in own] == counts
    assert all(r["traffic_z_score"] is None for r in found if r["window_start"] is None)


@FEW
@given(st.lists(st.tuples(amounts, amounts), min_size=1, max_size=10))
def test_rates_never_divide_by_nothing(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    found = df.select("a", "b", X.rate(F.col("a"), F.col("b")).alias("r")).collect()
    for a, b, r in found:
        expected = None if a is None or b is None or b <= 0 else a / b * 100
        assert r == (None if expected is None else pytest.approx(expected, abs=1e-4))


def test_standins_repeat_rows(spark, sf_dir):
    items = standins.table(spark, sf_dir, "lineitem")
    again = items.where("l_orderkey % 97 = 0").count()
    assert standins.trips(spark, sf_dir).count() == items.count() + again
