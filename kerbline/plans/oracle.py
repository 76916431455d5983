"""The catalog's queries as SQL for another engine, over the same tables. Written from the definitions, not the plans."""

from __future__ import annotations

YEAR = 1997


def _ts(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column}"


def _day(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {name or column}"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_RAW = """copied AS (
  SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 97 = 0
), raw AS (
  SELECT CAST(l_linenumber % 2 + 1 AS BIGINT) AS VendorID,
    CASE WHEN l_partkey % 211 <> 0 THEN l_shipdate + INTERVAL 1 HOUR * (l_orderkey % 24) END AS pickup_ts,
    l_shipdate + INTERVAL 1 HOUR * (l_orderkey % 24) + INTERVAL 1 MINUTE * CAST(l_quantity AS BIGINT)
      AS tpep_dropoff_datetime,
    CASE WHEN l_partkey % 50 <> 0 THEN CAST(CAST(l_quantity AS BIGINT) % 10 AS DOUBLE) END AS passenger_count,
    l_quantity * CAST(4.2 AS DOUBLE) AS trip_distance,
    l_suppkey AS PULocationID, l_partkey % 120 AS DOLocationID, CAST(l_linenumber AS BIGINT) AS payment_type,
    l_extendedprice * (CAST(0.085 AS DOUBLE) - l_discount) / 100 AS fare_amount,
    l_extendedprice * l_tax / 100 AS tip_amount
  FROM copied
), trips AS (
  SELECT *, fare_amount + tip_amount AS total_amount,
    CAST(pickup_ts AS DATE) AS pickup_date, CAST(extract(hour FROM pickup_ts) AS INTEGER) AS pickup_hour,
    CASE payment_type WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash' WHEN 3 THEN 'no_charge' WHEN 4 THEN 'dispute'
      WHEN 5 THEN 'unknown' WHEN 6 THEN 'voided_trip' ELSE 'other' END AS payment_type_label,
    CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount END AS tip_ratio,
    CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100.0 END AS tip_pct
  FROM raw
)"""

_ZONES = """zones AS (
  SELECT s_suppkey AS id, r_name AS borough, n_name AS zone, 'SZ-' || (s_nationkey % 3) AS service_zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey % 17 <> 3
)"""

_NAMED = """named AS (
  SELECT t.*, coalesce(p.borough, 'Unknown') AS pickup_borough, coalesce(p.zone, 'Unknown') AS pickup_zone,
    coalesce(p.service_zone, 'Unknown') AS pickup_service_zone, coalesce(d.borough, 'Unknown') AS dropoff_borough,
    coalesce(d.zone, 'Unknown') AS dropoff_zone, coalesce(d.service_zone, 'Unknown') AS dropoff_service_zone
  FROM trips t LEFT JOIN zones p ON t.PULocationID = p.id LEFT JOIN zones d ON t.DOLocationID = d.id
)"""

_YEARLY = f"yearly AS (SELECT * FROM named WHERE extract(year FROM pickup_ts) = {YEAR})"
_TRIPS = _with(_RAW, _ZONES, _NAMED, _YEARLY)
_DATED = "dated AS (SELECT * FROM named WHERE pickup_ts IS NOT NULL)"
_ALL_TRIPS = _with(_RAW, _ZONES, _NAMED, _DATED)

_SIGNATURE = (
    "VendorID, pickup_ts, tpep_dropoff_datetime, PULocationID, DOLocationID, passenger_count, trip_distance,"
    " fare_amount, total_amount"
)
_COMPLETE = " AND ".join(f"{c.strip()} IS NOT NULL" for c in _SIGNATURE.split(","))

_RULES = {
    "missing_pickup_timestamp": "pickup_ts IS NULL",
    "missing_required_fields": (
        "pickup_ts IS NULL OR passenger_count IS NULL OR trip_distance IS NULL OR fare_amount IS NULL"
        " OR total_amount IS NULL"
    ),
    "negative_numeric_values": "fare_amount < 0 OR tip_amount < 0 OR total_amount < 0 OR trip_distance < 0",
    "invalid_passenger_count": "passenger_count <= 0 OR passenger_count > 8",
    "invalid_trip_distance": "trip_distance > 200",
    "invalid_tip_pct": "tip_pct < 0 OR tip_pct > 100",
    "pickup_year_mismatch": f"extract(year FROM pickup_ts) <> {YEAR}",
    "unresolved_pickup_zone": (
        "pickup_zone IN ('Unknown', 'N/A', '') OR pickup_borough IN ('Unknown', 'N/A', '')"
    ),
    "duplicate_taxi_record": f"{_COMPLETE} AND count(*) OVER (PARTITION BY {_SIGNATURE}) > 1",
}
_FLAGGED = (
    "flags AS (SELECT *, "
    + ", ".join(f"coalesce({rule}, false) AS dq_{name}" for name, rule in _RULES.items())
    + " FROM named), flagged AS (SELECT *, concat_ws(',', "
    + ", ".join(f"CASE WHEN dq_{name} THEN '{name}' END" for name in _RULES)
    + ") AS dq_issue_names, "
    + " + ".join(f"CAST(dq_{name} AS INTEGER)" for name in _RULES)
    + " AS dq_issue_count FROM flags)"
)
_QUALITY = _with(_RAW, _ZONES, _NAMED, _FLAGGED)

_ISSUE_ROW = (
    f"{_ts('pickup_ts')}, {_day('pickup_date')}, pickup_hour, pickup_borough, pickup_zone, dropoff_borough,"
    " dropoff_zone, PULocationID, DOLocationID, payment_type, payment_type_label,"
    " round(passenger_count, 8) AS passenger_count, round(trip_distance, 8) AS trip_distance,"
    " round(fare_amount, 8) AS fare_amount, round(tip_amount, 8) AS tip_amount,"
    " round(total_amount, 8) AS total_amount, round(tip_pct, 8) AS tip_pct, dq_issue_count, dq_issue_names"
)

_TIES = ", ".join(
    f"{column} NULLS FIRST"
    for column in (
        "pickup_ts, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, PULocationID, DOLocationID,"
        " payment_type, passenger_count, trip_distance, fare_amount, tip_amount"
    ).split(", ")
)

_CLICKS = """clicks AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
    user_id || '-' || strftime(ts, '%Y%m%d%H') AS session_id,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view' WHEN 'signup' THEN 'add_to_cart'
      ELSE event_type END AS event_type,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'product' WHEN 'signup' THEN 'cart'
      WHEN 'purchase' THEN 'checkout' END AS page,
    props ->> '$.k' AS product_id, ts AS event_timestamp, value - 5 AS total_amount
  FROM events
)"""


def _windows(length: str, slide_minutes: int, copies: int) -> str:
    """Each event once per window that covers it."""
    return f"""windowed AS (
  SELECT clicks.*, time_bucket(INTERVAL '{slide_minutes} minutes', event_timestamp, TIMESTAMP '1970-01-01')
      - INTERVAL 1 MINUTE * ({slide_minutes} * step) AS window_start,
    time_bucket(INTERVAL '{slide_minutes} minutes', event_timestamp, TIMESTAMP '1970-01-01')
      - INTERVAL 1 MINUTE * ({slide_minutes} * step) + INTERVAL '{length}' AS window_end
  FROM clicks, range(0, {copies}) AS r(step)
)"""


_HOURS = _windows("1 hour", 60, 1)
_HALF_DAYS = _windows("12 hours", 720, 1)
_DAYS = _windows("1 day", 1440, 1)
_SLIDING = _windows("1 hour", 15, 4)

_METRICS = """metrics AS (
  SELECT window_start, window_end, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
    count(DISTINCT session_id) AS unique_sessions
  FROM windowed GROUP BY ALL
)"""


def _stage(stage: str) -> str:
    return f"count(DISTINCT CASE WHEN event_type = '{stage}' THEN session_id END) AS {stage}_sessions"


def _rate(later: str, earlier: str, name: str) -> str:
    return (
        f"CASE WHEN {earlier}_sessions > 0 THEN CAST({later}_sessions AS DOUBLE) / {earlier}_sessions * 100.0 END"
        f" AS {name}"
    )


_FUNNEL = f"""counted AS (
  SELECT window_start, window_end, count(DISTINCT session_id) AS total_sessions,
    count(DISTINCT user_id) AS total_users, {_stage("page_view")}, {_stage("product_view")},
    {_stage("add_to_cart")}, {_stage("purchase")}
  FROM windowed GROUP BY ALL
), funnel AS (
  SELECT *, {_rate("product_view", "page_view", "page_to_product_rate")},
    {_rate("add_to_cart", "product_view", "product_to_cart_rate")},
    {_rate("purchase", "add_to_cart", "cart_to_purchase_rate")},
    {_rate("purchase", "page_view", "page_to_purchase_rate")}
  FROM counted
)"""

_EVENTS_PER_WINDOW = """sizes AS (
  SELECT window_start, window_end, count(*) AS event_count FROM windowed GROUP BY ALL
)"""
# Events whose record is neither cut off nor without a readable time.
_READABLE = _CLICKS.replace("FROM events", "FROM events WHERE event_id % 101 <> 0 AND event_id % 103 <> 0")

_BASELINE = """rolling AS (
  SELECT *, count(total_sessions) OVER w AS baseline_window_count,
    round(avg(total_sessions) OVER w, 4) AS m, round(stddev_pop(total_sessions) OVER w, 4) AS s
  FROM funnel WINDOW w AS (ORDER BY window_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
), scored AS (
  SELECT *, CASE WHEN baseline_window_count >= 2 THEN m END AS baseline_session_mean,
    CASE WHEN baseline_window_count >= 2 THEN s END AS baseline_session_stddev,
    CASE WHEN baseline_window_count >= 2 THEN round((total_sessions - m) / greatest(s, 0.1), 4) END AS traffic_z_score
  FROM rolling
)"""


def _alerts(source: str, spike: str, drop: str) -> str:
    return f"""tested AS (
  SELECT *, {spike} AS spike, {drop} AS fall,
    page_view_sessions >= 5 AND coalesce(page_to_purchase_rate, 0) < 3 AS low,
    add_to_cart_sessions >= 5 AND coalesce(cart_to_purchase_rate, 0) < 20 AS cart
  FROM {source}
), alerts AS (
  SELECT *, concat_ws(',', CASE WHEN spike THEN 'traffic_spike' END, CASE WHEN fall THEN 'traffic_drop' END,
      CASE WHEN low THEN 'low_purchase_conversion' END, CASE WHEN cart THEN 'cart_abandonment_risk' END)
      AS alert_types,
    CAST(spike AS INTEGER) + CAST(fall AS INTEGER) + CAST(low AS INTEGER) + CAST(cart AS INTEGER) AS alert_count,
    CASE WHEN spike OR low THEN 'high' WHEN cart THEN 'medium' ELSE 'low' END AS severity
  FROM tested WHERE spike OR fall OR low OR cart
)"""


_FIXED = ("total_sessions >= 20", "total_sessions > 0 AND total_sessions <= 2")
_FIXED_ALERTS = _alerts("funnel", *_FIXED)


def _z_alerts(threshold: float) -> str:
    return _alerts(
        "scored",
        f"CASE WHEN traffic_z_score IS NOT NULL THEN traffic_z_score >= {threshold} ELSE {_FIXED[0]} END",
        f"CASE WHEN traffic_z_score IS NOT NULL THEN traffic_z_score <= -{threshold} ELSE {_FIXED[1]} END",
    )


_CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"

_WINDOW = f"{_ts('window_start')}, {_ts('window_end')}"
_FUNNEL_COLUMNS = (
    f"{_WINDOW}, total_sessions, total_users, page_view_sessions, product_view_sessions, add_to_cart_sessions,"
    " purchase_sessions, round(page_to_product_rate, 4) AS page_to_product_rate,"
    " round(product_to_cart_rate, 4) AS product_to_cart_rate,"
    " round(cart_to_purchase_rate, 4) AS cart_to_purchase_rate,"
    " round(page_to_purchase_rate, 4) AS page_to_purchase_rate"
)
_ALERT_COLUMNS = (
    f"{_WINDOW}, total_sessions, page_view_sessions, add_to_cart_sessions, purchase_sessions,"
    " round(page_to_purchase_rate, 4) AS page_to_purchase_rate,"
    " round(cart_to_purchase_rate, 4) AS cart_to_purchase_rate, alert_types, alert_count, severity"
)
_Z_COLUMNS = "baseline_window_count, baseline_session_mean, baseline_session_stddev, traffic_z_score"

_RESULTS = """results AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'pandas' WHEN 'R' THEN 'pyspark' ELSE 'other' END AS engine,
    CASE WHEN l_linenumber < 7 THEN l_linenumber || '00,000' ELSE 'full' END AS row_limit_label,
    round(sum(l_quantity) / 1000, 4) AS duration_seconds, count(*) AS row_count
  FROM lineitem GROUP BY ALL
), profiles AS (
  SELECT engine, row_limit_label, row_count, duration_seconds,
    CASE WHEN engine = 'pyspark' THEN CAST(9.127 AS DOUBLE) END AS startup_seconds,
    round(duration_seconds + CASE WHEN engine = 'pyspark' THEN CAST(9.127 AS DOUBLE) ELSE 0 END, 4)
      AS time_to_first_result_seconds,
    CASE WHEN duration_seconds > 0 THEN round(row_count / duration_seconds, 4) END AS rows_per_second
  FROM results
), best AS (
  SELECT * FROM profiles
  QUALIFY row_number() OVER (PARTITION BY engine ORDER BY row_limit_label = 'full' DESC, row_count DESC) = 1
)"""

_REPORTS = f"""daily AS (
  SELECT CAST(event_timestamp AS DATE) AS run_day, count(*) AS events FROM clicks GROUP BY ALL
), last_window AS (
  SELECT CAST(window_start AS DATE) AS run_day, arg_max(total_sessions, window_end) AS sessions,
    arg_max(total_users, window_end) AS users
  FROM funnel GROUP BY ALL
), per_type AS (
  SELECT CAST(event_timestamp AS DATE) AS run_day, event_type, count(*) AS n FROM clicks GROUP BY ALL
), listed AS (
  SELECT run_day, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts_by_type
  FROM per_type GROUP BY ALL
), alarms AS (
  SELECT CAST(window_start AS DATE) AS run_day, CAST(sum(alert_count) AS BIGINT) AS alert_count,
    arg_min(severity, window_start) AS severity
  FROM alerts GROUP BY ALL
), reports AS (
  SELECT run_day, 'clicks-' || strftime(run_day, '%Y%m%d') AS query_name, events AS generated_event_count,
    sessions AS generated_session_count, users AS generated_user_count, counts_by_type,
    round(events * 1.5 / 1000, 4) AS end_to_end_seconds,
    round(events / round(events * 1.5 / 1000, 4), 4) AS events_per_second,
    round(sessions / round(events * 1.5 / 1000, 4), 4) AS sessions_per_second,
    events / 4 AS observed_processed_rows_per_second, coalesce(alert_count, 0) AS alert_count, severity
  FROM daily JOIN last_window USING (run_day) JOIN listed USING (run_day) LEFT JOIN alarms USING (run_day)
)"""
_REPORTED = _with(_CLICKS, _HOURS, _METRICS, _FUNNEL, _FIXED_ALERTS, _REPORTS)

# A row is late if its window had ended by the watermark of the run before; a run ends with a batch without data.
_LATE = _with(
    """span AS (
  SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // 6 + 1 AS width FROM events
), filed AS (SELECT events.*, CAST((epoch_us(ts) - lo) // width AS INTEGER) AS own FROM events, span
), placed AS (
  SELECT ts, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start,
    time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view' WHEN 'signup' THEN 'add_to_cart'
      ELSE event_type END AS event_type,
    CASE WHEN event_id % 37 = 0 AND own < 4 THEN own + 2 ELSE own END AS file
  FROM filed
), marks AS (
  SELECT k, (SELECT max(ts) FROM placed WHERE file < k) - INTERVAL '10 minutes' AS mark FROM range(0, 6) AS r(k)
), marked AS (
  SELECT placed.*, coalesce(window_end <= mark, false) AS late FROM placed JOIN marks ON k = file
), counted AS (
  SELECT window_start, window_end, event_type, count(*) AS event_count,
    window_end > (SELECT max(ts) FROM placed) - INTERVAL '10 minutes' AS open
  FROM marked WHERE NOT late GROUP BY window_start, window_end, event_type
)"""
)

_PLACE = (
    "count(*) AS trip_count, round(sum(total_amount), 2) AS sum_total_amount,"
    " round(avg(total_amount), 4) AS avg_total_amount, round(avg(trip_distance), 4) AS avg_trip_distance,"
    " round(avg(tip_pct), 4) AS avg_tip_pct"
)
_LAYOUTS = "(VALUES ('unpartitioned'), ('by_month'), ('by_month_flag')) AS names(layout)"
_COMPARED = """compared AS (
  SELECT 'batch' AS pipeline, engine || ' / ' || row_limit_label AS variant,
    'bounded NYC Taxi aggregation' AS workload, time_to_first_result_seconds AS latency_seconds,
    rows_per_second AS throughput, 'rows/s' AS throughput_unit, row_count AS record_count FROM best
  UNION ALL
  SELECT 'streaming', query_name, 'clickstream event burst', end_to_end_seconds, events_per_second, 'events/s',
    generated_event_count FROM reports
)"""
_COMPARISON = _with(_RESULTS, _CLICKS, _HOURS, _METRICS, _FUNNEL, _FIXED_ALERTS, _REPORTS, _COMPARED)

_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, " + _ts("o_orderdate")
_BEFORE = "o_orderdate < TIMESTAMP '1997-01-01'"

ORACLE: dict[str, str] = {
    "trips_enriched": _TRIPS
    + f"""SELECT {_ts("pickup_ts")}, {_day("pickup_date")}, pickup_hour, PULocationID, DOLocationID, pickup_borough,
  pickup_zone, pickup_service_zone, dropoff_borough, dropoff_zone, dropoff_service_zone, payment_type_label,
  round(passenger_count, 8) AS passenger_count, round(trip_distance, 8) AS trip_distance,
  round(fare_amount, 8) AS fare_amount, round(tip_ratio, 8) AS tip_ratio, round(tip_pct, 8) AS tip_pct FROM yearly""",
    "trip_summary": _ALL_TRIPS
    + f"""SELECT count(*) AS row_count, count(DISTINCT pickup_date) AS active_days,
  {_ts("min(pickup_ts)", "min_pickup_ts")}, {_ts("max(pickup_ts)", "max_pickup_ts")},
  round(avg(passenger_count), 4) AS avg_passenger_count, round(avg(trip_distance), 4) AS avg_trip_distance,
  count(DISTINCT pickup_borough) AS active_pickup_boroughs, round(avg(total_amount), 4) AS avg_total_amount,
  round(sum(total_amount), 2) AS sum_total_amount, round(sum(tip_amount), 2) AS sum_tip_amount,
  round(avg(tip_pct), 4) AS avg_tip_pct FROM dated""",
    "trips_hourly": _ALL_TRIPS
    + f"""SELECT {_day("pickup_date")}, pickup_hour, count(*) AS trip_count,
  round(sum(total_amount), 2) AS sum_total_amount FROM dated GROUP BY dated.pickup_date, pickup_hour""",
    "trips_by_borough": _ALL_TRIPS + f"SELECT pickup_borough, {_PLACE} FROM dated GROUP BY 1",
    "trips_by_zone": _ALL_TRIPS
    + f"SELECT pickup_borough, pickup_zone, pickup_service_zone, {_PLACE} FROM dated GROUP BY 1, 2, 3",
    "payment_tip_summary": _ALL_TRIPS
    + """SELECT payment_type, payment_type_label, count(*) AS trip_count, round(avg(fare_amount), 4) AS avg_fare_amount,
  round(sum(fare_amount), 2) AS sum_fare_amount, round(avg(tip_amount), 4) AS avg_tip_amount,
  round(sum(tip_amount), 2) AS sum_tip_amount, round(avg(tip_pct), 4) AS avg_tip_pct,
  round(sum(total_amount), 2) AS sum_total_amount,
  CASE WHEN sum(fare_amount) > 0 THEN round(sum(tip_amount) / sum(fare_amount) * 100.0, 4) END AS tip_to_fare_pct
FROM dated GROUP BY 1, 2""",
    "trip_suite": _TRIPS
    + """, parts AS (
  SELECT 'summary' AS table_name, '' AS row_key, * FROM yearly
  UNION ALL SELECT 'hourly', strftime(pickup_ts, '%Y-%m-%d %H'), * FROM yearly
  UNION ALL SELECT 'borough_summary', pickup_borough, * FROM yearly
  UNION ALL SELECT 'zone_summary', concat_ws('/', pickup_borough, pickup_zone, pickup_service_zone), * FROM yearly
  UNION ALL SELECT 'payment_tip_summary', payment_type || '/' || payment_type_label, * FROM yearly
)
SELECT table_name, row_key, count(*) AS trips, round(sum(total_amount), 2) AS sum_total_amount,
  CASE WHEN table_name = 'summary' THEN round(avg(passenger_count), 4) END AS avg_passenger_count,
  CASE WHEN table_name IN ('summary', 'borough_summary', 'zone_summary') THEN round(avg(trip_distance), 4) END
    AS avg_trip_distance,
  CASE WHEN table_name <> 'hourly' THEN round(avg(tip_pct), 4) END AS avg_tip_pct,
  CASE WHEN table_name = 'payment_tip_summary' AND sum(fare_amount) > 0
    THEN round(sum(tip_amount) / sum(fare_amount) * 100.0, 4) END AS tip_to_fare_pct
FROM parts GROUP BY table_name, row_key""",
    "top10_zones": _ALL_TRIPS
    + f"""SELECT pickup_borough, pickup_zone, pickup_service_zone, {_PLACE} FROM dated GROUP BY 1, 2, 3
ORDER BY sum(total_amount) DESC LIMIT 10""",
    "top_payment_tip_share": _ALL_TRIPS
    + """SELECT payment_type_label, payment_type,
  CASE WHEN sum(fare_amount) > 0 THEN round(sum(tip_amount) / sum(fare_amount) * 100.0, 4) END AS tip_to_fare_pct
FROM dated GROUP BY 1, 2 ORDER BY 3 DESC NULLS LAST LIMIT 10""",
    "hourly_series": _ALL_TRIPS
    + f"SELECT {_ts('h', 'hour_bucket')}, trip_count FROM (SELECT date_trunc('hour', pickup_ts) AS h,"
    " count(*) AS trip_count FROM dated GROUP BY 1)",
    "summary_transpose": _ALL_TRIPS
    + """, one AS (SELECT CAST(count(*) AS VARCHAR) AS n, CAST(count(DISTINCT pickup_date) AS VARCHAR) AS d,
  strftime(min(pickup_ts), '%Y-%m-%d %H:%M:%S') AS a, strftime(max(pickup_ts), '%Y-%m-%d %H:%M:%S') AS z FROM dated)
SELECT 'row_count' AS metric, n AS "value" FROM one UNION ALL SELECT 'active_days', d FROM one
UNION ALL SELECT 'min_pickup_ts', a FROM one UNION ALL SELECT 'max_pickup_ts', z FROM one""",
    "first_trips": _ALL_TRIPS
    + f"""SELECT {_ts("p.pickup_ts", "pickup_ts")}, PULocationID, DOLocationID, round(fare_amount, 8) AS fare_amount,
  round(total_amount, 8) AS total_amount
FROM (SELECT * FROM dated ORDER BY dated.pickup_ts, PULocationID, DOLocationID, dated.fare_amount LIMIT 500) AS p""",
    "dq_summary": _QUALITY
    + "SELECT count(*) AS total_rows, count(*) FILTER (WHERE dq_issue_count > 0) AS issue_rows, "
    + ", ".join(f"count(*) FILTER (WHERE dq_{name}) AS {name}_rows" for name in _RULES)
    + """, count(*) FILTER (WHERE dq_issue_count = 0) AS clean_rows,
  round(count(*) FILTER (WHERE dq_issue_count > 0) / count(*) * 100.0, 4) AS issue_rate_pct FROM flagged""",
    "dq_issue_histogram": _QUALITY
    + """SELECT issue, count(*) AS "rows" FROM (SELECT unnest(string_split(dq_issue_names, ',')) AS issue
  FROM flagged WHERE dq_issue_count > 0) GROUP BY 1""",
    "dq_issue_report": _QUALITY
    + """, named_issues AS (SELECT unnest(string_split(dq_issue_names, ',')) AS issue FROM flagged WHERE dq_issue_count > 0
), sized AS (SELECT issue || '=' || count(*) AS part FROM named_issues GROUP BY issue)
SELECT count(*) AS total_records, count(*) FILTER (WHERE dq_issue_count > 0) AS issue_rows,
  count(*) FILTER (WHERE dq_issue_count = 0) AS clean_rows, (SELECT string_agg(part, ',' ORDER BY part) FROM sized) AS issue_types
FROM flagged""",
    "dq_issue_rows": _QUALITY + f"SELECT {_ISSUE_ROW} FROM flagged WHERE dq_issue_count > 0",
    "dq_worst_rows": _QUALITY
    + f"""SELECT {_ISSUE_ROW} FROM (SELECT * FROM flagged WHERE dq_issue_count > 0
  ORDER BY dq_issue_count DESC, {_TIES} LIMIT 200)""",
    "dq_issue_combinations": _QUALITY
    + 'SELECT dq_issue_names, dq_issue_count, count(*) AS "rows" FROM flagged GROUP BY 1, 2',
    "dq_duplicates": _with(_RAW)
    + f"""SELECT VendorID, {_ts("pickup_ts")}, {_ts("tpep_dropoff_datetime")}, PULocationID, DOLocationID,
  round(passenger_count, 8) AS passenger_count, round(trip_distance, 8) AS trip_distance,
  round(fare_amount, 8) AS fare_amount, round(total_amount, 8) AS total_amount, copies
FROM (SELECT {_SIGNATURE}, count(*) AS copies FROM trips WHERE {_COMPLETE} GROUP BY ALL HAVING count(*) > 1)""",
    "dq_future_ts": _with(_RAW)
    + """SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE pickup_ts > TIMESTAMP '1998-06-01') AS no_future_trip_datetime_rows
FROM trips""",
    "batch_job": _with(
        _RAW,
        _ZONES.replace("n_name AS zone", "CASE WHEN s_suppkey % 17 = 5 THEN 'N/A' ELSE n_name END AS zone"),
        _NAMED,
        _FLAGGED,
        _YEARLY,
    )
    + """SELECT 'summary' AS table_name, CAST(1 AS BIGINT) AS table_rows, count(*) AS trips,
  round(sum(total_amount), 2) AS sum_amount FROM yearly
UNION ALL SELECT 'hourly', count(DISTINCT date_trunc('hour', pickup_ts)), count(*), round(sum(total_amount), 2) FROM yearly
UNION ALL SELECT 'borough_summary', count(DISTINCT pickup_borough), count(*), round(sum(total_amount), 2) FROM yearly
UNION ALL SELECT 'zone_summary', count(DISTINCT (pickup_borough, pickup_zone, pickup_service_zone)), count(*),
  round(sum(total_amount), 2) FROM yearly
UNION ALL SELECT 'payment_tip_summary', count(DISTINCT payment_type), count(*), round(sum(total_amount), 2) FROM yearly
UNION ALL SELECT 'quality_summary', 1, count(*), NULL FROM flagged
UNION ALL SELECT 'quality_issue_rows', count(*), count(*), round(sum(total_amount), 2) FROM flagged
  WHERE dq_issue_count > 0""",
    "event_json_roundtrip": _with(_CLICKS)
    + f"""SELECT event_id, user_id, session_id, event_type, page, product_id, {_ts("event_timestamp")},
  {_ts("event_timestamp", "kafka_timestamp")} FROM clicks""",
    "click_rejects": _with(_CLICKS)
    + f"""SELECT {_ts("event_timestamp", "kafka_timestamp")},
  CASE WHEN CAST(event_id AS BIGINT) % 101 <> 0 THEN page END AS page_of_readable_json
FROM clicks WHERE CAST(event_id AS BIGINT) % 101 = 0 OR CAST(event_id AS BIGINT) % 103 = 0""",
    "click_dq_report": _with(_CLICKS)
    + """SELECT count(*) AS total_records, count(*) FILTER (WHERE page IS NULL) AS missing_required_rows,
  count(*) FILTER (WHERE total_amount < 0) AS negative_value_rows FROM clicks""",
    "click_dq_missing_fields": _with(_CLICKS)
    + """SELECT CASE WHEN page IS NULL THEN 'page' ELSE '' END AS missing_fields, count(*) AS "rows"
FROM clicks GROUP BY 1""",
    "click_negative_values": _with(_CLICKS)
    + """SELECT event_id, 'total_amount' AS fields, round(total_amount, 4) AS "value"
FROM clicks WHERE total_amount < 0""",
    "click_duplicate_ids": """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(2 AS BIGINT) AS copies
FROM events WHERE event_id % 89 = 0""",
    "click_window_metrics": _with(_CLICKS, _HOURS, _METRICS)
    + f"SELECT {_WINDOW}, event_type, event_count, unique_users, unique_sessions FROM metrics",
    "click_window_approx": _with(_CLICKS, _HOURS, _METRICS)
    + f"""SELECT {_WINDOW}, event_type, event_count, true AS unique_users_same, true AS unique_sessions_same
FROM metrics""",
    "click_days_from_hours": _with(_CLICKS, _DAYS, _FUNNEL, _EVENTS_PER_WINDOW)
    + f"SELECT {_FUNNEL_COLUMNS}, event_count FROM funnel JOIN sizes USING (window_start, window_end)",
    "click_sliding_from_quarters": _with(_CLICKS, _SLIDING, _FUNNEL) + f"SELECT {_FUNNEL_COLUMNS} FROM funnel",
    "click_skipped_stages": _with(_CLICKS, _DAYS)
    + f"""SELECT {_WINDOW}, count(*) FILTER (product_view AND NOT page_view) AS product_view_without_page_view,
  count(*) FILTER (add_to_cart AND NOT product_view) AS add_to_cart_without_product_view,
  count(*) FILTER (purchase AND NOT add_to_cart) AS purchase_without_add_to_cart
FROM (SELECT window_start, window_end, session_id, bool_or(event_type = 'page_view') AS page_view,
    bool_or(event_type = 'product_view') AS product_view, bool_or(event_type = 'add_to_cart') AS add_to_cart,
    bool_or(event_type = 'purchase') AS purchase
  FROM windowed GROUP BY ALL) AS sessions GROUP BY sessions.window_start, sessions.window_end""",
    "click_window_sliding": _with(_CLICKS, _SLIDING, _METRICS)
    + f"SELECT {_WINDOW}, event_type, event_count, unique_users, unique_sessions FROM metrics",
    "click_funnel": _with(_CLICKS, _HOURS, _FUNNEL) + f"SELECT {_FUNNEL_COLUMNS} FROM funnel",
    "funnel_rate_report": _with(_CLICKS, _HOURS, _FUNNEL)
    + f"""SELECT {_ts("window_start")}, round(page_to_product_rate, 4) AS page_view_to_product_view,
  round(product_to_cart_rate, 4) AS product_view_to_add_to_cart, round(cart_to_purchase_rate, 4) AS add_to_cart_to_purchase,
  round(page_to_purchase_rate, 4) AS page_view_to_purchase FROM funnel""",
    "click_alerts": _with(_CLICKS, _HOURS, _FUNNEL, _FIXED_ALERTS) + f"SELECT {_ALERT_COLUMNS} FROM alerts",
    "click_totals": _with(_CLICKS)
    + """SELECT count(*) AS generated_event_count, count(DISTINCT session_id) AS generated_session_count,
  count(DISTINCT user_id) AS generated_user_count FROM clicks""",
    "click_type_counts": _with(_CLICKS) + "SELECT event_type, count(*) AS event_count FROM clicks GROUP BY 1",
    "event_mix_latest": _with(_CLICKS, _HOURS, _METRICS)
    + """SELECT event_type, CAST(sum(event_count) AS BIGINT) AS event_count FROM metrics
WHERE window_end = (SELECT max(window_end) FROM metrics) GROUP BY 1""",
    "funnel_unpivot": _with(_CLICKS, _HOURS, _FUNNEL)
    + """, last AS (SELECT * FROM funnel ORDER BY window_end DESC LIMIT 1)
SELECT 'page_view' AS stage, page_view_sessions AS sessions FROM last
UNION ALL SELECT 'product_view', product_view_sessions FROM last
UNION ALL SELECT 'add_to_cart', add_to_cart_sessions FROM last
UNION ALL SELECT 'purchase', purchase_sessions FROM last""",
    "traffic_zscore": _with(_CLICKS, _HOURS, _FUNNEL, _BASELINE)
    + f"SELECT {_ts('window_start')}, total_sessions, {_Z_COLUMNS} FROM scored",
    "traffic_zscore_recent": _with(_CLICKS, _windows("15 minutes", 15, 1), _METRICS)
    + f"""SELECT {_ts('window_start')}, event_type, event_count, n AS baseline_window_count,
  CASE WHEN n >= 2 THEN m END AS baseline_session_mean, CASE WHEN n >= 2 THEN s END AS baseline_session_stddev,
  CASE WHEN n >= 2 THEN round((event_count - m) / greatest(s, 0.1), 4) END AS traffic_z_score
FROM (SELECT *, count(event_count) OVER w AS n, round(avg(event_count) OVER w, 4) AS m,
    round(stddev_pop(event_count) OVER w, 4) AS s
  FROM metrics WINDOW w AS (PARTITION BY event_type ORDER BY window_start
    RANGE BETWEEN INTERVAL '6 hours' PRECEDING AND INTERVAL '1 microsecond' PRECEDING))""",
    "zscore_alerts": _with(_CLICKS, _HOURS, _FUNNEL, _BASELINE, _z_alerts(2))
    + f"SELECT {_ALERT_COLUMNS}, {_Z_COLUMNS}, 'zscore_vs_recent_hour' AS anomaly_model FROM alerts",
    "zscore_alerts_latest": _with(_CLICKS, _HALF_DAYS, _FUNNEL, _BASELINE, _z_alerts(0.8))
    + f"""SELECT {_ALERT_COLUMNS}, {_Z_COLUMNS}, 'zscore_vs_recent_hour' AS anomaly_model FROM alerts
WHERE alerts.window_end = (SELECT max(window_end) FROM funnel)""",
    "traffic_baseline": _with(_CLICKS, _HOURS, _FUNNEL)
    + """SELECT count(*) AS lookback_window_count, round(avg(total_sessions), 4) AS mean_total_sessions,
  round(stddev_pop(total_sessions), 4) AS stddev_total_sessions FROM funnel""",
    "stream_window_append": _with(_CLICKS, _HOURS, _METRICS)
    + f"SELECT {_WINDOW}, event_type, event_count FROM metrics WHERE metrics.{_CLOSED}",
    "stream_memory": _with(_CLICKS, _HOURS, _METRICS)
    + f"SELECT {_WINDOW}, event_type, event_count FROM metrics WHERE metrics.{_CLOSED}",
    "stream_restart": _LATE
    + f"SELECT {_WINDOW}, event_type, event_count FROM counted WHERE NOT open",
    "stream_open_windows": _LATE
    + f"""SELECT {_WINDOW}, event_type, event_count, CASE WHEN open THEN 'open' ELSE 'closed' END AS state
FROM counted""",
    "stream_dropped_rows": _LATE
    + """SELECT count(DISTINCT (file, window_start, event_type)) AS dropped_groups, count(*) AS dropped_events
FROM marked WHERE late""",
    "stream_funnel_append": _with(_CLICKS, _HOURS, _FUNNEL)
    + f"SELECT {_FUNNEL_COLUMNS} FROM funnel WHERE funnel.{_CLOSED}",
    "stream_alerts": _with(_CLICKS, _HOURS, _FUNNEL, _FIXED_ALERTS)
    + f"SELECT {_ALERT_COLUMNS} FROM alerts WHERE alerts.{_CLOSED}",
    "stream_funnel_update": _with(_READABLE, _HOURS, _FUNNEL, _EVENTS_PER_WINDOW, _BASELINE)
    + f"""SELECT {_FUNNEL_COLUMNS}, event_count, {_Z_COLUMNS}
FROM scored JOIN sizes USING (window_start, window_end)""",
    "stream_alerts_update": _with(_READABLE, _HOURS, _FUNNEL, _BASELINE, _z_alerts(2))
    + f"SELECT {_ALERT_COLUMNS}, {_Z_COLUMNS}, 'zscore_vs_recent_hour' AS anomaly_model FROM alerts",
    "stream_dq_report": _with(_CLICKS)
    + """SELECT count(*) AS total_records, count(*) FILTER (WHERE page IS NULL) AS missing_required_rows,
  count(*) FILTER (WHERE total_amount < 0) AS negative_value_rows FROM clicks""",
    "stream_rejects": f"""SELECT {_ts("ts", "kafka_timestamp")},
  CASE WHEN event_id % 101 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
  CASE WHEN event_id % 101 <> 0 THEN 'yesterday' END AS "timestamp" FROM events
WHERE event_id % 101 = 0 OR event_id % 103 = 0""",
    "stream_first_delivery": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, {_ts("ts", "event_timestamp")}
FROM events""",
    "stream_progress": "SELECT 'watched' AS query_name, count(*) AS input_rows FROM events",
    "layout_pruned_query": f"""SELECT layout, '1997-03' AS ship_month, 'A' AS l_returnflag, count(*) AS matched_rows,
  round(sum(l_extendedprice), 2) AS sum_total_amount
FROM lineitem, {_LAYOUTS} WHERE strftime(l_shipdate, '%Y-%m') = '1997-03' AND l_returnflag = 'A' GROUP BY layout""",
    "layout_improvement": f"""WITH costs AS (SELECT layout, count(*) AS scanned_rows FROM lineitem, {_LAYOUTS}
  WHERE (layout = 'unpartitioned' OR strftime(l_shipdate, '%Y-%m') = '1997-03')
    AND (layout <> 'by_month_flag' OR l_returnflag = 'A') GROUP BY layout)
SELECT layout, scanned_rows, CASE WHEN layout <> 'unpartitioned' THEN round(
  ((SELECT count(*) FROM lineitem) - scanned_rows) * 100.0 / (SELECT count(*) FROM lineitem), 2) END
  AS improvement_vs_unpartitioned_pct FROM costs""",
    "layout_timing": """SELECT layout, round(avg(s), 4) AS avg_seconds, round(min(s), 4) AS min_seconds,
  round(max(s), 4) AS max_seconds
FROM (SELECT l_returnflag AS layout, sum(l_quantity) / 1000 AS s FROM lineitem GROUP BY l_returnflag, l_linenumber)
GROUP BY layout""",
    "version_as_of": f"SELECT {_ORDER_COLUMNS} FROM orders WHERE orders.{_BEFORE}",
    "schema_evolved_read": f"""SELECT {_ORDER_COLUMNS},
  CASE WHEN orders.{_BEFORE} THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "schema_diff": """SELECT 'added' AS change, 5 AS "position", 'o_orderpriority' AS name, 'string' AS type""",
    "version_history": f"""SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, true AS "replaces",
  count(*) AS num_rows FROM orders WHERE {_BEFORE}
UNION ALL SELECT 1, 'WRITE', false, count(*) FROM orders WHERE NOT {_BEFORE} AND o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT 2, 'WRITE', false, count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
UNION ALL SELECT 3, 'OPTIMIZE', true, count(*) FROM orders""",
    "version_compare": f"""SELECT CAST(0 AS BIGINT) AS version, count(*) AS row_count,
  'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate' AS columns FROM orders WHERE {_BEFORE}
UNION ALL SELECT 1, count(*), 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority'
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT 2, count(*), 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority'
  FROM orders""",
    "migrate_reconcile": """SELECT count(*) AS input_rows, count(*) AS output_rows, true AS rows_match,
  true AS content_match, 0 AS version FROM orders""",
    "compact_files": "SELECT count(*) AS rows_after, true AS fewer_files, true AS content_match FROM orders",
    "zorder_files_touched": """SELECT * FROM (VALUES ('event_date', true), ('channel', true), ('l_partkey', true))
  AS t("column", within_bound)""",
    "zorder_content": """SELECT count(*) AS input_rows, count(*) AS output_rows, true AS rows_match,
  true AS content_match FROM lineitem""",
    "dataset_profile": """SELECT 'yellow' AS dataset_variant, 'tpep_pickup_datetime' AS pickup_timestamp_column,
  count(*) + count(*) FILTER (WHERE l_orderkey % 97 = 0) AS total_rows, true AS has_files FROM lineitem""",
    "mixed_trip_files": _ALL_TRIPS
    + f"""SELECT payment_type, count(*) AS trip_count, round(avg(passenger_count), 4) AS avg_passenger_count,
  round(sum(fare_amount), 2) AS sum_fare_amount, {_ts("min(pickup_ts)", "min_pickup_ts")},
  {_ts("max(tpep_dropoff_datetime)", "max_dropoff_ts")}, count(DISTINCT VendorID) AS vendors,
  count(DISTINCT (PULocationID, DOLocationID)) AS routes FROM dated GROUP BY payment_type""",
    "role_recommendation": """SELECT *, (SELECT count(*) + count(*) FILTER (WHERE l_orderkey % 97 = 0) FROM lineitem)
  AS total_rows FROM (VALUES
  (0, 'pickup_timestamp', 'tpep_pickup_datetime', 'timestamp'),
  (1, 'dropoff_timestamp', 'tpep_dropoff_datetime', 'timestamp'),
  (2, 'pickup_zone', 'PULocationID', 'bigint'), (3, 'dropoff_zone', 'DOLocationID', 'bigint'),
  (4, 'passenger_count', 'passenger_count', 'double'), (5, 'trip_distance', 'trip_distance', 'double'),
  (6, 'payment_type', 'payment_type', 'bigint'), (7, 'fare_amount', 'fare_amount', 'double'),
  (8, 'tip_amount', 'tip_amount', 'double'), (9, 'total_amount', 'total_amount', 'double')
) AS t("position", role, "column", type)""",
    "schema_table": """SELECT *, (SELECT count(*) FROM orders) AS total_rows
FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'),
  (2, 'o_orderstatus', 'string'), (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'),
  (5, 'o_orderpriority', 'string')) AS t("position", name, type)""",
    "variant_pivot_ratio": _with(_RESULTS)
    + """SELECT row_limit_label AS row_limit, a AS pandas_seconds, b AS pyspark_seconds,
  CASE WHEN a > 0 THEN round(b / a, 3) END AS spark_vs_pandas_ratio
FROM (SELECT row_limit_label, max(duration_seconds) FILTER (engine = 'pandas') AS a,
  max(duration_seconds) FILTER (engine = 'pyspark') AS b FROM results GROUP BY 1)""",
    "throughput_profile": _with(_RESULTS) + "SELECT * FROM profiles",
    "best_variant": _with(_RESULTS) + "SELECT * FROM best",
    "preferred_result": _with(_RESULTS)
    + """SELECT engine, row_limit_label, row_count FROM results
WHERE engine = 'pyspark' AND row_limit_label = 'full'""",
    "pipeline_comparison": _COMPARISON
    + """SELECT pipeline, variant, workload, latency_seconds, throughput, throughput_unit, record_count FROM compared""",
    "fastest_batch": _COMPARISON
    + """SELECT variant, latency_seconds FROM compared WHERE pipeline = 'batch' ORDER BY latency_seconds LIMIT 1""",
    "timing_summary": f"""WITH runs AS (
  SELECT d, count(*) AS event_count, count(DISTINCT user_id) AS session_count,
    CASE WHEN extract(day FROM d) % 7 <> 0 THEN count(*) FILTER (WHERE event_type = 'view') / 1000 END AS p,
    count(*) FILTER (WHERE event_type = 'click') / 100 AS q
  FROM (SELECT *, CAST(ts AS DATE) AS d FROM events) GROUP BY d
), timed AS (SELECT *, round(p + q, 4) AS e FROM runs)
SELECT {_day("d", "run_day")}, event_count, session_count, round(p, 4) AS publish_seconds,
  round(q, 4) AS processing_seconds, e AS end_to_end_seconds,
  CASE WHEN e > 0 THEN round(event_count / e, 4) END AS events_per_second,
  CASE WHEN e > 0 THEN round(session_count / e, 4) END AS sessions_per_second FROM timed""",
    "report_backfill": _REPORTED
    + f"""SELECT {_day("run_day")}, generated_event_count, generated_session_count, generated_user_count, counts_by_type,
  CAST(NULL AS DOUBLE) AS publish_seconds, end_to_end_seconds AS processing_seconds, end_to_end_seconds,
  events_per_second, sessions_per_second FROM reports""",
    "stream_profile": _REPORTED
    + """SELECT query_name, generated_event_count, generated_session_count, CAST(NULL AS DOUBLE) AS publish_seconds,
  end_to_end_seconds AS processing_seconds, end_to_end_seconds, events_per_second, sessions_per_second,
  observed_processed_rows_per_second, alert_count, severity FROM reports""",
    "report_json": _REPORTED
    + """SELECT query_name, generated_event_count, generated_session_count, CAST(NULL AS DOUBLE) AS publish_seconds,
  end_to_end_seconds AS processing_seconds, end_to_end_seconds, events_per_second, sessions_per_second,
  observed_processed_rows_per_second, alert_count, severity FROM reports""",
    "report_variant": _REPORTED
    + f"""SELECT {_day("run_day")}, CASE extract(day FROM run_day) % 5 WHEN 2
    THEN '{{"host":"node-1","tags":["a",{{"b":2}}]}}' ELSE '{{}}' END AS extra, query_name, generated_event_count,
  generated_session_count, CAST(NULL AS DOUBLE) AS publish_seconds, end_to_end_seconds AS processing_seconds,
  end_to_end_seconds, events_per_second, sessions_per_second, observed_processed_rows_per_second, alert_count, severity,
  'read' AS state FROM reports WHERE extract(day FROM run_day) % 5 <> 0
UNION ALL SELECT {_day("run_day")}, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'broken'
FROM reports WHERE extract(day FROM run_day) % 5 = 0""",
    "table_preview": "SELECT o_orderkey, o_orderstatus, true AS found FROM orders",
    "readiness": """SELECT * FROM (VALUES ('Batch summary', 'ready'), ('Streaming demo', 'ready'),
  ('No such year', 'missing'), ('Not built', 'missing')) AS t(section, status)""",
    "kpi_headline": _with(_RAW, _ZONES, _NAMED, _DATED, _CLICKS, _HOURS, _FUNNEL, _FIXED_ALERTS)
    + """SELECT (SELECT count(*) FROM dated) AS batch_rows,
  (SELECT round(sum(total_amount), 4) FROM dated) AS total_revenue,
  (SELECT count(*) FROM clicks) AS streaming_events,
  (SELECT CAST(coalesce(sum(alert_count), 0) AS BIGINT) FROM alerts) AS streaming_alerts""",
}
ORACLE |= {name: ORACLE["dq_summary"] for name in ("dq_summary_audited", "dq_summary_observed")}
