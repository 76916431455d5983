"""Metric tables over enriched trips. A table whose key columns are absent is None."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions import measures as M
from kerbline.functions.expressions import percent

BOROUGH_KEYS = ("pickup_borough",)
ZONE_KEYS = ("pickup_borough", "pickup_zone")


def zone_keys(columns: Sequence[str]) -> list[str]:
    return [*ZONE_KEYS, *[c for c in ("pickup_service_zone",) if c in columns]]


def with_tip_share(df: DataFrame) -> DataFrame:
    """Tips over fares of the group: a ratio of sums, next to the mean of the rows' ratios."""
    if not {"sum_fare_amount", "sum_tip_amount"} <= set(df.columns):
        return df
    return df.withColumn("tip_to_fare_pct", percent(F.col("sum_tip_amount"), F.col("sum_fare_amount")))


def _grouped(df: DataFrame, keys: Sequence[str], wanted: Sequence[M.Measure]) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.direct() for m in M.available(wanted, df.columns)])


def summary(df: DataFrame) -> DataFrame:
    """One row about all trips."""
    distinct = [F.countDistinct("pickup_date").alias("active_days")]
    if "pickup_borough" in df.columns:
        distinct.append(F.countDistinct("pickup_borough").alias("active_pickup_boroughs"))
    return df.agg(*[m.direct() for m in M.available(M.SUMMARY, df.columns)], *distinct)


def hourly(df: DataFrame) -> DataFrame:
    return _grouped(df, ("pickup_date", "pickup_hour"), M.HOURLY).orderBy("pickup_date", "pickup_hour")


def by_borough(df: DataFrame) -> DataFrame | None:
    if not set(BOROUGH_KEYS) <= set(df.columns):
        return None
    table = _grouped(df, BOROUGH_KEYS, M.PLACE)
    return table.orderBy(*[F.desc(c) for c in ("sum_total_amount", "trip_count") if c in table.columns])


def by_zone(df: DataFrame) -> DataFrame | None:
    if not set(ZONE_KEYS) <= set(df.columns):
        return None
    table = _grouped(df, zone_keys(df.columns), M.PLACE)
    return table.orderBy(*[F.desc(c) for c in ("sum_total_amount", "trip_count") if c in table.columns])


def by_payment(df: DataFrame) -> DataFrame | None:
    if "payment_type_label" not in df.columns:
        return None
    keys = [c for c in ("payment_type", "payment_type_label") if c in df.columns]
    table = with_tip_share(_grouped(df, keys, M.PAYMENT))
    return table.orderBy(F.asc("payment_type"), F.desc("trip_count"))


def top(df: DataFrame, measure: str, count: int = 10) -> DataFrame:
    """The leading rows of a report table, ties settled by the other columns."""
    others = [F.asc(c) for c in df.columns if c != measure]
    return df.orderBy(F.desc_nulls_last(measure), *others).limit(count)


def hour_series(df: DataFrame) -> DataFrame:
    """Hourly table with date and hour as one time axis."""
    bucket = F.col("pickup_date").cast("timestamp") + F.make_dt_interval(hours=F.col("pickup_hour"))
    return df.withColumn("hour_bucket", bucket).orderBy("hour_bucket")
