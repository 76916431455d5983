"""Trip rows: typed columns, year filter, zone lookup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions import roles
from kerbline.functions.expressions import event_time, payment_label, percent, ratio
from kerbline.operators.lookup import BROADCAST_PLACES, fits_broadcast, left_lookup

NUMERIC = ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")
PLACE_ATTRIBUTES = {"Borough": "borough", "Zone": "zone", "service_zone": "service_zone"}
UNKNOWN_PLACE = "Unknown"


def prepare(df: DataFrame, *, keep_undated: bool = False) -> DataFrame:
    """Typed trip columns plus pickup date and hour, payment label and tip shares.

    Rows without a pickup time leave the analysis; quality checks keep them to count them.
    """
    moment = event_time(df, roles.pickup_time_column(df.columns))
    typed = df.withColumns(
        {"pickup_ts": moment, **{c: F.col(c).try_cast("double") for c in NUMERIC if c in df.columns}}
    )
    if not keep_undated:
        typed = typed.where(F.col("pickup_ts").isNotNull())

    derived = {"pickup_date": F.to_date("pickup_ts"), "pickup_hour": F.hour("pickup_ts")}
    if "payment_type" in df.columns:
        derived["payment_type_label"] = payment_label(F.col("payment_type"))
    if {"fare_amount", "tip_amount"} <= set(df.columns):
        derived["tip_ratio"] = ratio(F.col("tip_amount"), F.col("fare_amount"))
        derived["tip_pct"] = percent(F.col("tip_amount"), F.col("fare_amount"))
    return typed.withColumns(derived)


def in_year(df: DataFrame, year: int | None) -> DataFrame:
    """Trips picked up in `year`; as a half-open range, which the parquet scan can use (`year(ts) = y` it cannot)."""
    if year is None:
        return df
    start, end = (F.lit(datetime(y, 1, 1).isoformat(sep=" ")).cast("timestamp") for y in (year, year + 1))
    return df.where((F.col("pickup_ts") >= start) & (F.col("pickup_ts") < end))


def attach_zones(
    df: DataFrame,
    zones: DataFrame | None,
    *,
    ends: Sequence[str] = ("pickup", "dropoff"),
    max_broadcast_rows: int = BROADCAST_PLACES,
) -> DataFrame:
    """Place names of the wanted ends of a trip; places the dimension lacks are 'Unknown'.

    The dimension is unique by key, so no row is multiplied. It is broadcast after its size was measured; a larger one
    is joined by shuffle, with the locations that hold a large share of the trips handled apart.
    """
    if zones is None:
        return df
    small = fits_broadcast(zones, max_broadcast_rows)
    named = df
    filled: list[str] = []
    for end, candidates in (("pickup", roles.PICKUP_PLACE), ("dropoff", roles.DROPOFF_PLACE)):
        key = roles.pick(df.columns, candidates)
        if key is None or end not in ends:
            continue
        names = {attribute: f"{end}_{suffix}" for attribute, suffix in PLACE_ATTRIBUTES.items()}
        lookup = zones.select(F.col("LocationID").alias(key), *[F.col(a).alias(n) for a, n in names.items()])
        named = left_lookup(named, lookup, key, small=small)
        filled += names.values()
    return named.fillna(UNKNOWN_PLACE, subset=filled) if filled else named
