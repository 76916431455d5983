"""All trip metric tables from one pass over the trips.

The trips are grouped once, by several small keys at the same time (grouping sets), into partial counts and sums. The
partial aggregation runs next to the scan, so what is shuffled is bounded by keys per task and not by trips. Places are
grouped by their id: the zone dimension then joins one row per id instead of every trip, whatever its size. Hour and
payment tables are the rolled-up rows themselves; borough, zone and summary merge them further.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions import measures as M
from kerbline.functions import roles
from kerbline.functions.expressions import payment_label
from kerbline.operators import metrics, trips
from kerbline.session import settle

DAY = "day"
HOUR = "hour"
PLACE = "place"
PAYMENT = "payment"

_PLACE_KEY = "_place_id"
_KEYS = {
    DAY: ("pickup_date",),
    HOUR: ("pickup_date", "pickup_hour"),
    PLACE: (_PLACE_KEY,),
    PAYMENT: ("payment_type",),
}
# The summary is built from days or hours, so those carry its measures.
_MEASURES = {DAY: M.SUMMARY, HOUR: (*M.HOURLY, *M.SUMMARY), PLACE: M.PLACE, PAYMENT: M.PAYMENT}


def _grain_ids(sets: Sequence[Sequence[str]], keys: Sequence[str]) -> list[int]:
    """grouping_id() of each set: one bit per key, high bit first, set where the key is rolled up."""
    width = len(keys)
    return [sum(1 << (width - 1 - i) for i, key in enumerate(keys) if key not in chosen) for chosen in sets]


def rollup(prepared: DataFrame, grains: Sequence[str]) -> DataFrame:
    """Partial measures per grain, marked in `_grain`. Grains whose key column is absent are left out."""
    place = roles.pick(prepared.columns, roles.PICKUP_PLACE)
    rows = prepared.withColumn(_PLACE_KEY, F.col(place)) if place else prepared
    kept = [g for g in grains if set(_KEYS[g]) <= set(rows.columns)]
    keys = list(dict.fromkeys(key for g in kept for key in _KEYS[g]))
    wanted = M.available([m for g in kept for m in _MEASURES[g]], rows.columns)
    partials = M.partial_columns(wanted)
    if len(kept) == 1:
        return rows.groupBy(*keys).agg(F.lit(kept[0]).alias("_grain"), *partials)

    sets = [_KEYS[g] for g in kept]
    marked = rows.groupingSets(sets, *keys).agg(F.grouping_id().alias("_set"), *partials)
    grain = F.lit(None)
    for name, grain_id in zip(kept, _grain_ids(sets, keys), strict=True):
        grain = F.when(F.col("_set") == grain_id, name).otherwise(grain)
    return marked.withColumn("_grain", grain).drop("_set")


def _at(rolled: DataFrame, grain: str) -> DataFrame:
    return rolled.where(F.col("_grain") == grain)


def _present(rolled: DataFrame, wanted: Sequence[M.Measure]) -> list[M.Measure]:
    columns = set(rolled.columns)
    return [m for m in wanted if set(m.partials()) <= columns]


def _merged(rolled: DataFrame, wanted: Sequence[M.Measure]) -> list[Column]:
    return [m.merged() for m in _present(rolled, wanted)]


def _finished(rolled: DataFrame, wanted: Sequence[M.Measure]) -> list[Column]:
    return [m.finished() for m in _present(rolled, wanted)]


def _places(rolled: DataFrame, zones: DataFrame) -> DataFrame:
    """Partial rows per place with their names; the join is left to Catalyst, both sides have one row per place."""
    lookup = zones.select(
        F.col("LocationID").alias(_PLACE_KEY),
        F.col("Borough").alias("pickup_borough"),
        F.col("Zone").alias("pickup_zone"),
        F.col("service_zone").alias("pickup_service_zone"),
    )
    named = _at(rolled, PLACE).join(lookup, _PLACE_KEY, "left")
    return named.fillna(trips.UNKNOWN_PLACE, subset=["pickup_borough", "pickup_zone", "pickup_service_zone"])


def summary(rolled: DataFrame, zones: DataFrame | None = None, *, days: str = HOUR) -> DataFrame:
    """The one-row summary from the `days` grain (DAY or HOUR), and the borough count from the PLACE grain.

    Both grains go through one aggregate, so that rolled-up rows which are not stored are computed once.
    """
    own = F.col("_grain") == days
    partials = [c for m in _present(rolled, M.SUMMARY) for c in m.partials()]
    carried = {c: F.when(own, F.col(c)) for c in dict.fromkeys(partials)}
    measures = [*_merged(rolled, M.SUMMARY), F.countDistinct("pickup_date").alias("active_days")]
    if zones is None or _PLACE_KEY not in rolled.columns:
        return rolled.where(own).agg(*measures)
    both = rolled.where(own | (F.col("_grain") == PLACE)).withColumns(carried)
    places = zones.select(F.col("LocationID").alias(_PLACE_KEY), "Borough")
    borough = F.when(F.col("_grain") == PLACE, F.coalesce("Borough", F.lit(trips.UNKNOWN_PLACE)))
    return both.join(places, _PLACE_KEY, "left").agg(
        *measures, F.countDistinct(borough).alias("active_pickup_boroughs")
    )


def hourly(rolled: DataFrame) -> DataFrame:
    table = _at(rolled, HOUR).select("pickup_date", "pickup_hour", *_finished(rolled, M.HOURLY))
    return table.orderBy("pickup_date", "pickup_hour")


def by_borough(rolled: DataFrame, zones: DataFrame) -> DataFrame:
    table = _places(rolled, zones).groupBy(*metrics.BOROUGH_KEYS).agg(*_merged(rolled, M.PLACE))
    return table.orderBy(*[F.desc(c) for c in ("sum_total_amount", "trip_count") if c in table.columns])


def by_zone(rolled: DataFrame, zones: DataFrame) -> DataFrame:
    named = _places(rolled, zones)
    table = named.groupBy(*metrics.zone_keys(named.columns)).agg(*_merged(rolled, M.PLACE))
    return table.orderBy(*[F.desc(c) for c in ("sum_total_amount", "trip_count") if c in table.columns])


def by_payment(rolled: DataFrame) -> DataFrame:
    label = payment_label(F.col("payment_type")).alias("payment_type_label")
    table = metrics.with_tip_share(
        _at(rolled, PAYMENT).select("payment_type", label, *_finished(rolled, M.PAYMENT))
    )
    return table.orderBy(F.asc("payment_type"), F.desc("trip_count"))


def all_tables(raw: DataFrame, zones: DataFrame | None, year: int | None) -> dict[str, DataFrame]:
    """Every metric table that the schema allows, over rolled-up rows that are written once to the shared folder."""
    analysed = trips.in_year(trips.prepare(raw), year)
    rolled = settle(rollup(analysed, [HOUR, PLACE, PAYMENT]), "trip-rollup")
    tables = {"summary": summary(rolled, zones), "hourly": hourly(rolled)}
    if zones is not None and _PLACE_KEY in rolled.columns:
        tables["borough_summary"] = by_borough(rolled, zones)
        tables["zone_summary"] = by_zone(rolled, zones)
    if "payment_type" in rolled.columns:
        tables["payment_tip_summary"] = by_payment(rolled)
    return tables
