"""Measures that can be computed directly or merged from partial results.

Every aggregate of the trip tables is a count, sum, mean, minimum or maximum, so a coarse table can be built from a
finer one without touching the rows again: a mean travels as (sum, non-null count).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str
    column: str | None = None

    def direct(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1)).alias(self.name)
        return {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[self.kind](self.column).alias(self.name)

    def partials(self) -> dict[str, Column]:
        """Columns a finer table has to carry."""
        if self.kind == "count":
            return {"_rows": F.count(F.lit(1))}
        if self.kind == "avg":
            return {f"_sum_{self.column}": F.sum(self.column), f"_n_{self.column}": F.count(self.column)}
        aggregate = {"sum": F.sum, "min": F.min, "max": F.max}[self.kind]
        return {f"_{self.kind}_{self.column}": aggregate(self.column)}

    def finished(self) -> Column:
        """The measure of a single row of the finer table, when that is the wanted grain already."""
        if self.kind == "count":
            return F.col("_rows").alias(self.name)
        if self.kind == "avg":
            total, seen = F.col(f"_sum_{self.column}"), F.col(f"_n_{self.column}")
            return F.when(seen > 0, total / seen).alias(self.name)
        return F.col(f"_{self.kind}_{self.column}").alias(self.name)

    def merged(self) -> Column:
        """The same measure over rows of a finer table."""
        if self.kind == "count":
            return F.coalesce(F.sum("_rows"), F.lit(0)).alias(self.name)
        if self.kind == "avg":
            total, seen = F.sum(f"_sum_{self.column}"), F.sum(f"_n_{self.column}")
            return F.when(seen > 0, total / seen).alias(self.name)
        aggregate = {"sum": F.sum, "min": F.min, "max": F.max}[self.kind]
        return aggregate(f"_{self.kind}_{self.column}").alias(self.name)


def available(measures: Sequence[Measure], columns: Iterable[str]) -> list[Measure]:
    """Measures whose input column exists; a missing column drops its measures, not the table."""
    present = set(columns)
    return [m for m in measures if m.column is None or m.column in present]


def partial_columns(measures: Iterable[Measure]) -> list[Column]:
    merged: dict[str, Column] = {}
    for measure in measures:
        merged.update(measure.partials())
    return [column.alias(name) for name, column in merged.items()]


TRIPS = Measure("trip_count", "count")

SUMMARY = (
    Measure("row_count", "count"),
    Measure("min_pickup_ts", "min", "pickup_ts"),
    Measure("max_pickup_ts", "max", "pickup_ts"),
    Measure("avg_passenger_count", "avg", "passenger_count"),
    Measure("avg_trip_distance", "avg", "trip_distance"),
    Measure("avg_total_amount", "avg", "total_amount"),
    Measure("sum_total_amount", "sum", "total_amount"),
    Measure("sum_tip_amount", "sum", "tip_amount"),
    Measure("avg_tip_pct", "avg", "tip_pct"),
)
HOURLY = (TRIPS, Measure("sum_total_amount", "sum", "total_amount"))
PLACE = (
    TRIPS,
    Measure("sum_total_amount", "sum", "total_amount"),
    Measure("avg_total_amount", "avg", "total_amount"),
    Measure("avg_trip_distance", "avg", "trip_distance"),
    Measure("avg_tip_pct", "avg", "tip_pct"),
)
PAYMENT = (
    TRIPS,
    Measure("avg_fare_amount", "avg", "fare_amount"),
    Measure("sum_fare_amount", "sum", "fare_amount"),
    Measure("avg_tip_amount", "avg", "tip_amount"),
    Measure("sum_tip_amount", "sum", "tip_amount"),
    Measure("avg_tip_pct", "avg", "tip_pct"),
    Measure("sum_total_amount", "sum", "total_amount"),
)
