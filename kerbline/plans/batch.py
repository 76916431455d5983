"""The batch job: from trip files to metric tables, quality summary and issue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbline.operators import quality, trips
from kerbline.operators.quality import Limits
from kerbline.plans import trip_tables
from kerbline.session import settle
from kerbline.sources import sinks, tables


def build(raw: DataFrame, zones: DataFrame | None, limits: Limits = Limits()) -> dict[str, DataFrame]:
    """Every table the trips' columns allow, by name. Metrics see the trips of `limits.pickup_year`; quality sees all
    trips, also those without a pickup time. Trips are read three times: for the metrics, for the signatures (with the
    quality summary), and for the issue rows; once more where too many signatures repeat to be broadcast."""
    zones = settle(zones, "zones") if zones is not None else None
    outputs = trip_tables.all_tables(raw, zones, limits.pickup_year)
    prepared = trips.prepare(raw, keep_undated=True)
    # Rules know the pickup place only; signatures need no place at all.
    outputs["quality_summary"], repeated = quality.audit(trips.attach_zones(prepared, zones, ends=["pickup"]), limits)
    marked = quality.mark_duplicates(prepared, repeated=repeated)
    flagged = quality.flag(trips.attach_zones(marked, zones), limits, duplicates=False)
    outputs["quality_issue_rows"] = quality.issue_rows(flagged)
    return outputs


def run(
    spark: SparkSession,
    trips_path: str,
    zones_path: str,
    output: str,
    *,
    limits: Limits = Limits(),
    fmt: str = "parquet",
    issues_path: str | None = None,
    show_rows: int = 0,
) -> dict[str, DataFrame]:
    """Read, build and write all tables below `output`; issue rows may go elsewhere. A missing zone file leaves the
    place tables out."""
    outputs = build(tables.read_trips(spark, trips_path), tables.read_zones(spark, zones_path), limits)
    issues = outputs.pop("quality_issue_rows")
    sinks.write_outputs(outputs, output, fmt=fmt)
    sinks.write_issue_rows(issues, output, fmt=fmt, path=issues_path)
    if show_rows:
        for name, table in outputs.items():
            sinks.show(name, table, show_rows)
        sinks.show("quality_issue_rows", quality.worst_first(issues, show_rows), show_rows)
    return {**outputs, "quality_issue_rows": issues}
