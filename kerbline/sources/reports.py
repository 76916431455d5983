"""Shape of a stream run's report document; every field may be missing. Read with tables.read_reports, or, where
shapes differ from run to run, with tables.read_documents and typed()."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUMMARY_TYPE = (
    "struct<generated_event_count: bigint, generated_session_count: bigint, generated_user_count: bigint,"
    " event_type_counts: map<string, bigint>>"
)
TIMING_TYPE = (
    "struct<publish_seconds: double, processing_seconds: double, end_to_end_seconds: double,"
    " events_per_second: double, sessions_per_second: double>"
)
EVENT_ROWS_TYPE = "array<struct<window_start: string, window_end: string, event_type: string, event_count: bigint>>"

REPORT_SCHEMA = f"""
    config struct<query_name: string, page_view_sessions: bigint>,
    scenario_summary {SUMMARY_TYPE},
    timing {TIMING_TYPE},
    event_metrics {EVENT_ROWS_TYPE},
    funnel_metrics array<struct<window_start: string, window_end: string, total_sessions: bigint, total_users: bigint>>,
    query_progress array<struct<query_name: string, processed_rows_per_second: double, trigger_execution_ms: double>>,
    anomaly_alerts array<struct<alert_count: bigint, severity: string>>
"""


def _lenient(value: Column, kind: T.DataType) -> Column:
    """A variant as a type. What does not fit is null at its own place: a count may come as text, a field may be gone or
    have become something else, and the rest of the document is read all the same."""
    if isinstance(kind, T.StructType):
        parts = [
            _lenient(F.try_variant_get(value, f"$['{field.name}']", "variant"), field.dataType).alias(field.name)
            for field in kind.fields
        ]
        return F.when(F.schema_of_variant(value).startswith("OBJECT"), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        return F.transform(items, lambda item: _lenient(item, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.try_variant_get(value, "$", "map<string, variant>")
        return F.transform_values(entries, lambda _, item: _lenient(item, kind.valueType))
    return F.try_variant_get(value, "$", kind.simpleString())


def typed(documents: DataFrame) -> DataFrame:
    """Readable documents in REPORT_SCHEMA, with `extra`: the fields it does not know, as they came."""
    schema = T.StructType.fromDDL(REPORT_SCHEMA)
    fields = F.try_variant_get("document", "$", "map<string, variant>")
    extra = F.map_filter(fields, lambda name, _: ~name.isin(*schema.names))
    whole = _lenient(F.col("document"), schema).alias("_report")
    return documents.where(F.col("document").isNotNull()).select("path", whole, extra.alias("extra")).select("path", "_report.*", "extra")
