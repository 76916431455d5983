"""Small column expressions shared by batch and streaming plans. All stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Payment codes.
PAYMENT_LABELS = {
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided_trip",
}
OTHER_PAYMENT = "other"


def payment_label(code: Column) -> Column:
    """Label of a payment code; text codes are read as integers, anything unmapped is 'other'."""
    pairs = [F.lit(part) for item in PAYMENT_LABELS.items() for part in item]
    return F.coalesce(F.create_map(*pairs)[code.try_cast("int")], F.lit(OTHER_PAYMENT))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null unless whole is positive (a bare `/` would fail under ANSI)."""
    return F.when(whole > 0, part / whole)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100.0


def rate(part: Column, whole: Column) -> Column:
    """Percent for reports: four decimals."""
    return F.round(percent(part, whole), 4)


def z_score(value: Column, mean: Column, stddev: Column, floor: float) -> Column:
    """Distance from the mean in standard deviations, with a floor under the deviation."""
    spread = F.greatest(stddev, F.lit(float(floor)))
    usable = mean.isNotNull() & stddev.isNotNull() & (spread > 0)
    return F.when(usable, F.round((value - mean) / spread, 4))


def finite(value: Column, digits: int = 4) -> Column:
    """NaN and infinities become null; the rest is rounded."""
    broken = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~broken, F.round(value, digits))


def blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def event_time(df: DataFrame, name: str) -> Column:
    """A zoned timestamp from text or either timestamp type; unreadable text becomes null.

    A typed column is only cast: a range on a cast still reaches the parquet scan.
    """
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def row_count_label(rows: Column) -> Column:
    """'full' for no limit, else the count with thousands separators."""
    return F.when(rows.isNull(), F.lit("full")).otherwise(F.format_number(rows, 0))


def label_order(label: Column) -> list[Column]:
    """Sort keys for such labels: by number, 'full' last."""
    return [
        (label == "full").asc(),
        F.regexp_replace(label, ",", "").try_cast("bigint").asc_nulls_last(),
    ]


def row_digest(df: DataFrame) -> Column:
    """Order-free checksum of a frame: sum of row hashes, in decimals because a long sum overflows."""
    return F.sum(F.xxhash64(*[F.col(name) for name in sorted(df.columns)]).cast("decimal(20,0)"))
