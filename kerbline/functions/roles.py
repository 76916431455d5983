"""Which physical column plays which role, decided once per schema on the driver."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

# The spellings trip publishers use, most common first.
PICKUP_TIME = ("tpep_pickup_datetime", "pickup_datetime", "lpep_pickup_datetime")
DROPOFF_TIME = ("tpep_dropoff_datetime", "dropoff_datetime", "lpep_dropoff_datetime", "dropOff_datetime")
PICKUP_PLACE = ("PULocationID", "PUlocationID")
DROPOFF_PLACE = ("DOLocationID", "DOlocationID")
VENDOR = ("VendorID", "vendor_id")

# A column only one publisher has tells the variant.
VARIANT_MARKERS = (
    ("tpep_pickup_datetime", "yellow"),
    ("lpep_pickup_datetime", "green"),
    ("hvfhs_license_num", "fhvhv"),
    ("dispatching_base_num", "fhv"),
)

# The roles an analyst looks for, in reading order.
ANALYSIS_ROLES = (
    ("pickup_timestamp", PICKUP_TIME),
    ("dropoff_timestamp", DROPOFF_TIME),
    ("pickup_zone", PICKUP_PLACE),
    ("dropoff_zone", DROPOFF_PLACE),
    ("passenger_count", ("passenger_count",)),
    ("trip_distance", ("trip_distance",)),
    ("payment_type", ("payment_type",)),
    ("fare_amount", ("fare_amount",)),
    ("tip_amount", ("tip_amount",)),
    ("total_amount", ("total_amount",)),
)

# What makes two trip rows the same trip, in this order.
SIGNATURE_ROLES = (
    VENDOR,
    ("pickup_ts", *PICKUP_TIME),
    DROPOFF_TIME,
    PICKUP_PLACE,
    DROPOFF_PLACE,
    ("passenger_count",),
    ("trip_distance",),
    ("fare_amount",),
    ("total_amount",),
)
MIN_SIGNATURE_COLUMNS = 5


def pick(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """The first candidate that the schema has."""
    present = set(columns)
    return next((name for name in candidates if name in present), None)


def pickup_time_column(columns: Sequence[str]) -> str:
    found = pick(columns, PICKUP_TIME)
    if found is None:
        raise ValueError(f"no pickup time column: need one of {', '.join(PICKUP_TIME)}; have {', '.join(columns)}")
    return found


def variant(columns: Iterable[str]) -> str:
    present = set(columns)
    return next((name for marker, name in VARIANT_MARKERS if marker in present), "unknown")


def analysis_columns(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(role, column) for every role the schema can fill."""
    matched = ((role, pick(columns, names)) for role, names in ANALYSIS_ROLES)
    return [(role, name) for role, name in matched if name]


def signature_columns(columns: Sequence[str]) -> list[str]:
    """Identity columns of a trip, or nothing when too few are present to tell trips apart."""
    found = [name for name in (pick(columns, names) for names in SIGNATURE_ROLES) if name]
    return found if len(found) >= MIN_SIGNATURE_COLUMNS else []
