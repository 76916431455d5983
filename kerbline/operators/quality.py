"""Data-quality rules for trips and clickstream events.

A rule is a name and a nullable condition. Null means "cannot tell" and is never an issue. Rules whose columns are
absent drop out, so the same list serves every trip variant.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_, or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbline.functions import roles
from kerbline.functions.expressions import blank, percent
from kerbline.operators.lookup import BROADCAST_ROWS, fits_broadcast, heaviest, left_by_sieve
from kerbline.session import settle
from kerbline.sources.events import REQUIRED_FIELDS

DUPLICATE = "duplicate_taxi_record"
FUTURE = "no_future_trip_datetime"

# Columns the rules look at.
NOT_NULL = ("pickup_ts", "passenger_count", "trip_distance", "fare_amount", "total_amount")
NOT_NEGATIVE = ("fare_amount", "tip_amount", "total_amount", "trip_distance")
PLACE_COLUMNS = ("pickup_zone", "pickup_borough")
UNRESOLVED_PLACES = ("Unknown", "N/A", "")
EVENT_AMOUNTS = ("fare_amount", "tip_amount", "total_amount")

# What an issue row shows.
ISSUE_COLUMNS = (
    "pickup_ts",
    "pickup_date",
    "pickup_hour",
    "pickup_borough",
    "pickup_zone",
    "dropoff_borough",
    "dropoff_zone",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "payment_type_label",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "tip_pct",
    "dq_issue_count",
    "dq_issue_names",
)


@dataclass(frozen=True)
class Limits:
    """Rule parameters. `as_of` is the run's time, given by the caller so that a rerun gives the same answer."""

    pickup_year: int | None = None
    max_passengers: float = 8
    max_distance: float = 200.0
    max_tip_pct: float = 100.0
    as_of: datetime | None = None
    strict: bool = False


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Callable[[set[str], Limits], Column | None]


def _any(parts: Sequence[Column]) -> Column | None:
    return reduce(or_, parts) if parts else None


def _when_present(name: str, condition: Callable[[Column, Limits], Column]) -> Callable:
    return lambda columns, limits: condition(F.col(name), limits) if name in columns else None


def _no_time(columns: set[str], limits: Limits) -> Column:
    return F.col("pickup_ts").isNull() if "pickup_ts" in columns else F.lit(True)


def _no_required(columns: set[str], limits: Limits) -> Column | None:
    if limits.strict and not set(NOT_NULL) <= columns:
        return F.lit(True)
    return _any([F.col(c).isNull() for c in NOT_NULL if c in columns])


def _negative(columns: set[str], limits: Limits) -> Column | None:
    return _any([F.col(c) < 0 for c in NOT_NEGATIVE if c in columns])


def _other_year(columns: set[str], limits: Limits) -> Column | None:
    if limits.pickup_year is None or "pickup_ts" not in columns:
        return None
    return F.year("pickup_ts") != limits.pickup_year


def _nowhere(columns: set[str], limits: Limits) -> Column | None:
    return _any([F.col(c).isNull() | F.col(c).isin(*UNRESOLVED_PLACES) for c in PLACE_COLUMNS if c in columns])


def _from_future(columns: set[str], limits: Limits) -> Column | None:
    if limits.as_of is None or "pickup_ts" not in columns:
        return None
    return F.col("pickup_ts") > F.lit(limits.as_of.isoformat(sep=" ")).cast("timestamp")


ROW_RULES = (
    Rule("missing_pickup_timestamp", _no_time),
    Rule("missing_required_fields", _no_required),
    Rule("negative_numeric_values", _negative),
    Rule("invalid_passenger_count", _when_present("passenger_count", lambda c, p: (c <= 0) | (c > p.max_passengers))),
    Rule("invalid_trip_distance", _when_present("trip_distance", lambda c, p: c > p.max_distance)),
    Rule("invalid_tip_pct", _when_present("tip_pct", lambda c, p: (c < 0) | (c > p.max_tip_pct))),
    Rule("pickup_year_mismatch", _other_year),
    Rule("unresolved_pickup_zone", _nowhere),
    Rule(FUTURE, _from_future),
)


def row_conditions(columns: Sequence[str], limits: Limits) -> dict[str, Column]:
    """Conditions that need only the row itself, by rule name in declaration order."""
    present = set(columns)
    built = {rule.name: rule.condition(present, limits) for rule in ROW_RULES}
    return {name: condition for name, condition in built.items() if condition is not None}


def _signature(df: DataFrame) -> dict[str, Column]:
    """Identity of a trip as join and group keys. Doubles are compared at six decimals."""
    types = dict(df.dtypes)
    return {
        f"_sig_{name}": F.rint(F.col(name) * 1e6) if types[name] in ("double", "float") else F.col(name)
        for name in roles.signature_columns(df.columns)
    }


def _complete(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(key).isNotNull() for key in keys])


def repeated_signatures(df: DataFrame) -> DataFrame | None:
    """Signature keys that occur more than once, with `_copies`, written to the shared folder; None without signatures."""
    keys = _signature(df)
    if not keys:
        return None
    counted = df.withColumns(keys).where(_complete(list(keys))).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return settle(counted.where(F.col("_copies") > 1), "repeated-signatures")


def mark_duplicates(
    df: DataFrame,
    *,
    counted_on: DataFrame | None = None,
    repeated: DataFrame | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add `dq_duplicate_taxi_record`: the row's whole signature occurs more than once.

    Counting the signatures combines on the map side, so a signature held by a large share of the rows costs one
    counter per task, where a window over the signature would gather all its rows in one task. The signatures that
    repeat are written to the shared folder when this is called, unless `repeated` has them already. If they are few,
    they are broadcast and the rows are not shuffled at all; else only rows that a sieve of them lets through are joined
    by shuffle, the most frequent of them apart. Mark before anything is joined: rows are then read twice. Incomplete signatures match nothing. `counted_on` are the same trips before anything was joined to them:
    counting then carries no join.
    """
    keys = _signature(df)
    if not keys:
        return df
    keyed = df.withColumns(keys)
    if repeated is None:
        repeated = repeated_signatures(df if counted_on is None else counted_on)
    if fits_broadcast(repeated, max_broadcast_rows):
        marked = keyed.join(F.broadcast(repeated), list(keys), "left")
    else:
        marked = left_by_sieve(keyed, repeated, list(keys), heaviest(repeated, "_copies"))
    return marked.select(*df.columns, F.col("_copies").isNotNull().alias(f"dq_{DUPLICATE}"))


def duplicate_signatures(df: DataFrame) -> DataFrame:
    """Each repeated signature with its number of copies."""
    names = roles.signature_columns(df.columns)
    keys = _signature(df)
    return (
        df.withColumns(keys)
        .where(_complete(list(keys)))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"), *[F.min(name).alias(name) for name in names])
        .where(F.col("copies") > 1)
        .select(*names, "copies")
    )


def flag(
    df: DataFrame,
    limits: Limits = Limits(),
    *,
    duplicates: bool = True,
    counted_on: DataFrame | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Add a `dq_` column per rule, the names of the issues found, their count, and whether there is any. Without
    `duplicates`, trips that `mark_duplicates` has marked keep their marks."""
    marked = mark_duplicates(df, counted_on=counted_on, repeated=repeated) if duplicates else df
    conditions = row_conditions(df.columns, limits)
    names = [name for name in conditions if name != FUTURE]
    names += [DUPLICATE] if f"dq_{DUPLICATE}" in marked.columns else []
    names += [FUTURE] if FUTURE in conditions else []

    flagged = marked.withColumns({f"dq_{name}": condition for name, condition in conditions.items()})
    found = [F.coalesce(F.col(f"dq_{name}"), F.lit(False)) for name in names]
    # Count and any-issue come from the flags themselves: a filter on them needs no array.
    return flagged.withColumns(
        {
            "dq_issue_names": F.array_compact(F.array(*[F.when(f, F.lit(n)) for f, n in zip(found, names, strict=True)])),
            "dq_issue_count": reduce(lambda a, b: a + b, [f.cast("int") for f in found]),
            "dq_has_issue": reduce(or_, found),
        }
    )


def _finish_summary(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "clean_rows": F.col("total_rows") - F.col("issue_rows"),
            "issue_rate_pct": percent(F.col("issue_rows"), F.col("total_rows")),
        }
    )


def summary_of_flagged(flagged: DataFrame) -> DataFrame:
    """Rows, issue rows and rows per rule of an already flagged frame; zeros when it is empty."""
    return _finish_summary(flag_counts(flagged))


def _flag_counts(flagged: DataFrame) -> list[Column]:
    skip = {"dq_issue_names", "dq_issue_count", "dq_has_issue"}
    names = [c for c in flagged.columns if c.startswith("dq_") and c not in skip]
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("dq_has_issue").alias("issue_rows"),
        *[F.count_if(c).alias(f"{c.removeprefix('dq_')}_rows") for c in names],
    ]


def observed_flags(flagged: DataFrame, watch: Observation) -> DataFrame:
    """The flagged rows, whose summary is counted by whatever job writes them (or the issue rows among them)."""
    return flagged.observe(watch, *_flag_counts(flagged))


def observed_summary(watch: Observation, otherwise: DataFrame) -> DataFrame:
    """The summary that a finished job has observed; waits for the job. Counts are taken in the tasks whose output the job
    keeps, so a task that is run again counts once. `otherwise` are the same counts as a query, for a job without rows:
    Spark leaves out what it sees to be empty, and the observation with it."""
    try:
        counts = watch.get
    except Py4JJavaError as error:
        if "toPyRow" not in str(error):
            raise
        return _finish_summary(otherwise)
    schema = ", ".join(f"{name} long" for name in counts)
    return _finish_summary(otherwise.sparkSession.createDataFrame([tuple(counts.values())], schema))


def flag_counts(flagged: DataFrame) -> DataFrame:
    """What `observed_flags` observes, as a query."""
    return flagged.agg(*_flag_counts(flagged))


def _by_signature(df: DataFrame, limits: Limits) -> tuple[DataFrame, list[Column], Column]:
    """Rows counted per signature together with the row rules they break, the totals that make a summary of them, and
    whether a signature repeats: known once it is grouped, and then all its rows count as issues. Incomplete signatures
    share one empty key."""
    conditions = row_conditions(df.columns, limits)
    keys = _signature(df)
    counted = {f"{name}_rows": condition for name, condition in conditions.items()}
    any_issue = reduce(or_, [F.coalesce(condition, F.lit(False)) for condition in conditions.values()])

    flags = df.select(
        *[column.alias(name) for name, column in keys.items()],
        *[condition.alias(name) for name, condition in counted.items()],
        any_issue.alias("_any"),
    )
    if keys:
        complete = _complete(list(keys))
        flags = flags.select(
            *[F.when(complete, F.col(key)).alias(key) for key in keys], *counted, "_any"
        )
    grouped = flags.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("_any").alias("_issues"),
        *[F.count_if(name).alias(name) for name in counted],
    )
    repeats = (_complete(list(keys)) & (F.col("_rows") > 1)) if keys else F.lit(False)

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    outputs = {name: total(F.col(name)) for name in counted}
    if keys:
        future = outputs.pop(f"{FUTURE}_rows", None)
        outputs[f"{DUPLICATE}_rows"] = total(F.when(repeats, F.col("_rows")))
        if future is not None:
            outputs[f"{FUTURE}_rows"] = future
    totals = [
        total(F.col("_rows")).alias("total_rows"),
        total(F.when(repeats, F.col("_rows")).otherwise(F.col("_issues"))).alias("issue_rows"),
        *[column.alias(name) for name, column in outputs.items()],
    ]
    return grouped, totals, repeats


def summary(df: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The same counts straight from unflagged trips, with one shuffle and no join back."""
    grouped, totals, _ = _by_signature(df, limits)
    return _finish_summary(grouped.agg(*totals))


def audit(df: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame | None]:
    """The summary and the repeated signatures (for `flag`) from one pass over the trips and one shuffle of signatures.

    The repeated signatures are written when this is called; the summary is observed while they are.
    """
    grouped, totals, repeats = _by_signature(df, limits)
    keys = list(_signature(df))
    if not keys:
        return _finish_summary(grouped.agg(*totals)), None
    watch = Observation("quality")
    repeated = grouped.observe(watch, *totals).where(repeats).select(*keys, F.col("_rows").alias("_copies"))
    written = settle(repeated, "repeated-signatures")
    return observed_summary(watch, grouped.agg(*totals)), written


def issue_histogram(summary_row: DataFrame) -> DataFrame:
    """Rows per issue, from a summary: no second pass over the trips. Issues that never occur are left out."""
    fixed = {"total_rows", "issue_rows", "clean_rows", "issue_rate_pct"}
    counts = [c for c in summary_row.columns if c not in fixed]
    return (
        summary_row.unpivot([], counts, "issue", "rows")
        .where(F.col("rows") > 0)
        .withColumn("issue", F.regexp_replace("issue", "_rows$", ""))
        .orderBy("issue")
    )


def issue_report(summary_row: DataFrame) -> DataFrame:
    """A summary as the quality report has it: records, issue rows, clean rows, and rows by issue, without those that never
    occur."""
    fixed = {"total_rows", "issue_rows", "clean_rows", "issue_rate_pct"}
    counts = sorted(c for c in summary_row.columns if c not in fixed)
    pairs = [part for c in counts for part in (F.lit(c.removesuffix("_rows")), F.col(c))]
    types = F.map_filter(F.create_map(*pairs), lambda _, rows: rows > 0) if pairs else F.create_map().cast("map<string,bigint>")
    return summary_row.select(
        F.col("total_rows").alias("total_records"), "issue_rows", "clean_rows", types.alias("issue_types")
    )


def issue_rows(flagged: DataFrame) -> DataFrame:
    """Rows with an issue, in the report's columns. Unordered: every row is an output, so it may be huge."""
    return flagged.where("dq_has_issue").select(*[c for c in ISSUE_COLUMNS if c in flagged.columns])


def worst_first(rows: DataFrame, count: int) -> DataFrame:
    """The issue rows with most issues, oldest first among equals; the other columns settle what is left."""
    rest = [F.asc(c) for c in rows.columns if c not in ("pickup_ts", "dq_issue_count")]
    return rows.orderBy(F.desc("dq_issue_count"), F.asc("pickup_ts"), *rest).limit(count)


# --- clickstream ----------------------------------------------------------------------------------------------------


def missing_fields(fields: Sequence[str] = REQUIRED_FIELDS, columns: Sequence[str] | None = None) -> Column:
    """Names of the required fields that are null or empty; a field the frame lacks is missing in every row."""
    present = set(fields if columns is None else columns)
    return F.array_compact(
        F.array(*[F.when(blank(F.col(f)) if f in present else F.lit(True), F.lit(f)) for f in fields])
    )


def negative_values(fields: Sequence[str] = EVENT_AMOUNTS) -> Column:
    """Map of the negative numeric fields to their values."""
    pairs = [part for f in fields for part in (F.lit(f), F.col(f).try_cast("double"))]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value < 0)


def event_counts(columns: Sequence[str], required: Sequence[str] = REQUIRED_FIELDS, amounts: Sequence[str] = EVENT_AMOUNTS) -> list[Column]:
    """Records, records with missing fields, records with a negative amount; to aggregate, or to observe on a stream."""
    negative = _any([F.col(c).try_cast("double") < 0 for c in amounts if c in columns])
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.size(missing_fields(required, columns)) > 0).alias("missing_required_rows"),
        F.count_if(negative if negative is not None else F.lit(False)).alias("negative_value_rows"),
    ]


def event_report(
    df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, amounts: Sequence[str] = EVENT_AMOUNTS
) -> DataFrame:
    """The counts of a table. Works on streams too, as a query of its own; `df.observe` with `event_counts` takes them
    while a stream is written."""
    return df.agg(*event_counts(df.columns, required, amounts))


def repeated_ids(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Identifiers that occur more than once, with their number of copies."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def first_delivery(stream: DataFrame, key: str = "event_id", *, time: str = "event_timestamp", within: str) -> DataFrame:
    """A stream without redeliveries that arrive within the given delay of each other. An event without an id is no copy
    of any other, as in `repeated_ids`."""
    marked = stream.withWatermark(time, within)
    named = marked.where(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return named.unionByName(marked.where(F.col(key).isNull()))
