"""Rolling baseline and z-score over a series of windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kerbline.functions.expressions import finite, z_score
from kerbline.operators.clicks import ALERT_COLUMNS, AlertLimits, latest_window, raise_alerts

# The recent past a window is compared with, and the name of that model.
LOOKBACK_WINDOWS = 12
MIN_WINDOWS = 2
MODEL = "zscore_vs_recent_hour"

BLOCK_ROWS = 4096
BLOCK_SECONDS = 86_400


def _numbered(rows: DataFrame, series: Sequence[str], time: str, ties: str) -> DataFrame:
    """Add `_nth`, the row's position in its series, without sorting a series in one task.

    Rows are numbered inside each day, those of one time by `ties`; the day's start number is a running count over days,
    of which there are a few hundred a year however many windows or events there are. Series are compared null-safe.
    """
    dated = rows.withColumn("_day", F.to_date(time))
    within = Window.partitionBy(*series, "_day").orderBy(time, ties)
    days = dated.groupBy(*series, "_day").agg(F.count(F.lit(1)).alias("_in_day"))
    earlier = Window.partitionBy(*series).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*series, "_day"]
    starts = days.select(
        *[F.col(key).alias(f"_of_{key}") for key in keys], F.coalesce(F.sum("_in_day").over(earlier), F.lit(0)).alias("_before")
    )
    placed = dated.withColumn("_rank", F.row_number().over(within) - 1)
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys])
    return placed.join(starts, same).withColumn("_nth", F.col("_before") + F.col("_rank")).select(*rows.columns, "_nth")


def _scored(measured: DataFrame, value: str, min_windows: int, floor: float) -> DataFrame:
    """Rounded mean and deviation and the z-score from `baseline_window_count`, `_mean` and `_stddev`."""
    enough = F.col("baseline_window_count") >= min_windows
    return (
        measured.withColumn("baseline_session_mean", F.when(enough, F.round("_mean", 4)))
        .withColumn("baseline_session_stddev", F.when(enough, F.round("_stddev", 4)))
        .withColumn(
            "traffic_z_score",
            z_score(F.col(value), F.col("baseline_session_mean"), F.col("baseline_session_stddev"), floor),
        )
        .drop("_mean", "_stddev")
    )


def _over(frame: WindowSpec, value: str) -> dict[str, Column]:
    return {
        "baseline_window_count": F.count(value).over(frame),
        "_mean": F.avg(value).over(frame),
        "_stddev": F.stddev_pop(value).over(frame),
    }


def _with_untimed(scored: DataFrame, rows: DataFrame, time: str) -> DataFrame:
    """Rows without a time belong nowhere in a series: they are kept, without a score."""
    return scored.unionByName(rows.where(F.col(time).isNull()), allowMissingColumns=True)


def rolling_baseline(
    rows: DataFrame,
    *,
    value: str = "total_sessions",
    time: str = "window_start",
    series: Sequence[str] = (),
    lookback: int = LOOKBACK_WINDOWS,
    min_windows: int = MIN_WINDOWS,
    floor: float = AlertLimits.z_stddev_floor,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean and deviation of the `lookback` rows before each row (itself excluded), and the row's z-score.

    The series is cut into blocks of consecutive rows, of `lookback` rows at least; each block also receives the last
    rows of the block before it, so that the frame is complete inside a block and blocks are independent tasks. Mean and
    deviation are rounded before they are used; below `min_windows` earlier rows there is no score. A null series is a
    series of its own; rows without a time are kept without a score.
    """
    block_rows = max(block_rows, lookback)
    block = F.floor(F.col("_nth") / block_rows)
    also_next = F.pmod(F.col("_nth"), F.lit(block_rows)) >= block_rows - lookback
    blocks = F.when(also_next, F.array(block, block + 1)).otherwise(F.array(block))
    timed = rows.where(F.col(time).isNotNull())
    spread = _numbered(timed, series, time, value).withColumn("_block", F.explode(blocks))

    recent = Window.partitionBy(*series, "_block").orderBy("_nth").rowsBetween(-lookback, -1)
    measured = spread.withColumns(_over(recent, value)).where(F.col("_block") == block)
    return _with_untimed(_scored(measured.drop("_nth", "_block"), value, min_windows, floor), rows, time)


def recent_baseline(
    rows: DataFrame,
    *,
    seconds: int,
    value: str = "total_sessions",
    time: str = "window_start",
    series: Sequence[str] = (),
    min_windows: int = MIN_WINDOWS,
    floor: float = AlertLimits.z_stddev_floor,
    block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """The same over the rows of the last `seconds` before each row: a gap in the series doesn't reach further back.

    Rows of the row's own time are no part of its past. The series is cut into spans of time, of `seconds` at least; the
    last part of each span is also given to the next.
    """
    span = max(block_seconds, seconds)
    at = F.unix_micros(F.col(time).cast("timestamp"))
    block = F.floor(F.col("_at") / (span * 1_000_000))
    also_next = F.pmod(F.col("_at"), F.lit(span * 1_000_000)) >= (span - seconds) * 1_000_000
    blocks = F.when(also_next, F.array(block, block + 1)).otherwise(F.array(block))
    spread = rows.where(F.col(time).isNotNull()).withColumn("_at", at).withColumn("_block", F.explode(blocks))

    recent = Window.partitionBy(*series, "_block").orderBy("_at").rangeBetween(-seconds * 1_000_000, -1)
    measured = spread.withColumns(_over(recent, value)).where(F.col("_block") == block)
    return _with_untimed(_scored(measured.drop("_at", "_block"), value, min_windows, floor), rows, time)


def z_alerts(funnel_with_baseline: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Alerts of every window against its own baseline, in the report's 16 columns."""
    raised = raise_alerts(funnel_with_baseline, limits, F.col("traffic_z_score"))
    shown = raised.withColumns(
        {rate: finite(F.col(rate)) for rate in ("page_to_purchase_rate", "cart_to_purchase_rate")}
    )
    return shown.select(
        *ALERT_COLUMNS,
        "baseline_window_count",
        "baseline_session_mean",
        "baseline_session_stddev",
        "traffic_z_score",
        "alert_types",
        "alert_count",
        "severity",
        F.lit(MODEL).alias("anomaly_model"),
    )


def latest_z_alert(funnel_with_baseline: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """The last window's alert row, or no row when it raises none."""
    return z_alerts(latest_window(funnel_with_baseline), limits)


def baseline_stats(rows: DataFrame, value: str = "total_sessions") -> DataFrame:
    """A whole series as one baseline: rows, mean and deviation, rounded. A single row has deviation zero."""
    return rows.agg(
        F.count(value).alias("lookback_window_count"),
        F.round(F.avg(value), 4).alias("mean_total_sessions"),
        F.round(F.stddev_pop(value), 4).alias("stddev_total_sessions"),
    )
