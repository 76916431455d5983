"""Distinct counts that merge: sessions and users per window as theta sketches, kept as binary columns.

A window's sketches are built once from its events. Longer and sliding windows, and what one stage has and another lacks,
come from the stored sketches without reading events again. A sketch with fewer than 2^SKETCH_BITS members holds them all
(as hashes) and its count is exact; beyond that the standard error is 1 / sqrt(2^SKETCH_BITS), 1.6 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.operators import clicks
from kerbline.operators.clicks import FUNNEL_COUNTS, Windowing
from kerbline.sources.events import FUNNEL_STAGES

SKETCH_BITS = 12
SKETCHES = tuple(f"{name}_sketch" for name in FUNNEL_COUNTS)
#: A stage and the one that should come before it.
STAGE_STEPS = tuple(zip(FUNNEL_STAGES, FUNNEL_STAGES[1:]))


def _members() -> dict[str, Column]:
    """Whom each count of the funnel counts."""
    stages = {
        f"{stage}_sessions_sketch": F.when(F.col("event_type") == stage, F.col("session_id")) for stage in FUNNEL_STAGES
    }
    return {"total_sessions_sketch": F.col("session_id"), "total_users_sketch": F.col("user_id"), **stages}


def window_sketches(events: DataFrame, shape: Windowing = Windowing(), *, bits: int = SKETCH_BITS) -> DataFrame:
    """One row per window with a sketch for each count of the funnel; a stream in any output mode, or a table."""
    sketched = [F.theta_sketch_agg(members, bits).alias(name) for name, members in _members().items()]
    return (
        events.withWatermark("event_timestamp", shape.watermark)
        .groupBy(clicks.window(shape))
        .agg(*sketched, F.count(F.lit(1)).alias("event_count"))
        .select(*clicks.bounds(), *SKETCHES, "event_count")
    )


def rewindowed(stored: DataFrame, duration: str, slide: str | None = None, *, bits: int = SKETCH_BITS) -> DataFrame:
    """Stored tumbling windows put together to windows of a multiple of their length; with `slide`, also a multiple, to
    sliding ones."""
    united = [F.theta_union_agg(name, bits).alias(name) for name in SKETCHES]
    shape = Windowing(duration, slide or duration)
    return (
        stored.groupBy(F.window("window_start", shape.duration, shape.slide).alias("window"))
        .agg(*united, F.sum("event_count").alias("event_count"))
        .select(*clicks.bounds(), *SKETCHES, "event_count")
    )


def counted(stored: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The funnel table of sketched windows: counts and rates, and the columns to `keep`."""
    counts = [F.theta_sketch_estimate(sketch).alias(name) for sketch, name in zip(SKETCHES, FUNNEL_COUNTS)]
    return clicks.with_rates(stored.select("window_start", "window_end", *counts, *keep))


def skipped(stored: DataFrame) -> DataFrame:
    """Per window, sessions that reached a stage without the one before it, which independent stage counts can't tell."""

    def without(earlier: str, later: str) -> Column:
        missed = F.theta_difference(f"{later}_sessions_sketch", f"{earlier}_sessions_sketch")
        return F.theta_sketch_estimate(missed).alias(f"{later}_without_{earlier}")

    return stored.select("window_start", "window_end", *[without(*step) for step in STAGE_STEPS])
