"""Bounded sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row


def write_table(
    df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Write one table. A partitioned write is rebalanced on its columns first: few files per folder, and a folder
    that holds a large share of the rows is split over several tasks and files."""
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_outputs(outputs: Mapping[str, DataFrame], base: str, *, fmt: str = "parquet") -> None:
    """Each named table under its own folder."""
    for name, df in outputs.items():
        write_table(df, f"{base.rstrip('/')}/{name}", fmt=fmt)


def write_issue_rows(df: DataFrame, base: str, *, fmt: str = "parquet", path: str | None = None) -> None:
    """Issue rows to their default folder or to `path`; ordered inside each file, with no global sort."""
    ordered = df.sortWithinPartitions(df["dq_issue_count"].desc(), df["pickup_ts"].asc())
    write_table(ordered, path or f"{base.rstrip('/')}/quality_issue_rows", fmt=fmt)


def show(name: str, df: DataFrame | None, rows: int) -> None:
    if df is not None:
        print(f"--- {name}")
        df.show(rows, truncate=False)


def head(df: DataFrame, rows: int = 10) -> list[Row]:
    return df.take(rows)
