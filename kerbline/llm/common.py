"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.session import settle

#: White space of the operators' contracts: \x20 and \x09 to \x0D.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows times bytes up to which a table may be broadcast.
BROADCAST_BYTES = 16 << 20
#: Bytes of text that one numpy pass works on.
SLICE_BYTES = 1 << 20


#: Rows of an Arrow batch where the session leaves Spark's default, which is meant for narrow rows: a row here is a text.
BATCH_ROWS = 1000
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application, so that tasks can import them anywhere. Arrow
    batches of the session get BATCH_ROWS rows, unless it sets another number than the default."""
    if spark.conf.get(_BATCH_CONF, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    if root.is_dir():  # else it runs from an archive that was sent already
        archive = Path(tempfile.mkdtemp(prefix="sources-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def _give_back() -> None:
    """Hand freed memory back to the system: a worker is kept for later tasks, which may need little."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_arrow(df: DataFrame, function: Callable, schema: object) -> DataFrame:
    """mapInArrow with this package at hand in the tasks, which give back their memory at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        _give_back()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column of the frame has, whatever the case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def broadcast_if_small(settled: DataFrame, row_bytes: int) -> DataFrame:
    """The frame, marked for broadcast if its counted rows of at most `row_bytes` fit the bound; else left to the planner.

    `settled` should be read from a written table: the count then reads only file footers.
    """
    return F.broadcast(settled) if settled.count() * row_bytes <= BROADCAST_BYTES else settled


def dealt_in_order(df: DataFrame, group: str, *order: str) -> DataFrame:
    """The rows, written in ranges of group and order, with the number of their range as `_part`.

    Ranges split a group however large it is; what goes on from range to range is carried by one row per group and range.
    """
    return settle(df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()), "ordered")


def carried(dealt: DataFrame, group: str, one: Column, all_: Callable[[Column], Column]) -> DataFrame:
    """group, _part and `_before`: what aggregate `one` of the earlier ranges of a group comes to by aggregate `all_`."""
    parts = dealt.groupBy(group, "_part").agg(one.alias("_one"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    found = parts.select(group, "_part", all_(F.col("_one")).over(earlier).alias("_before"))
    return broadcast_if_small(settle(found, "carried"), 64)


def row_numbers(df: DataFrame, group: str, *order: str) -> DataFrame:
    """The rows with `_number`, gapless from 0 within each group (not null) in the given order; no task gets a whole group."""
    dealt = dealt_in_order(df, group, *order)
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    met = dealt.withColumn("_number", F.row_number().over(inside)).join(
        carried(dealt, group, F.count("*"), F.sum), [group, "_part"]
    )
    number = F.col("_number") + F.coalesce("_before", F.lit(0)) - 1
    return met.withColumn("_number", number.cast("long")).drop("_part", "_before")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows that hold about `most` bytes of the column; a longer text comes alone."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


__all__ = [
    "BROADCAST_BYTES",
    "SPACES",
    "broadcast_if_small",
    "carried",
    "dealt_in_order",
    "free_name",
    "lower_ascii",
    "map_arrow",
    "row_numbers",
    "settle",
    "ship",
    "slices",
    "table",
    "utf8",
]
