"""A table of windows that micro-batches keep up to date, a whole day at a time.

Update mode emits a window again whenever it changes. A micro-batch writes the days it touches, whole, below its own
folder: batch_id=N/window_day=D/windows=K. When Spark has finished the write it leaves `_SUCCESS` there; folders without
it are not read, so a half-written batch is invisible, and a batch that is run again writes its folder anew. The newest
finished folder of a day is that day. Folder names tell how many windows a day has: which days a batch needs is decided
without reading a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Batches for which a replaced day stays on disk, for readers that have listed it.
KEPT_BATCHES = 20


@dataclass(frozen=True)
class Day:
    """Where a day's windows lie."""

    day: date
    batch_id: int
    windows: int
    path: str


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in any file system Spark knows."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or ()]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _number(part: str) -> str:
    return part.partition("=")[2]


def finished(spark: SparkSession, path: str) -> set[int]:
    """Batches whose folder is complete."""
    return {int(_number(found.split("/")[-2])) for found in _listed(spark, f"{path}/batch_id=*/_SUCCESS")}


def _folders(spark: SparkSession, path: str, before_batch: int | None) -> list[Day]:
    """Day folders of finished batches, oldest batch first."""
    done, days = finished(spark, path), []
    for found in _listed(spark, f"{path}/batch_id=*/window_day=*/windows=*"):
        batch, day, windows = (_number(part) for part in found.split("/")[-3:])
        if int(batch) in done and (before_batch is None or int(batch) < before_batch):
            days.append(Day(date.fromisoformat(day), int(batch), int(windows), found))
    return sorted(days, key=lambda found: found.batch_id)


def days(spark: SparkSession, path: str, *, before_batch: int | None = None) -> list[Day]:
    """The table's days in order; what a batch has to know are those of the batches before it."""
    newest = {found.day: found for found in _folders(spark, path, before_batch)}
    return [newest[day] for day in sorted(newest)]


def read(spark: SparkSession, path: str, schema: T.StructType, chosen: Iterable[Day]) -> DataFrame:
    folders = [found.path for found in chosen]
    if not folders:
        return spark.createDataFrame([], schema)
    places = [
        T.StructField("batch_id", T.LongType()),
        T.StructField("window_day", T.DateType()),
        T.StructField("windows", T.LongType()),
    ]
    full = T.StructType([*schema.fields, *places])
    return spark.read.schema(full).option("basePath", path).parquet(*folders).select(*schema.names)


def needed(stored: Sequence[Day], changed: Iterable[date], lookback: int) -> tuple[set[date], set[date]]:
    """Days to write again when `changed` ones have new windows, and the days before them that they look back on.

    A changed window is among the `lookback` windows before those that follow it, so days are written again until that
    many have passed. How far this reaches depends on the look-back and on which days changed, not on the table.
    """
    sizes = {found.day: found.windows for found in stored}
    order = sorted({*sizes, *changed})
    place = {day: k for k, day in enumerate(order)}
    again, past = set(changed), set()
    for day in changed:
        for step, chosen in ((-1, past), (1, again)):
            at, missing = place[day] + step, lookback
            while 0 <= at < len(order) and missing > 0:
                chosen.add(order[at])
                missing -= sizes.get(order[at], 0)
                at += step
    return again, past - again


def write(rows: DataFrame, path: str, batch_id: int) -> None:
    """The days that a batch touched. A batch that is finished already is left as it is: its input cannot differ."""
    if batch_id in finished(rows.sparkSession, path):
        return
    day = rows.withColumn("window_day", F.to_date("window_start"))
    placed = day.withColumn("windows", F.count(F.lit(1)).over(Window.partitionBy("window_day")))
    placed.write.mode("overwrite").partitionBy("window_day", "windows").parquet(f"{path}/batch_id={batch_id}")


def expire(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove days that were replaced more than KEPT_BATCHES batches ago."""
    later: dict[date, int] = {}
    for found in reversed(_folders(spark, path, batch_id)):
        if later.get(found.day, batch_id) < batch_id - KEPT_BATCHES:
            _delete(spark, found.path)
        later[found.day] = found.batch_id


# --- changes --------------------------------------------------------------------------------------------------------
#
# Alerts are kept as changes: a batch appends what it raised, replaced and withdrew. Consumers follow the changes; the
# current alerts are the last change of each window, unless it is a withdrawal.

RAISED, REPLACED, WITHDRAWN = "raised", "replaced", "withdrawn"


def changes(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of two states of a keyed table that differ, with `change`; a withdrawn row shows what was withdrawn."""
    names = [c for c in after.columns if c not in key]
    old = before.select(*key, F.struct(*names).alias("_old"))
    new = after.select(*key, F.struct(*names).alias("_new"))
    met = old.join(new, list(key), "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    kind = F.when(F.col("_old").isNull(), RAISED).when(F.col("_new").isNull(), WITHDRAWN).otherwise(REPLACED)
    return met.select(*key, kind.alias("change"), F.coalesce("_new", "_old").alias("_row")).select(*key, "change", "_row.*")


def append(rows: DataFrame, path: str, batch_id: int) -> None:
    """A batch's changes, once."""
    if batch_id not in finished(rows.sparkSession, path):
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All changes of finished batches, with their batch_id."""
    folders = [f"{path}/batch_id={batch_id}" for batch_id in sorted(finished(spark, path))]
    full = T.StructType([*schema.fields, T.StructField("change", T.StringType()), T.StructField("batch_id", T.LongType())])
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*folders)


def current(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """The keyed table that the changes come to."""
    last = F.max_by(F.struct("change", *schema.names), F.col("batch_id")).alias("_last")
    found = history(spark, path, schema).groupBy(*key).agg(last).where(F.col("_last.change") != WITHDRAWN)
    return found.select(*[F.col(f"_last.{name}") for name in schema.names])
