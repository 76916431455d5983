"""Versioned tables on plain parquet: append, as-of read, schema evolution, compaction, clustering, history.

A version's rows are in `data/version=<n>`; a version exists once its row is in `commits`. A version either adds to
the ones before it or replaces them (overwrite, compaction, clustering), so an as-of read takes the last replacing
version up to the wanted one and all versions since. There is one writer at a time; a table format's log, for
concurrent writers, is the connector's business (sources.delta).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.functions.expressions import row_digest
from kerbline.operators import layout
from kerbline.sources.sinks import write_table
from kerbline.sources.tables import schema_rows

COMMIT_SCHEMA = (
    "version long, committed_at timestamp, operation string, replaces boolean, num_rows long,"
    " partition_by array<string>, schema_json string, folder string"
)
DEFAULT_CLUSTER_COLUMNS = ("event_date", "channel")


@dataclass(frozen=True)
class Snapshot:
    """What a version consists of."""

    version: int
    folders: tuple[str, ...]
    schema: T.StructType
    partition_by: tuple[str, ...]


def commits(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(COMMIT_SCHEMA).parquet(f"{base}/commits")


def _commit_rows(spark: SparkSession, base: str) -> list[Row]:
    """One row per commit, oldest first; none for a table that does not exist."""
    try:
        return commits(spark, base).orderBy("version").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _snapshot(rows: Sequence[Row], version: int | None) -> Snapshot | None:
    if not rows:
        return None
    wanted = rows[-1]["version"] if version is None else version
    seen = [row for row in rows if row["version"] <= wanted]
    if not seen or seen[-1]["version"] != wanted:
        raise ValueError(f"no version {wanted}; latest is {rows[-1]['version']}")
    start = max(row["version"] for row in seen if row["replaces"])
    return Snapshot(
        version=wanted,
        folders=tuple(row["folder"] for row in seen if row["version"] >= start),
        schema=T.StructType.fromJson(json.loads(seen[-1]["schema_json"])),
        partition_by=tuple(seen[-1]["partition_by"]),
    )


def _evolved(before: T.StructType, added: T.StructType) -> T.StructType:
    """The old columns, then the new ones; a column may not change its type."""
    known = {field.name: field.dataType for field in before.fields}
    for field in added.fields:
        if field.name in known and known[field.name] != field.dataType:
            raise ValueError(f"column {field.name} is {known[field.name].simpleString()} in the table")
    extra = [T.StructField(f.name, f.dataType, True) for f in added.fields if f.name not in known]
    return T.StructType([*before.fields, *extra])


def commit(
    df: DataFrame,
    base: str,
    *,
    mode: str = "append",
    operation: str = "WRITE",
    partition_by: Sequence[str] | None = None,
    evolve: bool = True,
    arranged: bool = False,
) -> int:
    """Write the next version and return its number. `arranged` keeps the frame's own partitions as files.

    Every write has a folder of its own, and a version that is there already is refused: of two writers that start from
    one version the later fails and destroys nothing. The row count in the commit is what the files hold, taken from their footers.
    """
    spark = df.sparkSession
    rows = _commit_rows(spark, base)
    current = _snapshot(rows, None)
    replaces = mode == "overwrite" or current is None
    folders = tuple(partition_by) if partition_by is not None else (current.partition_by if current else ())
    if replaces:
        schema = df.schema
    else:
        schema = _evolved(current.schema, df.schema)
        if folders != current.partition_by:
            raise ValueError("an append keeps the table's partition columns")
        if not evolve and len(schema) > len(current.schema):
            raise ValueError("new columns need evolve=True")

    version = current.version + 1 if current else 0
    folder = f"version={version}/write={uuid.uuid4().hex}"
    path = f"{base}/data/{folder}"
    if arranged:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*folders) if folders else writer).parquet(path)
    else:
        write_table(df, path, partition_by=folders)
    written = spark.read.schema(df.schema).parquet(path).count()

    entry = (
        version,
        datetime.now(timezone.utc),
        operation,
        replaces,
        written,
        list(folders),
        schema.json(),
        folder,
    )
    one = spark.createDataFrame([entry], COMMIT_SCHEMA).coalesce(1)
    one.write.mode("error").parquet(f"{base}/commits/commit={version}")
    return version


def as_of(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The table at a version (latest by default), with the columns it had then.

    Only that version's folders are listed. Rows written before a column existed read null in it.
    """
    snapshot = _snapshot(_commit_rows(spark, base), version)
    if snapshot is None:
        raise ValueError(f"no versioned table at {base}")
    places = [T.StructField("version", T.LongType()), T.StructField("write", T.StringType())]
    with_part = T.StructType([*snapshot.schema.fields, *places])
    paths = [f"{base}/data/{folder}" for folder in snapshot.folders]
    read = spark.read.schema(with_part).option("basePath", f"{base}/data").parquet(*paths)
    return read.select(*snapshot.schema.names)


def history(spark: SparkSession, base: str, limit: int = 20) -> DataFrame:
    """The last commits, oldest first."""
    last = commits(spark, base).orderBy(F.desc("version")).limit(limit)
    return last.select("version", "committed_at", "operation", "replaces", "num_rows", "partition_by").orderBy("version")


def schema_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns only one of two frames has, in the frames' own order."""
    old, new = schema_rows(before), schema_rows(after)
    added = new.join(old, "name", "left_anti").withColumn("change", F.lit("added"))
    removed = old.join(new, "name", "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed).select("change", "position", "name", "type").orderBy("change", "position")


def compare_versions(spark: SparkSession, base: str, versions: Sequence[int]) -> DataFrame:
    """Rows and columns at each version."""
    frames = []
    for version in versions:
        table = as_of(spark, base, version)
        frames.append(
            table.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(version).cast("bigint").alias("version"),
                "row_count",
                F.array(*[F.lit(c) for c in table.columns]).alias("columns"),
            )
        )
    return reduce(DataFrame.unionByName, frames).orderBy("version")


def compact(spark: SparkSession, base: str) -> DataFrame:
    """Rewrite the table in few even files as a new version; returns files and bytes before and after."""
    before = as_of(spark, base)
    version = commit(layout.rebalanced(before), base, mode="overwrite", operation="OPTIMIZE", arranged=True)
    return _file_change(before, as_of(spark, base, version), version)


def cluster(
    spark: SparkSession,
    base: str,
    columns: Sequence[str] = DEFAULT_CLUSTER_COLUMNS,
    *,
    files: int | None = None,
) -> DataFrame:
    """Rewrite the table along the z-curve of the columns as a new version: in about `files` files, or in a doubling of
    them where one task would have too many rows to sort (`layout.files_held`)."""
    before = as_of(spark, base)
    count = files or layout.files_for(layout.file_totals(before).head()["bytes"])
    arranged = layout.z_clustered(before, columns, count)
    version = commit(arranged, base, mode="overwrite", operation="ZORDER", arranged=True)
    return _file_change(before, as_of(spark, base, version), version)


def _file_change(before: DataFrame, after: DataFrame, version: int) -> DataFrame:
    states = [
        layout.file_totals(frame).select(F.lit(state).alias("state"), "files", "bytes", "rows")
        for state, frame in (("before", before), ("after", after))
    ]
    return reduce(DataFrame.unionByName, states).withColumn("version", F.lit(version))


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts and order-free checksums of two frames over the source's columns, side by side."""

    def measured(frame: DataFrame, side: str) -> DataFrame:
        shared = frame.select(*source.columns)
        return shared.agg(F.count(F.lit(1)).alias("rows"), row_digest(shared).alias("digest")).withColumn(
            "side", F.lit(side)
        )

    def of(side: str, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    both = measured(source, "in").unionByName(measured(target, "out"))
    return both.agg(
        of("in", "rows").alias("input_rows"),
        of("out", "rows").alias("output_rows"),
        (of("in", "rows") == of("out", "rows")).alias("rows_match"),
        of("in", "digest").eqNullSafe(of("out", "digest")).alias("content_match"),
    )


def migrate(
    spark: SparkSession,
    source_path: str,
    base: str,
    *,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> DataFrame:
    """Copy a parquet dataset into a versioned table and reconcile the new rows with the source."""
    source = spark.read.parquet(source_path)
    version = commit(source, base, mode=mode, operation="WRITE", partition_by=partition_by)
    written = spark.read.schema(source.schema).parquet(f"{base}/data/version={version}")
    return reconcile(source, written).withColumn("version", F.lit(version))
