"""Delta tables, where the connector is on the classpath. The same steps on plain parquet: operators.versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    reader = spark.read.format("delta")
    return (reader if version is None else reader.option("versionAsOf", version)).load(path)


def append(df: DataFrame, path: str, *, evolve: bool = False) -> None:
    df.write.format("delta").mode("append").option("mergeSchema", str(evolve).lower()).save(path)


def optimize(spark: SparkSession, path: str, zorder_by: Sequence[str] = ()) -> DataFrame:
    """Compact, or cluster when columns are given; returns the connector's metrics."""
    from delta.tables import DeltaTable

    job = DeltaTable.forPath(spark, path).optimize()
    return job.executeZOrderBy(list(zorder_by)) if zorder_by else job.executeCompaction()


def history(spark: SparkSession, path: str, limit: int = 20) -> DataFrame:
    from delta.tables import DeltaTable

    return DeltaTable.forPath(spark, path).history(limit).orderBy("version")
