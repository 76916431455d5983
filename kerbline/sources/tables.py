"""Bounded sources: trip parquet, zone CSV, report JSON, and a profile of what a path holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.functions import roles

ZONE_SCHEMA = "LocationID bigint, Borough string, Zone string, service_zone string"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_trips(
    spark: SparkSession,
    path: str,
    *,
    recursive: bool = True,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Trip parquet from a file or a folder tree; a missing path is Spark's own error.

    Recursive listing ignores `name=value` folders, so a hive-partitioned tree is read with `recursive=False`, best
    with a schema: inferred partition types differ from the types in a flat file.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("recursiveFileLookup", str(recursive).lower()).parquet(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame | None:
    """Zone dimension from CSV, unique by key; None when there is no file, so enrichment is left out.

    With a schema there is no inference pass; `N/A` stays text, only an empty field is null.
    """
    try:
        raw = spark.read.schema(ZONE_SCHEMA).option("header", True).csv(path)
    except AnalysisException as error:
        if _missing(error):
            return None
        raise
    return raw.dropDuplicates(["LocationID"])


def first_rows(df: DataFrame, count: int | None, order_by: Sequence[str] = ()) -> DataFrame:
    """At most `count` rows; with a key the choice is the same on every run. None means all rows."""
    if count is None:
        return df
    return (df.orderBy(*order_by) if order_by else df).limit(count)


def preview(spark: SparkSession, path: str, columns: Sequence[str] = (), count: int | None = 20) -> DataFrame:
    """Some columns of the first rows for display; a frame without rows when nothing is there."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if _missing(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        raise
    return first_rows(found.select(*columns) if columns else found, count)


def read_reports(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Report documents, one JSON object per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents, one per file, as `document` (a variant, null where the text is no JSON object), `text` and `path`.
    Nothing is lost here: fields that no schema knows are in the variant, broken documents are rows too."""
    files = spark.read.text(path, wholetext=True)
    parsed = F.try_parse_json(F.col("value"))
    whole = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)
    return files.select(whole.alias("document"), F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"))


def quarantined(documents: DataFrame) -> DataFrame:
    """Documents that can't be read, as they came."""
    return documents.where(F.col("document").isNull()).select("path", "text")


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as a table: position, name, type, nullable."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def file_profile(df: DataFrame) -> DataFrame:
    """Rows and bytes per file. No data column is read: row counts come from the footers."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size_bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row about a file-backed frame: variant, time column, files, rows, bytes."""
    return file_profile(df).agg(
        F.lit(roles.variant(df.columns)).alias("dataset_variant"),
        F.lit(roles.pick(df.columns, roles.PICKUP_TIME)).alias("pickup_timestamp_column"),
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_size_bytes"),
        F.round(F.coalesce(F.sum("size_bytes"), F.lit(0)) / (1024 * 1024), 2).alias("total_size_mb"),
    )


def recommended_columns(df: DataFrame) -> DataFrame:
    """Role → column table, with the column's type."""
    types = dict(df.dtypes)
    rows = [(i, role, name, types[name]) for i, (role, name) in enumerate(roles.analysis_columns(df.columns))]
    return df.sparkSession.createDataFrame(rows, "position int, role string, column string, type string")
