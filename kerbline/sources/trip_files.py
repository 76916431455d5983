"""Trip folders whose files differ in types or spelling: one scan per schema, one table.

Footers tell which files go together. Spark merges them in parallel; where it can't, the list of files is halved, so a
folder of G runs of equal files takes about G log(files) merges. Groups that agree on what they share become one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.functions import roles
from kerbline.functions.expressions import event_time

#: Spellings of one column, canonical first, and the type that it gets.
CANONICAL = (
    (roles.PICKUP_TIME, "timestamp"),
    (roles.DROPOFF_TIME, "timestamp"),
    (roles.PICKUP_PLACE, "bigint"),
    (roles.DROPOFF_PLACE, "bigint"),
    (roles.VENDOR, "bigint"),
    (("payment_type",), "bigint"),
    (("passenger_count",), "double"),
    (("trip_distance",), "double"),
    (("fare_amount",), "double"),
    (("tip_amount",), "double"),
    (("total_amount",), "double"),
)
_CANNOT_MERGE = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "FAILED_MERGE")


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Parquet files of a folder tree, in order of their paths."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return sorted(row["path"] for row in reader.load(path).select("path").collect())


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {field.name.lower(): field.dataType for field in schema.fields}


def _merged(spark: SparkSession, files: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """Runs of files whose footers merge, with the schema they merge to."""
    try:
        return [(list(files), spark.read.option("mergeSchema", True).parquet(*files).schema)]
    except (PySparkException, Py4JJavaError) as error:  # Spark hands this one over either way
        if len(files) == 1 or not any(reason in str(error) for reason in _CANNOT_MERGE):
            raise
    half = len(files) // 2
    return _merged(spark, files[:half]) + _merged(spark, files[half:])


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """Files that one scan can read, with its schema; as few groups as their runs allow."""
    groups: list[tuple[list[str], T.StructType]] = []
    for own, schema in _merged(spark, files) if files else []:
        types = _types(schema)
        for place, (others, known) in enumerate(groups):
            theirs = _types(known)
            if all(theirs[name] == kind for name, kind in types.items() if name in theirs):
                more = [field for field in schema.fields if field.name.lower() not in theirs]
                groups[place] = (others + own, T.StructType([*known.fields, *more]))
                break
        else:
            groups.append((own, schema))
    return groups


def _common(kinds: Sequence[T.DataType]) -> str:
    """The type of a column without a fixed one: its own if the groups agree, else a number, else text."""
    if len({kind.simpleString() for kind in kinds}) == 1:
        return kinds[0].simpleString()
    return "double" if all(isinstance(kind, T.NumericType) for kind in kinds) else "string"


def _read_as(df: DataFrame, names: Sequence[str], kind: str) -> Column:
    """The first of the spellings that has a value, as `kind`; what can't be read as such is null."""
    values = []
    for name in names:
        value = event_time(df, name) if kind == "timestamp" else F.col(name)
        values.append(value if df.schema[name].dataType.simpleString() == kind else value.try_cast(kind))
    return F.coalesce(*values) if values else F.lit(None).cast(kind)


def unified(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames of different trip schemas as one: canonical names and types, missing columns null."""
    present = {name.lower() for frame in frames for name in frame.columns}
    wanted = [(spellings, kind) for spellings, kind in CANONICAL if present & {s.lower() for s in spellings}]
    taken = {s.lower() for spellings, _ in wanted for s in spellings}
    rest: dict[str, list[T.DataType]] = {}
    shown: dict[str, str] = {}
    for frame in frames:
        for field in frame.schema.fields:
            if field.name.lower() not in taken:
                shown.setdefault(field.name.lower(), field.name)
                rest.setdefault(field.name.lower(), []).append(field.dataType)

    def canonical(frame: DataFrame) -> DataFrame:
        own = {name.lower(): name for name in frame.columns}

        def of(spellings: Sequence[str]) -> list[str]:
            return list(dict.fromkeys(own[s.lower()] for s in spellings if s.lower() in own))

        roles_ = [_read_as(frame, of(spellings), kind).alias(spellings[0]) for spellings, kind in wanted]
        others = [_read_as(frame, of([key]), _common(kinds)).alias(shown[key]) for key, kinds in rest.items()]
        return frame.select(*roles_, *others)

    return reduce(DataFrame.unionByName, [canonical(frame) for frame in frames])


def read_mixed_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trips of a folder tree whose files have different schemas; a plan with one scan per schema, columns pruned in each."""
    groups = schema_groups(spark, list_files(spark, path))
    if not groups:
        raise ValueError(f"no parquet files below {path}")
    return unified([spark.read.schema(schema).parquet(*files) for files, schema in groups])
