"""Session defaults and the shared working folder."""

from __future__ import annotations

import importlib.util
import os
import re
import sys
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Timestamps are compared and bucketed in UTC everywhere; a local zone is a display matter.
# ANSI mode stays on, so every parse that may fail is written with a try_ function.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


_own_folders: dict[str, str] = {}


def delta_available() -> bool:
    return importlib.util.find_spec("delta") is not None


def build_session(
    app: str,
    master: str | None = None,
    *,
    delta: bool = False,
    packages: Sequence[str] = (),
    jars: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with our defaults; `conf` wins over them, so a cluster can pin what it needs."""
    if delta and not delta_available():
        raise ImportError("delta=True needs the delta-spark package")
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    settings = {**BASE_CONF, **(DELTA_CONF if delta else {}), **(conf or {})}
    if jars:
        settings["spark.jars"] = ",".join(jars)
    if packages and not delta:
        settings["spark.jars.packages"] = ",".join(packages)

    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    if delta:
        from delta import configure_spark_with_delta_pip

        builder = configure_spark_with_delta_pip(builder, list(packages))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's `spark.checkpoint.dir`, visible to every executor.

    Only a one-process local session that names no such folder gets one of its own, kept per application: the setting
    itself can't be changed once a session runs.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _own_folders:
            _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="run-")
        root = _own_folders[context.applicationId]
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove what this application has put below the shared folder. Its owner is the application: call this when the
    frames that were settled are no longer read, at the latest before the session ends."""
    folder = shared_dir(spark, "").rpartition("/")[0]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, short lineage, safe from lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
