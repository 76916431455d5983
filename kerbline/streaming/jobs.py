"""Starting, draining and watching streaming queries."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

# Updates that a log holds before it writes them, and how long it waits for those on their way.
PROGRESS_HELD, LISTENER_SECONDS = 100, 60.0

BatchWriter = Callable[[DataFrame, int], None]


def query_name(base: str, suffix: str) -> str:
    return f"{base}_{suffix}"


def _writer(df: DataFrame, name: str, checkpoints: str, every_seconds: int | None) -> DataStreamWriter:
    """A named writer with its own checkpoint; without an interval it takes what is there and ends."""
    trigger = {"availableNow": True} if every_seconds is None else {"processingTime": f"{every_seconds} seconds"}
    return (
        df.writeStream.queryName(name)
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}")
        .trigger(**trigger)
    )


def start(
    df: DataFrame,
    name: str,
    *,
    sink: str,
    checkpoints: str,
    output: str | None = None,
    mode: str = "update",
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Start a query on the console, a memory table, or parquet files.

    Files can only be appended to, so a parquet sink writes each window once, after the watermark has passed it. In
    update mode a memory table holds one row per refinement of a window.
    """
    writer = _writer(df, name, checkpoints, every_seconds)
    if sink == "parquet":
        return writer.outputMode("append").format("parquet").option("path", f"{output.rstrip('/')}/{name}").start()
    writer = writer.outputMode(mode)
    if sink == "memory":
        return writer.format("memory").start()
    if sink == "console":
        return writer.format("console").option("truncate", False).option("numRows", 50).start()
    raise ValueError(f"unknown sink: {sink}")


def start_batches(
    df: DataFrame,
    name: str,
    write: BatchWriter,
    *,
    checkpoints: str,
    mode: str = "update",
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to `write(batch, batch_id)`."""
    return _writer(df, name, checkpoints, every_seconds).outputMode(mode).foreachBatch(write).start()


def drain(queries: Iterable[StreamingQuery]) -> None:
    """Wait until every query has ended; when one fails, stop the others and raise. Each is looked at in turn, so a
    failure is seen even while another query runs on."""
    running = list(queries)
    waiting = running
    try:
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(1)]
    finally:
        stop_all(running)


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def memory_rows(spark: SparkSession, name: str, *order_by: str) -> DataFrame:
    table = spark.table(name)
    return table.orderBy(*order_by) if order_by else table


PROGRESS_SCHEMA = (
    "query_name string, batch_id long, num_input_rows long, input_rows_per_second double,"
    " processed_rows_per_second double, trigger_execution_ms long"
)
#: What a log keeps besides: groups of rows that came too late for the state, and observed metrics by name, as JSON.
LOG_SCHEMA = PROGRESS_SCHEMA + ", dropped_groups long, observed map<string, string>"


def _rounded(value: float | None) -> float | None:
    return None if value is None or value != value or abs(value) == float("inf") else round(float(value), 4)


def progress(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """The last update of each query. Earlier ones are not complete (Spark keeps some); a ProgressLog has them all."""
    last = [(query.name, query.lastProgress) for query in queries if query.lastProgress]
    rows = [
        (
            name,
            p["batchId"],
            p["numInputRows"],
            _rounded(p.get("inputRowsPerSecond")),
            _rounded(p.get("processedRowsPerSecond")),
            p["durationMs"].get("triggerExecution"),
        )
        for name, p in last
    ]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Every update of the named queries, kept in a table: `PROGRESS_HELD` updates wait in memory at most."""

    def __init__(self, spark: SparkSession, path: str, names: Iterable[str]):
        self.spark, self.path, self.names = spark, path, set(names)
        self.rows: list[tuple] = []
        self.started: dict[str, str] = {}  # run id to name
        self.ended: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        if event.name in self.names:
            self.started[str(event.runId)] = event.name

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name in self.names:
            speeds = (_rounded(p.inputRowsPerSecond), _rounded(p.processedRowsPerSecond))
            dropped = sum(operator.numRowsDroppedByWatermark for operator in p.stateOperators)
            observed = {name: json.dumps(row.asDict(), default=str) for name, row in p.observedMetrics.items()}
            taken = p.durationMs.get("triggerExecution")
            self.rows.append((p.name, p.batchId, p.numInputRows, *speeds, taken, dropped, observed))
            if len(self.rows) >= PROGRESS_HELD:
                self._flush()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.started:
            self.ended.add(str(event.runId))

    def _missing(self) -> list[str]:
        """Named queries that were not started, or have a run that has not ended."""
        started = dict(self.started)
        running = {name for run, name in started.items() if run not in self.ended}
        return sorted(running | self.names - set(started.values()))

    def _flush(self) -> None:
        rows, self.rows = self.rows, []
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def close(self) -> DataFrame:
        """All updates of queries that have ended. Spark hands events over in order, so a query's end comes after its
        updates. Raises if the end of a named query has not come in time; what has come is written all the same."""
        until = time.monotonic() + LISTENER_SECONDS
        while (missing := self._missing()) and time.monotonic() < until:
            time.sleep(0.05)
        self.spark.streams.removeListener(self)
        self._flush()
        if missing:
            raise TimeoutError(f"no end of these queries was reported in {LISTENER_SECONDS} seconds: {missing}")
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)


def observed(log: DataFrame, name: str, schema: str) -> DataFrame:
    """The metrics observed under a name, one row per update of a ProgressLog. Updates repeat the batch they are about, so
    each batch counts once, also when the query went through it again."""
    seen = log.where(F.col("observed")[name].isNotNull())
    last = seen.groupBy("query_name", "batch_id").agg(F.max(F.col("observed")[name]).alias("_seen"))
    return last.select("query_name", "batch_id", F.from_json("_seen", schema).alias("_seen")).select(
        "query_name", "batch_id", "_seen.*"
    )


def open_groups(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a stateful operator of a query still holds, key columns and state columns, as of its last finished batch.

    In append mode a window is written when the watermark has passed its end; until then it is only here. The query may
    run on meanwhile, in this application or another; its own store is not touched.
    """
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.select("key.*", "value.*")
