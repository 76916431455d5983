"""Clickstream sources. Every source has the broker's shape: `value` (JSON bytes) and `timestamp` (broker time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The event payload; everything is text, only product_id may be null.
EVENT_FIELDS = ("event_id", "user_id", "session_id", "event_type", "page", "product_id", "timestamp")
REQUIRED_FIELDS = ("event_id", "user_id", "session_id", "event_type", "page", "timestamp")
FUNNEL_STAGES = ("page_view", "product_view", "add_to_cart", "purchase")

EVENT_SCHEMA = T.StructType([T.StructField(name, T.StringType(), name not in REQUIRED_FIELDS) for name in EVENT_FIELDS])
ENVELOPE_SCHEMA = "value binary, timestamp timestamp"


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, *, starting: str = "latest", fail_on_loss: bool = True
) -> DataFrame:
    """One topic. Needs the Kafka connector on the classpath. Records that the broker no longer has fail the query, unless
    `fail_on_loss` is false: then they are passed over."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    return spark.readStream.format("kafka").options(**options).load()


def envelope_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Broker-shaped parquet files as a stream."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def encode(events: DataFrame, broker_time: str | None = None) -> DataFrame:
    """Event columns → broker shape. Broker time defaults to the event's own time."""
    payload = F.to_json(F.struct(*[F.col(name) for name in EVENT_FIELDS]))
    moment = F.col(broker_time) if broker_time else F.try_to_timestamp(F.col("timestamp"))
    return events.select(F.encode(payload, "UTF-8").alias("value"), moment.alias("timestamp"))


def publish(events: DataFrame, servers: str, topic: str) -> None:
    """Write events to a topic. Needs the Kafka connector."""
    (
        encode(events)
        .select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
