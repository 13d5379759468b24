"""Kafka topics of text lines. Needs the spark-sql-kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# The topic and consumer group used when none are named.
TOPIC = "test5"
GROUP = "items"


def consumer_options(servers: str, topic: str = TOPIC, group: str = GROUP, starting: str = "latest",
                     per_trigger: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": starting,
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def stream_topic(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Lines of a topic as they arrive, with the partition and offset that order them."""
    raw = spark.readStream.format("kafka").options(**consumer_options(servers, **options)).load()
    return raw.selectExpr("CAST(value AS STRING) AS value", "partition", "offset")


def write_topic(lines: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Publish a table of `value` lines; every partition is sent by its own task."""
    lines.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def stream_to_topic(lines: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC) -> DataStreamWriter:
    return (lines.select("value").writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint))
