"""Message broker source and sink. They need Spark's Kafka package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def stream_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """Messages of a topic as (key, value, topic, partition, offset, timestamp).

    Offsets are kept in the query's checkpoint, which takes the place of a consumer group.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def write_messages(df: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send the (key, value) rows of a batch frame to a topic."""
    writer = df.select("key", "value").write.format("kafka").options(**options)
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def stream_to_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str, **options: str
) -> DataStreamWriter:
    """Writer that sends the (key, value) rows of a stream to a topic."""
    writer = df.select("key", "value").writeStream.format("kafka").options(**options)
    return (
        writer.option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
