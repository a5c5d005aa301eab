"""The event topic as a sink. Needs the Spark Kafka connector on the class path."""

from pyspark.sql import DataFrame

from parcelyard.sources.kafka import TOPIC


def publish(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send keyed messages; the topic's partitioner keeps one key in one partition."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
