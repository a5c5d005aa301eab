"""The event topic as a stream.

Needs the Spark Kafka connector on the class path. Offsets live in the query's checkpoint, which commits
them only after the sink has taken the batch.
"""

from pyspark.sql import DataFrame, SparkSession

# fixed values: topic name and micro-batch bounds
TOPIC = "delivery_events"
BATCH_EVENTS = 500
BATCH_WAIT = "10s"
# events of one batch at most, so that the first start does not take the whole topic at once
MAX_EVENTS = 100_000


def topic_options(
    servers: str,
    topic: str = TOPIC,
    batch_events: int | None = BATCH_EVENTS,
    batch_wait: str = BATCH_WAIT,
    max_events: int | None = MAX_EVENTS,
) -> dict[str, str]:
    """Reader options: from the earliest offset on the first start, a batch once `batch_events` are
    waiting or `batch_wait` has passed, never more than `max_events` in one."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if batch_events:
        options["minOffsetsPerTrigger"] = str(batch_events)
        options["maxTriggerDelay"] = batch_wait
    if max_events:
        options["maxOffsetsPerTrigger"] = str(max_events)
    return options


def event_topic(spark: SparkSession, servers: str, **batching) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic_options(servers, **batching)).load()


def message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same messages from a folder of text files, one message a line, in a `value` column."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
