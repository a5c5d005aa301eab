"""Stream ingest: messages in, accepted JSON Lines and rejects out.

The checkpoint takes the place of hand-committed offsets: a batch is committed only after both its folders
are written and entered in the sink's ledger, and a batch that is repeated after a failure overwrites the same two
folders.
"""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelyard.operators import events as ev
from parcelyard.sources.files import event_files
from parcelyard.streaming import ledger

DEDUP_DELAY = "10 minutes"
REMEMBERED = 1_000_000
_STORE = "spark.sql.streaming.stateStore.providerClass"


def start_ingest(
    messages: DataFrame, sink: str, checkpoint: str, every: str | None = None, stored: Callable[[int], None] | None = None
) -> StreamingQuery:
    """Check each message and store it under `sink`. `every` is a processing-time trigger; without it the
    query takes what is there and stops. `stored` is called with each batch's number once the sink has the batch and
    before it is committed; if it raises, the batch runs again."""

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        ledger.enter(spark, sink, query, batch_id, ledger.STARTED)
        checked = ev.check_messages(batch).persist()
        accepted, rejected, count = Observation(), Observation(), F.count(F.lit(1)).alias("rows")
        try:
            ev.accepted_lines(checked).observe(accepted, count).write.mode("overwrite").text(
                ledger.batch_folder(sink, "accepted", query, batch_id)
            )
            ev.rejected_messages(checked).observe(rejected, count).write.mode("overwrite").parquet(
                ledger.batch_folder(sink, "rejected", query, batch_id)
            )
        finally:
            checked.unpersist()
        ledger.enter(spark, sink, query, batch_id, ledger.STORED, accepted.get["rows"], rejected.get["rows"])
        if stored:
            stored(batch_id)

    writer = messages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def ingested_events(spark: SparkSession, sink: str) -> DataFrame:
    """Accepted events of every batch that the ledger has as stored."""
    return event_files(spark, ledger.live_folders(spark, sink) or f"{sink.rstrip('/')}/accepted")


def ingested_rejects(spark: SparkSession, sink: str) -> DataFrame:
    rejects = spark.read.schema("value binary, reject_reason string").option("recursiveFileLookup", True)
    return rejects.parquet(f"{sink.rstrip('/')}/rejected")


def first_of_each(events: DataFrame, key: str = "event_id", limit: int = REMEMBERED) -> DataFrame:
    """`events` without rows whose key came before in the same task; needs no shuffle and keeps no state.

    A task remembers `limit` keys and then starts anew, so repeats can be left over but no first row goes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            fresh = []
            for place, value in enumerate(batch.column(key).to_pylist()):
                if value not in seen:
                    seen.add(value)
                    fresh.append(place)
            yield batch.take(pa.array(fresh, pa.int64()))
            if len(seen) > limit:
                seen.clear()

    return events.mapInArrow(run, events.schema)


def stream_dedup(messages: DataFrame, delay: str = DEDUP_DELAY) -> DataFrame:
    """Accepted events of a message stream, without repeats that arrive within `delay` of each other.

    The watermark runs on arrival time, which never goes back, so no event is ever late and dropped; a
    repeat after `delay` is left to the batch dedup of the processed layer. Repeats in one task of a batch go first,
    without state: an event sent millions of times reaches the one stateful step as a copy from each task.
    """
    events = first_of_each(ev.accepted_events(ev.check_messages(messages)))
    arrived = events.withColumn("received_at", F.current_timestamp()).withWatermark("received_at", delay)
    return arrived.dropDuplicatesWithinWatermark(["event_id"]).select(*ev.EVENT_COLUMNS)


@contextmanager
def _keyed_store(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, on the executors' disks, in place of their heap."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def start_dedup(
    messages: DataFrame, sink: str, checkpoint: str, every: str | None = None, **dedup
) -> StreamingQuery:
    """Store the deduplicated stream as JSON Lines; the file sink's log makes each batch appear once."""
    writer = (
        stream_dedup(messages, **dedup)
        .writeStream.format("json")
        .outputMode("append")
        .option("ignoreNullFields", False)
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with _keyed_store(messages.sparkSession):
        return writer.start()
