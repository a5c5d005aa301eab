import json
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from tests.support import rows
from parcelyard.operators import events as ev
from parcelyard.sources.kafka import message_files, topic_options
from parcelyard.streaming import ingest, ledger


def event(event_id, **extra):
    return json.dumps({"event_id": event_id, "order_id": "o", "event_type": "SHIPPED",
                       "event_timestamp": "2018-01-01 10:00:00", "produced_at": "2018-01-01T10:00:01Z", **extra})


def put(folder: Path, name: str, *lines: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


BAD = ['{"event_id": "e3"', "[1]", "5", '{"event_id": "e4"}']


def run_ingest(spark, tmp_path, files_per_batch=None):
    messages = message_files(spark, str(tmp_path / "in"), files_per_batch)
    query = ingest.start_ingest(messages, str(tmp_path / "raw"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    return ingest.ingested_events(spark, str(tmp_path / "raw"))


def run_dedup(spark, tmp_path, files_per_batch=None, **dedup):
    messages = message_files(spark, str(tmp_path / "in"), files_per_batch)
    ingest.start_dedup(messages, str(tmp_path / "clean"), str(tmp_path / "dedup"), **dedup).awaitTermination()
    return spark.read.json(str(tmp_path / "clean"))


def test_ingest_replay_and_restart(spark, tmp_path):
    put(tmp_path / "in", "a.txt", event("e1"), event("e2"), *BAD)
    assert run_ingest(spark, tmp_path).count() == 2
    assert run_ingest(spark, tmp_path).count() == 2  # same checkpoint, nothing new
    put(tmp_path / "in", "b.txt", event("e1"), event("e9"))
    raw = run_ingest(spark, tmp_path)
    assert [r["event_id"] for r in raw.orderBy("event_id").collect()] == ["e1", "e1", "e2", "e9"]
    assert ev.dedup_events(raw).count() == 3
    rejects = ingest.ingested_rejects(spark, str(tmp_path / "raw"))
    assert sorted(r["reject_reason"] for r in rejects.collect()) == [
        "malformed_json", "missing_key", "not_an_object", "not_an_object"
    ]
    assert {bytes(r["value"]).decode() for r in rejects.collect()} == set(BAD)


def test_a_repeated_batch_overwrites_itself(spark, tmp_path):
    """A batch whose commit was lost runs again under its old number and adds nothing."""
    put(tmp_path / "in", "a.txt", event("e1"), event("e2"))
    run_ingest(spark, tmp_path)
    for lost in (tmp_path / "checkpoint" / "commits").iterdir():
        lost.unlink()
    assert run_ingest(spark, tmp_path).count() == 2


def test_unknown_keys_reach_the_raw_layer(spark, tmp_path):
    put(tmp_path / "in", "a.txt", event("e1", carrier="x"))
    run_ingest(spark, tmp_path)
    assert spark.read.json(str(tmp_path / "raw" / "accepted")).first()["carrier"] == "x"


def test_stream_dedup_across_batches(spark, tmp_path):
    put(tmp_path / "in", "a.txt", event("e1"), event("e2"), event("e1"))
    assert run_dedup(spark, tmp_path).count() == 2
    put(tmp_path / "in", "b.txt", event("e1"), event("e9"))
    assert run_dedup(spark, tmp_path).count() == 3


def test_stream_dedup_drops_no_old_event(spark, tmp_path):
    """Event times far in the past, batch after batch: none is late, since arrival counts."""
    for day in range(9, 0, -1):
        put(tmp_path / "in", f"{9 - day}.txt", event(f"e{day}", event_timestamp=f"201{day}-01-01 00:00:00"))
    assert run_dedup(spark, tmp_path, files_per_batch=1).count() == 9


@pytest.mark.parametrize("remembered", [10, 1000])
def test_stream_dedup_of_a_hot_event(spark, tmp_path, remembered, monkeypatch):
    monkeypatch.setattr(ingest.first_of_each, "__defaults__", ("event_id", remembered))
    for part in range(6):
        put(tmp_path / "in", f"{part}.txt", *[event("hot")] * 200, *[event(f"{part}-{i}") for i in range(50)])
    got = run_dedup(spark, tmp_path)
    assert got.count() == got.select("event_id").distinct().count() == 301


def test_a_hot_event_leaves_each_task_once(spark, tmp_path):
    data = [("hot" if k % 3 else str(k), k) for k in range(3000)] + [(None, 1), (None, 2)]
    events = spark.createDataFrame(data, "event_id string, x int").repartition(4).cache()
    tasks = events.rdd.getNumPartitions()
    left = ingest.first_of_each(events)
    assert left.filter("event_id = 'hot'").count() <= tasks and left.filter("event_id is null").count() <= tasks
    assert left.select("event_id").distinct().count() == events.select("event_id").distinct().count()
    assert ingest.first_of_each(events.limit(0)).count() == 0


def test_one_stateful_step_on_disk(spark, tmp_path):
    put(tmp_path / "in", "a.txt", event("e1"), event("e1"), event("e2"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    messages = message_files(spark, str(tmp_path / "in"))
    query = ingest.start_dedup(messages, str(tmp_path / "clean"), str(tmp_path / "dedup"))
    query.awaitTermination()
    (state,) = query.lastProgress["stateOperators"]
    assert state["numRowsTotal"] == 2 and any("rocksdb" in k for k in state["customMetrics"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_stream_dedup_replays_and_restarts(spark, tmp_path):
    put(tmp_path / "in", "a.txt", event("e1"), event("e2"), event("e1"))
    assert run_dedup(spark, tmp_path).count() == 2
    assert run_dedup(spark, tmp_path).count() == 2  # nothing new
    for lost in (tmp_path / "dedup" / "commits").iterdir():
        lost.unlink()
    put(tmp_path / "in", "b.txt", event("e2"), event("e3"))
    got = run_dedup(spark, tmp_path)
    assert sorted(r["event_id"] for r in got.collect()) == ["e1", "e2", "e3"]


def test_stream_equals_batch(spark, tmp_path):
    lines = [event(f"e{i % 40}") for i in range(100)] + BAD * 3
    for part in range(4):
        put(tmp_path / "in", f"{part}.txt", *lines[part::4])
    batch = ev.check_messages(spark.read.text(str(tmp_path / "in")))
    streamed = run_ingest(spark, tmp_path, files_per_batch=1).select(*ev.EVENT_COLUMNS)
    assert rows(streamed) == rows(ev.accepted_events(batch))
    assert rows(run_dedup(spark, tmp_path, files_per_batch=2).select(*ev.EVENT_COLUMNS)) == rows(
        ev.dedup_events(ev.accepted_events(batch))
    )


def test_a_running_ingest_stops_and_resumes(spark, tmp_path):
    put(tmp_path / "in", "a.txt", event("e1"))
    sink, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    query = ingest.start_ingest(message_files(spark, str(tmp_path / "in")), sink, checkpoint, every="1 second")
    query.processAllAvailable()
    query.stop()
    put(tmp_path / "in", "b.txt", event("e2"))
    assert run_ingest(spark, tmp_path).count() == 2


def test_topic_options():
    options = topic_options("host:9092", max_events=10_000)
    assert options["subscribe"] == "delivery_events"
    assert options["startingOffsets"] == "earliest"
    assert options["minOffsetsPerTrigger"] == "500" and options["maxTriggerDelay"] == "10s"
    assert options["maxOffsetsPerTrigger"] == "10000"
    assert "minOffsetsPerTrigger" not in topic_options("host:9092", batch_events=None)


# ---- the ledger of the sink ----


def start(spark, tmp_path, stored=None):
    messages = message_files(spark, str(tmp_path / "in"), 1)
    return ingest.start_ingest(messages, str(tmp_path / "raw"), str(tmp_path / "checkpoint"), stored=stored)


def fail_at(batch_id):
    def stored(done):
        if done == batch_id:
            raise RuntimeError("between sink and commit")

    return stored


def ledger_rows(spark, tmp_path):
    found = ledger.batches(ledger.entries(spark, str(tmp_path / "raw")))
    return [tuple(r) for r in found.select("batch_id", "attempts", "is_stored", "accepted", "rejected").orderBy("batch_id").collect()]


def ids(spark, tmp_path):
    return sorted(r["event_id"] for r in ingest.ingested_events(spark, str(tmp_path / "raw")).collect())


@pytest.fixture
def five_files(tmp_path):
    for part in range(5):
        put(tmp_path / "in", f"{part}.txt", event(f"e{part}a"), event(f"e{part}b"), *BAD[: part % 3])
    return sorted(f"e{part}{x}" for part in range(5) for x in "ab")


def test_a_failure_between_sink_and_commit_is_seen(spark, tmp_path, five_files):
    with pytest.raises(StreamingQueryException):
        start(spark, tmp_path, fail_at(2)).awaitTermination()
    assert [r[:3] for r in ledger_rows(spark, tmp_path)] == [(0, 1, True), (1, 1, True), (2, 1, True)]
    start(spark, tmp_path).awaitTermination()
    got = ledger_rows(spark, tmp_path)
    assert [r[:3] for r in got] == [(0, 1, True), (1, 1, True), (2, 2, True), (3, 1, True), (4, 1, True)]
    assert [r[3] for r in got] == [2] * 5 and sum(r[4] for r in got) == 4
    assert ids(spark, tmp_path) == five_files
    summary = ledger.summary(ledger.entries(spark, str(tmp_path / "raw")))
    assert tuple(summary.first()) == (5, 1, 10, 4)


def test_a_batch_that_never_reached_the_sink_is_not_read(spark, tmp_path, five_files):
    start(spark, tmp_path).awaitTermination()
    sink = str(tmp_path / "raw")
    query = ledger.entries(spark, sink).first()["query"]
    put(tmp_path / "raw" / "accepted" / f"query={query}" / "batch_id=9", "part-0.txt", event("half"))
    ledger.enter(spark, sink, query, 9, ledger.STARTED)
    assert ids(spark, tmp_path) == five_files
    assert ledger_rows(spark, tmp_path)[-1] == (9, 1, False, None, None)
    assert ledger.compact(spark, sink) == 5 and ids(spark, tmp_path) == five_files


def test_compaction_keeps_every_line_once(spark, tmp_path, five_files):
    with pytest.raises(StreamingQueryException):
        start(spark, tmp_path, fail_at(2)).awaitTermination()
    sink = str(tmp_path / "raw")
    assert ledger.compact(spark, sink) == 3
    assert len(ledger.live_folders(spark, sink)) == 1 and len(ids(spark, tmp_path)) == 6
    start(spark, tmp_path).awaitTermination()  # the batch that failed runs again under the compacted folder
    assert ids(spark, tmp_path) == five_files and len(ledger.live_folders(spark, sink)) == 3
    assert ledger.compact(spark, sink) == 3 and len(ledger.live_folders(spark, sink)) == 1
    assert ids(spark, tmp_path) == five_files
    assert ledger.compact(spark, sink) == 0


def test_a_failing_compaction_changes_nothing_for_readers(spark, tmp_path, five_files, monkeypatch):
    start(spark, tmp_path).awaitTermination()
    sink = str(tmp_path / "raw")
    monkeypatch.setattr(ledger, "enter", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        ledger.compact(spark, sink)
    monkeypatch.undo()
    assert len(ledger.live_folders(spark, sink)) == 5 and ids(spark, tmp_path) == five_files
    assert ledger.compact(spark, sink) == 5 and ids(spark, tmp_path) == five_files


def test_a_gap_stops_compaction(spark, tmp_path):
    sink = str(tmp_path / "raw")
    for batch_id in (0, 1, 3):
        put(tmp_path / "raw" / "accepted" / "query=q" / f"batch_id={batch_id}", "part-0.txt", event(f"e{batch_id}"))
        ledger.enter(spark, sink, "q", batch_id, ledger.STORED, 1, 0)
    assert ledger.compact(spark, sink) == 2
    assert [f.rsplit("/", 1)[-1] for f in ledger.live_folders(spark, sink)] == ["upto=1", "batch_id=3"]
    assert ids(spark, tmp_path) == ["e0", "e1", "e3"]


def test_a_sink_without_a_ledger(spark, tmp_path):
    sink = str(tmp_path / "raw")
    assert ledger.live_folders(spark, sink) == [] and tuple(ledger.summary(ledger.entries(spark, sink)).first()) == (0, 0, 0, 0)
    put(tmp_path / "raw" / "accepted", "part-0.txt", event("old"))
    assert ids(spark, tmp_path) == ["old"]
