"""The ledger of a stream's sink: what each batch stored, how often it was tried, and which folders are live.

A batch writes its folders, then its ledger entry, and only then does the checkpoint commit it. A failure in between
makes the batch run again under its number; its folders are overwritten and the ledger shows the second attempt. Every
batch has a ledger folder of its own, so an entry costs one small file and no look at other batches.

Compaction copies the folders of stored batches to one folder of larger files and then enters that in the ledger; from
this entry on readers take the new folder in place of the old ones, so they see every batch once at any moment.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from parcelyard.functions.timestamps import utc_now

STARTED, STORED, COMPACTED = "started", "stored", "compacted"
SCHEMA = "batch_id long, state string, accepted long, rejected long, at timestamp_ntz, query string"


def batch_folder(sink: str, kind: str, query: str, batch_id: int) -> str:
    """A folder of its own for each batch of each checkpoint: `query` is the id that the checkpoint keeps."""
    return f"{sink.rstrip('/')}/{kind}/query={query}/batch_id={batch_id}"


def _compacted_folder(sink: str, query: str, upto: int) -> str:
    return f"{sink.rstrip('/')}/accepted/query={query}/upto={upto}"


def enter(
    spark: SparkSession, sink: str, query: str, batch_id: int, state: str, accepted: int | None = None, rejected: int | None = None
) -> None:
    values = {"batch_id": F.lit(batch_id).cast("long"), "state": F.lit(state), "accepted": F.lit(accepted).cast("long"), "rejected": F.lit(rejected).cast("long")}
    entry = spark.range(0, 1, 1, 1).select(*[v.alias(k) for k, v in values.items()], utc_now().alias("at"))
    entry.write.mode("append").parquet(f"{sink.rstrip('/')}/ledger/query={query}/entry={state}-{batch_id}")


def entries(spark: SparkSession, sink: str) -> DataFrame:
    """All entries: query, batch_id, state, accepted, rejected, at. Empty for a sink without a ledger."""
    try:
        read = spark.read.schema(SCHEMA).parquet(f"{sink.rstrip('/')}/ledger")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    return read.select("query", "batch_id", "state", "accepted", "rejected", "at")


def batches(entered: DataFrame) -> DataFrame:
    """One row per batch: attempts, whether it is stored, and the row counts of the last attempt that stored it."""
    runs = entered.filter(F.col("state") != COMPACTED)
    stored = F.col("state") == STORED
    return runs.groupBy("query", "batch_id").agg(
        F.count_if(F.col("state") == STARTED).alias("attempts"),
        F.bool_or(stored).alias("is_stored"),
        F.max_by(F.when(stored, F.col("accepted")), F.when(stored, F.col("at"))).alias("accepted"),
        F.max_by(F.when(stored, F.col("rejected")), F.when(stored, F.col("at"))).alias("rejected"),
    )


def summary(entered: DataFrame) -> DataFrame:
    """One row: stored batches, those of them that were tried more than once, and their rows."""
    return batches(entered).filter("is_stored").agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(F.col("attempts") > 1).alias("repeated_batches"),
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"),
    )


def live_folders(spark: SparkSession, sink: str) -> list[str]:
    """Folders that together hold the accepted lines of every stored batch once."""
    entered = entries(spark, sink)
    covered = Window.partitionBy("query")
    state = entered.filter(F.col("state") != STARTED).groupBy("query", "batch_id", "state").agg(F.max("accepted").alias("accepted"))
    upto = F.max(F.when(F.col("state") == COMPACTED, F.col("batch_id"))).over(covered)
    live = state.withColumn("upto", F.coalesce(upto, F.lit(-1))).filter(
        ((F.col("state") == COMPACTED) & (F.col("batch_id") == F.col("upto"))) | ((F.col("state") == STORED) & (F.col("batch_id") > F.col("upto")))
    )
    # one path per batch since the last compaction
    return [
        _compacted_folder(sink, r["query"], r["batch_id"]) if r["state"] == COMPACTED else batch_folder(sink, "accepted", r["query"], r["batch_id"])
        for r in live.orderBy("query", "batch_id").collect()
    ]


def compact(spark: SparkSession, sink: str) -> int:
    """Gather the accepted lines of each query's stored batches in one folder; returns how many folders it replaces.

    Batches up to the last one that all before it are stored too take part. A failing compaction leaves the ledger
    and so the readers as they were; running it again overwrites its folder.
    """
    replaced = 0
    known = entries(spark, sink)
    stored = known.filter(F.col("state") == STORED).groupBy("query").agg(F.sort_array(F.collect_set("batch_id")).alias("ids"))
    done = known.filter(F.col("state") == COMPACTED).groupBy("query").agg(F.max("batch_id").alias("upto"))
    for r in stored.join(done, "query", "left").collect():
        upto = -1 if r["upto"] is None else r["upto"]
        fresh = [b for b in r["ids"] if b > upto]
        whole = [b for k, b in enumerate(fresh) if b == fresh[0] + k]
        if not whole or (upto >= 0 and fresh[0] != upto + 1):
            continue
        sources = [batch_folder(sink, "accepted", r["query"], b) for b in whole]
        if upto >= 0:
            sources.insert(0, _compacted_folder(sink, r["query"], upto))
        lines = spark.read.text(sources)
        lines.select("value").hint("rebalance").write.mode("overwrite").text(_compacted_folder(sink, r["query"], whole[-1]))
        enter(spark, sink, r["query"], whole[-1], COMPACTED)
        replaced += len(sources)
    return replaced
