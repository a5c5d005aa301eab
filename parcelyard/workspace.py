"""Working files of a job: staged tables, stream checkpoints, scratch databases."""

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


STAGE_DATABASE = "parcelyard_stage"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`. Only a local session may go without one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="parcelyard-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def allow_checkpoints(spark: SparkSession) -> None:
    """Give iterative jobs a place to cut their lineage, unless the session has one."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stage_database(spark: SparkSession) -> str:
    """The database of stored working tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGE_DATABASE} LOCATION '{shared_folder(spark).rstrip('/')}/{STAGE_DATABASE}'")
    return STAGE_DATABASE


def staged_by_key(df: DataFrame, purpose: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write `df` in buckets of `key`, sorted by it, and read it back: tables stored in as many buckets of the same key
    join and aggregate on it without an exchange. By default there are as many as shuffle partitions.

    A key with very many rows makes its bucket large; this is for keys that are (nearly) unique.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{stage_database(spark)}.{purpose}_{uuid.uuid4().hex}".replace("-", "_")
    writer = df.repartition(buckets, key).write.format("parquet").option("path", new_folder(spark, purpose))
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once and read it back: short lineage, exact size statistics, and joins on it start
    from a plain scan, which is what lets adaptive execution split a skewed partition."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
