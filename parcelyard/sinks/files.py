"""Layer files."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from parcelyard.functions.timestamps import utc_now
from parcelyard.schemas import FACT_DELIVERY, T

MONTH = "order_month"


def write_layer(
    df: DataFrame, path: str, files: int | None = None, partition_by: tuple[str, ...] = (), only_these: bool = False
) -> int:
    """Replace a Parquet layer and return its row count, counted while writing.

    Without `files`, the output is rebalanced at run time to files of the advisory size; a fixed number
    repartitions the finished rows, so it never narrows the work before it. With `only_these`, a partitioned layer
    keeps the partitions that `df` has no rows of.
    """
    shaped = df.repartition(files) if files else df.hint("rebalance", *partition_by)
    observed = Observation()
    writer = shaped.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if only_these:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return observed.get["rows"]


def write_fact_months(fact: DataFrame, path: str) -> int:
    """Write the delivery fact in one folder per month of purchase. Only the months that `fact` has rows of are
    replaced, so a month can be loaded again by itself. Orders without a purchase time are a month of their own."""
    month = F.date_format("order_purchase_timestamp", "yyyy-MM")
    return write_layer(fact.withColumn(MONTH, month), path, partition_by=(MONTH,), only_these=True)


def fact_months(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored fact, or its months from `first` to `last` (`yyyy-MM`); files of other months are not read."""
    schema = T.StructType([*FACT_DELIVERY.fields, T.StructField(MONTH, T.StringType())])
    rows = spark.read.schema(schema).parquet(path)
    if first is not None:
        rows = rows.filter(F.col(MONTH) >= first)
    return rows if last is None else rows.filter(F.col(MONTH) <= last)


def write_recorded(df: DataFrame, path: str, layer: str, runs: str, **how) -> int:
    """`write_layer`, and a row about it in the table of runs: how many rows this write saw go by."""
    rows = write_layer(df, path, **how)
    record_run(df.sparkSession, runs, layer, rows)
    return rows


def record_run(spark: SparkSession, runs: str, layer: str, rows: int) -> None:
    run = spark.range(0, 1, 1, 1).select(F.lit(layer).alias("layer"), F.lit(rows).cast("long").alias("rows"), utc_now().alias("finished_at"))
    run.write.mode("append").parquet(runs)


def write_clean_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_event_lines(lines: DataFrame, path: str) -> None:
    """JSON Lines text, one message a line, in the `value` column."""
    lines.select("value").write.mode("overwrite").text(path)
