"""Data quality checks."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# fixed values: the milestones that may be missing
CHECKED_COLUMNS = (
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
)


def null_rates(df: DataFrame, columns=CHECKED_COLUMNS) -> DataFrame:
    """Percentage of NULLs in each column, in one pass."""
    return df.agg(
        *[F.round(F.avg(F.col(c).isNull().cast("int")) * 100, 4).alias(c) for c in columns]
    )


def key_uniqueness(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row: is `key` unique? NULL counts as a value."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.count_if(F.col("n") > 1).alias("repeated_keys"),
        )
        .select(
            F.lit(name).alias("table_name"),
            F.lit(key).alias("key_column"),
            "rows",
            "distinct_keys",
            (F.col("repeated_keys") == 0).alias("is_unique"),
        )
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def recorded_row_counts(runs: DataFrame) -> DataFrame:
    """Row count of each layer as its last write observed it (see `sinks.files.write_recorded`); no layer is read."""
    return runs.groupBy(F.col("layer").alias("table_name")).agg(F.max_by("rows", "finished_at").alias("rows"))


def rows_beyond(counts: DataFrame, layer: str, source: str) -> DataFrame:
    """One row: by how many rows `layer` exceeds the `source` it has one row each of. Above 0 a join fanned out,
    below 0 rows were lost; NULL if either was never written."""

    def of(name: str):
        return F.max(F.when(F.col("table_name") == name, F.col("rows")))

    return counts.agg((of(layer) - of(source)).alias("rows_beyond")).select(F.lit(layer).alias("layer"), F.lit(source).alias("source"), "rows_beyond")
