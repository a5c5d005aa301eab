"""Warehouse tables: declare, replace, append."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from parcelyard import schemas
from parcelyard.operators.features import unscored

STATUS_DDL = "table_name string, rows bigint, ok boolean, error string"


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and its tables unless they are there."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for name, schema in schemas.WAREHOUSE.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schemas.column_ddl(schema)}) USING parquet"
        )


def check_keys(df: DataFrame, schema, what: str) -> None:
    """Parquet tables do not enforce NOT NULL, so a missing key is looked for before the write."""
    for key in schemas.key_columns(schema):
        if not df.filter(F.col(key).isNull()).isEmpty():
            raise ValueError(f"{what}: {key} is NULL in some rows")


def _append(df: DataFrame, database: str, name: str) -> int:
    schema = schemas.WAREHOUSE[name]
    schemas.require_columns(df, schema, name)
    check_keys(df, schema, name)
    observed = Observation()
    rows = df.select(*schema.names).observe(observed, F.count(F.lit(1)).alias("rows"))
    rows.write.insertInto(f"{database}.{name}")
    return observed.get["rows"]


def _digest(schema) -> list[Column]:
    """Row count and a sum of row hashes: the same for the same rows in any order or layout."""
    hashed = F.sum(F.xxhash64(*schema.names).cast("decimal(38,0)")).alias("digest")
    return [F.count(F.lit(1)).alias("rows"), hashed]


def replace_table(df: DataFrame, database: str, name: str) -> int:
    """Replace a table's rows, keep its declared types, and return the row count.

    The rows are written beside the table, and keys are checked on the way. Once what reading the files back gives has
    the count and the digest of what was written, the table is pointed at them. So a reader sees the old rows or the
    new ones, and a load that fails leaves the table as it was. The old files stay for readers that began before; their
    folders are those under `database`'s location that no table points at.
    """
    spark, schema = df.sparkSession, schemas.WAREHOUSE[name]
    schemas.require_columns(df, schema, name)
    path = f"{_location(spark, database)}/{name}-{uuid.uuid4().hex}"
    missing = [F.count_if(F.col(key).isNull()).alias(f"no_{key}") for key in schemas.key_columns(schema)]
    written = Observation()
    df.select(*schema.names).observe(written, *_digest(schema), *missing).write.parquet(path)
    for key in schemas.key_columns(schema):
        if written.get[f"no_{key}"]:
            raise ValueError(f"{name}: {key} is NULL in some rows")
    found = spark.read.schema(schema).parquet(path).agg(*_digest(schema)).first()
    if (found["rows"], found["digest"]) != (written.get["rows"], written.get["digest"]):
        raise ValueError(f"{name}: {path} does not hold the rows that were written")
    spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(f"{database}.{name}")
    return found["rows"]


def _location(spark: SparkSession, database: str) -> str:
    found = spark.sql(f"DESCRIBE DATABASE {database}").filter("info_name = 'Location'").first()
    return found["info_value"].rstrip("/")


def load_tables(
    spark: SparkSession,
    database: str,
    tables: dict[str, Callable[[], DataFrame]],
    raise_on_error: bool = False,
) -> DataFrame:
    """Replace each table in turn. A failing table is reported and the rest still load.

    `tables` maps a name to a function that gives its rows, so a source that cannot be read fails alone.
    """
    status = []
    for name, rows_of in tables.items():
        try:
            status.append((name, replace_table(rows_of(), database, name), True, None))
        except Exception as problem:
            status.append((name, None, False, (str(problem).splitlines() or [type(problem).__name__])[0]))
    failed = [s for s in status if not s[2]]
    if failed and raise_on_error:
        raise RuntimeError(f"tables not loaded: {failed}")
    return spark.createDataFrame(status, STATUS_DDL)


def append_predictions(
    predictions: DataFrame,
    database: str,
    skip_scored: bool = False,
    name: str = "fact_delivery_prediction",
) -> int:
    """Append predictions; `skip_scored` leaves out orders that already have one. Returns the rows added."""
    schema = schemas.WAREHOUSE[name]
    missing = [c for c in schema.names if c not in predictions.columns]
    full = predictions.withColumns(
        {c: F.lit(None).cast(schema[c].dataType) for c in missing}
    ).select(*schema.names)
    if skip_scored:
        full = unscored(full, full.sparkSession.table(f"{database}.{name}")).select(*schema.names)
    return _append(full, database, name)
