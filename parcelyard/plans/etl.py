"""Raw files to processed events, star schema and warehouse tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from parcelyard import schemas
from parcelyard.operators import events, star
from parcelyard.sinks import warehouse
from parcelyard.sinks.files import record_run, write_layer
from parcelyard.sources.files import csv_rejects, curated_table, event_files, raw_csv

# dimensions first: the facts read them back
TABLE_ORDER = (
    "dim_customer",
    "dim_seller",
    "dim_product",
    "dim_location",
    "dim_date",
    "fact_delivery",
    "fact_delivery_event",
)


def raw_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six raw CSV data sets under `folder`, one folder or file each."""
    return {name: raw_csv(spark, name, f"{folder.rstrip('/')}/{name}.csv") for name in schemas.RAW_FILES}


def build_rejects(spark: SparkSession, folder: str, out: str, raise_on_reject: bool = False) -> int:
    """Write what the raw files under `folder` hold that does not fit to `out`/rejects, a folder per data set, and
    return the number of rejects. `raise_on_reject` raises if there are any, after they are written."""
    folder, path = folder.rstrip("/"), f"{out.rstrip('/')}/rejects"
    found = [csv_rejects(spark, name, f"{folder}/{name}.csv") for name in schemas.RAW_FILES]
    rejects = write_layer(reduce(DataFrame.unionByName, found), path, partition_by=("data_set",))
    if rejects and raise_on_reject:
        raise ValueError(f"{rejects} values do not fit; see {path}")
    return rejects


def build_processed(spark: SparkSession, event_path: str, out: str) -> int:
    processed = events.processed_events(event_files(spark, event_path))
    return write_layer(processed, f"{out.rstrip('/')}/delivery_events")


def build_curated(
    spark: SparkSession, raw: dict[str, DataFrame], processed: DataFrame, out: str, runs: str | None = None
) -> dict[str, int]:
    """Write each table of the star schema once, in dependency order, and return the row counts. With `runs`, the
    counts are added to that table of runs too."""
    out = out.rstrip("/")
    orders = star.clean_orders(raw["orders"])
    tables = {
        "dim_customer": lambda: star.dim_customer(raw["customers"]),
        "dim_seller": lambda: star.dim_seller(raw["sellers"]),
        "dim_product": lambda: star.dim_product(raw["products"]),
        "dim_location": lambda: star.dim_location(raw["geolocation"]),
        "dim_date": lambda: star.dim_date(orders),
        "fact_delivery": lambda: star.fact_delivery(
            orders, raw["order_items"], curated_table(spark, out, "dim_customer")
        ),
        "fact_delivery_event": lambda: events.fact_delivery_event(processed),
    }
    counts = {}
    for name in TABLE_ORDER:
        df = tables[name]()
        schemas.require_columns(df, schemas.WAREHOUSE[name], name)
        counts[name] = write_layer(df, f"{out}/{name}")
        if runs:
            record_run(spark, runs, name, counts[name])
    return counts


def load_warehouse(
    spark: SparkSession, curated: str, database: str, raise_on_error: bool = False
) -> DataFrame:
    """Replace the warehouse tables with the curated ones; returns one status row per table."""
    sources = {name: (lambda n=name: curated_table(spark, curated, n)) for name in TABLE_ORDER}
    return warehouse.load_tables(spark, database, sources, raise_on_error)
