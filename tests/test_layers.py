"""Stored facts: buckets of order_id, folders by month, and row counts observed by the writes."""

import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcelyard.operators import quality, star
from parcelyard.plans import etl, queries
from parcelyard.sinks.files import MONTH, fact_months, record_run, write_fact_months, write_recorded
from parcelyard.workspace import new_folder, staged_by_key
from tests.support import plan_of, rows

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
FEATURE_QUERIES = (
    "training_base", "scoring_base", "unscored_orders", "order_distance", "features", "train_test_split", "class_ratio",
)


@pytest.fixture
def merge_joins(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def exchanged_keys(df):
    return set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan_of(df)))


@needs_tables
@pytest.mark.parametrize("name", FEATURE_QUERIES)
def test_features_start_from_the_stored_fact(spark, merge_joins, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert "lineitem" not in plan_of(df) and "order_id" not in exchanged_keys(df)


def test_tables_in_the_same_buckets_join_in_place(spark, raw, merge_joins):
    orders = staged_by_key(star.clean_orders(raw["orders"]), "orders", "order_id")
    totals = staged_by_key(star.order_items_agg(raw["order_items"]), "totals", "order_id")
    customers = star.dim_customer(raw["customers"])
    fact = star.fact_of_totals(orders, totals, customers)
    assert exchanged_keys(orders.join(totals, "order_id", "left")) == set()
    assert rows(fact) == rows(star.fact_delivery(raw["orders"], raw["order_items"], customers))
    again = staged_by_key(totals.limit(0), "nothing", "order_id", buckets=3)
    assert again.count() == 0 and again.columns == totals.columns


@pytest.fixture
def fact(raw):
    return star.fact_delivery(raw["orders"], raw["order_items"], star.dim_customer(raw["customers"]))


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_a_month_is_loaded_by_itself(spark, fact, tmp_path):
    path = str(tmp_path / "months")
    later = fact.filter("order_id = 'A'").withColumns({"order_id": F.lit("Z"), "order_purchase_timestamp": F.lit("2018-02-03 04:05:06").cast("timestamp_ntz")})
    unknown = later.withColumns({"order_id": F.lit("Y"), "order_purchase_timestamp": F.lit(None).cast("timestamp_ntz")})
    assert write_fact_months(fact.unionByName(later).unionByName(unknown), path) == fact.count() + 2
    before = files(path)
    assert write_fact_months(later.withColumn("price", F.lit(1.0)), path) == 1
    after = files(path)
    kept = {f for f in before if not f.startswith(f"{MONTH}=2018-02")}
    assert {f: after[f] for f in kept} == {f: before[f] for f in kept}
    assert not {f for f in before if f not in kept} & set(after)
    assert [tuple(r) for r in fact_months(spark, path, "2018-02", "2018-02").select("order_id", "price").collect()] == [("Z", 1.0)]
    assert {r[0] for r in fact_months(spark, path).select("order_id").collect()} == {"A", "B", "C", "D", "E", "F", "Y", "Z"}
    assert fact_months(spark, path, "2018-01").filter("order_id = 'Y'").isEmpty()
    assert write_fact_months(fact.limit(0), path) == 0 and fact_months(spark, path).count() == 8


def test_only_the_asked_months_are_read(spark, fact, tmp_path):
    path = str(tmp_path / "months")
    write_fact_months(fact, path)
    plan = plan_of(fact_months(spark, path, "2018-01", "2018-02"))
    assert re.search(r"PartitionFilters: \[[^\]]*order_month#\d+ >= 2018-01", plan)


RUNS = "layer string, rows long, finished_at timestamp_ntz"


def test_counts_are_those_of_the_last_write(spark, tmp_path):
    runs = str(tmp_path / "runs")
    write_recorded(spark.range(5), str(tmp_path / "a"), "a", runs)
    write_recorded(spark.range(7), str(tmp_path / "a"), "a", runs)
    record_run(spark, runs, "b", 0)
    counts = quality.recorded_row_counts(spark.read.schema(RUNS).parquet(runs))
    assert rows(counts) == [("a", 7), ("b", 0)]
    assert "runs" in plan_of(counts) and spark.read.parquet(str(tmp_path / "a")).count() == 7


def test_a_fan_out_is_seen(spark, raw, tmp_path):
    """A customer twice in the dimension doubles the orders in the fact; the counts of the writes show it."""
    runs = str(tmp_path / "runs")
    write_recorded(raw["orders"], str(tmp_path / "orders"), "orders", runs)
    for customers, beyond in ((star.dim_customer(raw["customers"]), 0), (raw["customers"], 2)):
        fact = star.fact_of_totals(raw["orders"], star.order_items_agg(raw["order_items"]), customers)
        write_recorded(fact, str(tmp_path / "fact"), "fact_delivery", runs)
        counts = quality.recorded_row_counts(spark.read.schema(RUNS).parquet(runs))
        assert rows(quality.rows_beyond(counts, "fact_delivery", "orders")) == [("fact_delivery", "orders", beyond)]
    assert rows(quality.rows_beyond(counts, "fact_delivery", "never")) == [("fact_delivery", "never", None)]


def test_curated_build_records_its_runs(spark, raw, tmp_path):
    runs, processed = str(tmp_path / "runs"), spark.createDataFrame([], "event_id string, order_id string, event_type string, event_timestamp timestamp_ntz, produced_at timestamp_ntz")
    counts = etl.build_curated(spark, raw, processed, str(tmp_path / "out"), runs)
    assert dict(rows(quality.recorded_row_counts(spark.read.schema(RUNS).parquet(runs)))) == counts
    assert set(counts) == set(etl.TABLE_ORDER) and counts["fact_delivery"] == raw["orders"].count()


def test_new_folders_differ(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")


@needs_tables
def test_the_feature_fact_is_not_dealt_by_customer(spark, merge_joins, monkeypatch):
    """No zip is joined to it, and orders and totals are stored once, where they join."""
    made, real = [], queries.staged_by_key

    def keep(df, purpose, key):
        made.append((purpose, df))
        return real(df, purpose, key)

    monkeypatch.setattr(queries, "staged_by_key", keep)
    monkeypatch.setattr(queries, "_made", {})
    queries.QUERIES["features"](spark, FOLDER)
    assert [purpose for purpose, _ in made] == ["feature_fact"]
    assert exchanged_keys(made[0][1]) == {"order_id"}
    made.clear()
    assert queries.QUERIES["curated_fact"](spark, FOLDER).count() == 1500 and not made
