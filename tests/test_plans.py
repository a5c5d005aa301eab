"""What the optimizer makes of the queries, and how they hold up under skew."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.support import plan_of, rows
from parcelyard.operators import dashboard, events as ev, features as feat, reports, star
from parcelyard.plans.queries import QUERIES
from parcelyard.workspace import staged

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def scans(plan):
    return {m[1]: m[0] for m in re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet", plan)}


def skew_options(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "40k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so little data has one map task


@pytest.fixture
def hot_orders(spark):
    """A third of all orders from one customer."""
    k = F.col("id")
    time = F.timestamp_add("MINUTE", k, F.lit("2018-01-01").cast("timestamp_ntz"))
    return spark.range(0, 30_000, 1, 8).select(
        k.cast("string").alias("order_id"),
        F.when(k % 3 == 0, F.lit("hot")).otherwise((k % 500).cast("string")).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        time.alias("order_purchase_timestamp"),
        *[F.timestamp_add("DAY", F.lit(d), time).alias(c) for d, c in enumerate(
            ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
             "order_estimated_delivery_date"), 1)],
    )


@pytest.fixture
def their_items(hot_orders):
    return hot_orders.select(
        "order_id", F.lit(1).alias("order_item_id"), F.lit("p").alias("product_id"),
        F.lit("s").alias("seller_id"), F.lit(1.0).alias("price"), F.lit(0.5).alias("freight_value"),
    )


@pytest.fixture
def their_customers(hot_orders):
    return star.dim_customer(
        hot_orders.select(
            "customer_id", F.lit("u").alias("customer_unique_id"), F.lit("01037").alias("customer_zip_code_prefix"),
            F.lit("c").alias("customer_city"), F.lit("SP").alias("customer_state"),
        )
    )


def test_a_hot_customer_is_split_in_the_fact(conf, hot_orders, their_items, their_customers):
    skew_options(conf)
    fact = star.fact_delivery(hot_orders, their_items, staged(their_customers, "customers"))
    assert len(fact.collect()) == 30_000
    assert "SortMergeJoin(skew=true)" in plan_of(fact)
    assert fact.filter("customer_zip_code_prefix is null").count() == 0


def test_a_hot_customer_is_totalled_before_the_state_join(conf, hot_orders, their_items, their_customers):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = star.fact_delivery(hot_orders, their_items, their_customers)
    report = reports.state_performance(fact, their_customers)
    plan = plan_of(report)
    left = plan[plan.index("SortMergeJoin"):]
    assert "partial_count" in left[: left.index("Range")]
    assert plan.count("SortMergeJoin") == 1  # items and zips are not read
    assert [tuple(r)[:2] for r in report.collect()] == [("SP", 30_000)]


def test_items_combine_before_the_shuffle(spark):
    hot = spark.range(0, 9_000, 1, 6).select(
        F.when(F.col("id") >= 0, "o").alias("order_id"), F.col("id").cast("int").alias("order_item_id"),
        F.col("id").cast("string").alias("product_id"), F.lit("s").alias("seller_id"),
        F.lit(0.1).alias("price"), F.lit(0.01).alias("freight_value"),
    )
    plan = plan_of(star.order_items_agg(hot))
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(order_id")
    assert rows(star.order_items_agg(hot)) == [("o", "0", "s", 900.0, 90.0)]


def test_events_need_no_shuffle(hot_orders):
    assert "Exchange" not in plan_of(ev.event_messages(ev.event_log(hot_orders)))


def test_curated_filters_and_columns_reach_the_scan(spark, hot_orders, their_items, their_customers):
    fact = staged(star.fact_delivery(hot_orders, their_items, their_customers), "fact")
    plan = plan_of(dashboard.order_lookup(
        fact.select("order_id", "is_delayed", F.lit(0.0).alias("predicted_is_delayed"),
                    F.lit(0.0).alias("delay_probability")), "77"))
    assert "EqualTo(order_id,77)" in plan and "ReadSchema: struct<order_id:string,is_delayed:int>" in plan
    assert "IsNull(order_delivered_customer_date)" in plan_of(feat.scoring_base(fact))


@needs_tables
def test_reports_read_only_what_they_use(spark):
    tables = scans(plan_of(QUERIES["state_performance"](spark, FOLDER)))
    assert "lineitem" not in tables and "o_totalprice" not in tables["orders"]
    tables = scans(plan_of(QUERIES["monthly_performance"](spark, FOLDER)))
    assert set(tables) == {"orders", "lineitem"} and "l_partkey" not in tables["lineitem"]
    lookup = plan_of(QUERIES["order_lookup"](spark, FOLDER))
    assert "EqualTo(o_orderkey,1234)" in lookup


@needs_tables
def test_top_k_is_not_a_full_sort(spark):
    for name in ("state_performance", "seller_revenue_top10", "category_performance", "recent_orders"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, FOLDER))


@needs_tables
def test_feature_base_joins_the_fact_to_each_dimension_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(QUERIES["training_base"](spark, FOLDER))
    # date, customer, seller, product; two more locate customers and sellers; the stored fact has its items
    assert plan.count("SortMergeJoin") == 6
