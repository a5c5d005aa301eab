"""Delivery reports over the star schema.

Reports by state, seller and category first total the fact per foreign key, then join the dimension. The
totals combine on the map side, so a customer, seller or product with a third of all orders costs no more
than any other, and the join sees one row per key.
"""

from pyspark.sql import Column, DataFrame, functions as F

from parcelyard.functions.delay import rate_percent

# fixed values: a group must have more rows than this to be reported
MIN_STATE_DELIVERIES = 1000
MIN_CATEGORY_ITEMS = 500


def _totals_by(fact: DataFrame, key: str, *extra: Column) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count("order_id").alias("orders"),
        F.sum("is_delayed").alias("delayed"),
        F.sum("delivery_duration_hours").alias("hours"),
        F.count("delivery_duration_hours").alias("timed"),
        *extra,
    )


def _mean(total: str, count: str) -> Column:
    return F.round(F.try_divide(F.sum(total), F.sum(count)), 2)


def monthly_performance(fact: DataFrame) -> DataFrame:
    """Orders, revenue and delay rate per purchase month, latest first."""
    purchased = F.col("order_purchase_timestamp")
    revenue = (F.col("price") + F.col("freight_value")).cast("decimal(38,12)")
    return (
        fact.groupBy(F.year(purchased).alias("order_year"), F.month(purchased).alias("order_month"))
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.round(F.sum(revenue), 2).cast("double").alias("total_revenue"),
            F.sum("is_delayed").alias("delayed_orders"),
            rate_percent(F.sum("is_delayed"), F.count_distinct("order_id")).alias("delay_rate_percent"),
        )
        .orderBy(F.desc("order_year"), F.desc("order_month"))
    )


def state_performance(
    fact: DataFrame, customers: DataFrame, min_deliveries: int = MIN_STATE_DELIVERIES, top: int = 10
) -> DataFrame:
    """States with more than `min_deliveries`, worst delay rate first."""
    return (
        _totals_by(fact, "customer_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(
            F.sum("orders").alias("total_deliveries"),
            F.sum("delayed").alias("delayed_deliveries"),
            rate_percent(F.sum("delayed"), F.sum("orders")).alias("delay_rate_percent"),
            _mean("hours", "timed").alias("avg_delivery_hours"),
        )
        .filter(F.col("total_deliveries") > min_deliveries)
        .orderBy(F.desc("delay_rate_percent"), "customer_state")
        .limit(top)
    )


def seller_revenue(fact: DataFrame, sellers: DataFrame, top: int = 10) -> DataFrame:
    """Sellers by revenue."""
    revenue = F.round(F.sum(F.col("price").cast("decimal(38,12)")), 2).cast("double")
    return (
        _totals_by(fact, "seller_id", revenue.alias("total_revenue"))
        .join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id")
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            F.col("orders").alias("total_orders"),
            "total_revenue",
            F.round(F.try_divide("hours", "timed"), 2).alias("avg_delivery_hours"),
            F.col("delayed").alias("delayed_orders"),
        )
        .orderBy(F.desc("total_revenue"), "seller_id")
        .limit(top)
    )


def category_performance(
    fact: DataFrame, products: DataFrame, min_items: int = MIN_CATEGORY_ITEMS, top: int = 15
) -> DataFrame:
    """Categories with more than `min_items`, slowest first. `items_sold` counts orders: the fact has one
    product per order."""
    product = products.select(
        "product_id", "product_category_name", "product_weight_g", "product_volume"
    ).filter(F.col("product_category_name").isNotNull())

    def mean_over_orders(column: str) -> Column:
        known = F.sum(F.when(F.col(column).isNotNull(), F.col("orders")))
        return F.round(F.try_divide(F.sum(F.col(column) * F.col("orders")), known), 2)

    return (
        _totals_by(fact, "product_id")
        .join(product, "product_id")
        .groupBy("product_category_name")
        .agg(
            F.sum("orders").alias("items_sold"),
            mean_over_orders("product_weight_g").alias("avg_weight_g"),
            mean_over_orders("product_volume").alias("avg_volume_cm3"),
            _mean("hours", "timed").alias("avg_delivery_hours"),
            rate_percent(F.sum("delayed"), F.sum("orders")).alias("delay_rate_percent"),
        )
        .filter(F.col("items_sold") > min_items)
        .orderBy(F.desc_nulls_last("avg_delivery_hours"), "product_category_name")
        .limit(top)
    )
