"""Star schema: dimensions and the delivery fact."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

from parcelyard import schemas
from parcelyard.functions import delay
from parcelyard.functions.timestamps import date_key, wall_clock
from parcelyard.operators.dedup import keep_one

def _money_total(items: DataFrame, column: str) -> Column:
    """Sum that does not depend on the order of the rows: decimals in their own type, other amounts with twelve
    places. NaN is skipped like NULL; an amount too large for the type raises."""
    amount = F.col(column)
    if not isinstance(items.schema[column].dataType, DecimalType):
        amount = F.nanvl(amount.cast("double"), F.lit(None).cast("double")).cast("decimal(38,12)")
    return F.sum(amount).cast("double")


def clean_orders(orders: DataFrame) -> DataFrame:
    """Orders with typed milestones. Text that is not a time becomes NULL; see `malformed_orders`."""
    return orders.withColumns({c: wall_clock(F.col(c)) for c in schemas.MILESTONES})


def malformed_orders(orders: DataFrame) -> DataFrame:
    """Orders in which some milestone has text that is not a time."""
    bad = [F.when(F.col(c).isNotNull() & wall_clock(F.col(c)).isNull(), F.lit(c)) for c in schemas.MILESTONES]
    return orders.withColumn("malformed", F.array_compact(F.array(*bad))).filter(F.size("malformed") > 0)


def dim_customer(customers: DataFrame) -> DataFrame:
    zip_text = F.col("customer_zip_code_prefix").cast("string")
    return keep_one(
        customers.withColumn("customer_zip_code_prefix", zip_text).select(*schemas.DIM_CUSTOMER.names),
        "customer_id",
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    zip_text = F.col("seller_zip_code_prefix").cast("string")
    return keep_one(
        sellers.withColumn("seller_zip_code_prefix", zip_text).select(*schemas.DIM_SELLER.names),
        "seller_id",
    )


def dim_product(products: DataFrame) -> DataFrame:
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return keep_one(products.select(*schemas.PRODUCTS.names), "product_id").withColumn(
        "product_volume", volume
    )


def dim_location(geolocation: DataFrame) -> DataFrame:
    """Mean point of each zip prefix, with the first city and state by name."""
    return geolocation.groupBy(
        F.col("geolocation_zip_code_prefix").cast("string").alias("zip_code_prefix")
    ).agg(
        F.min("geolocation_city").alias("city"),
        F.min("geolocation_state").alias("state"),
        F.avg("geolocation_lat").alias("latitude"),
        F.avg("geolocation_lng").alias("longitude"),
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last purchase. Sunday is day 1 of the week, Saturday day 7."""
    day = F.col("order_purchase_timestamp").cast("date")
    span = orders.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("full_date")
    )
    return days.select(
        date_key(F.col("full_date")).alias("date_sk"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        F.dayofweek("full_date").alias("day_of_week"),
        F.dayofweek("full_date").isin(1, 7).alias("is_weekend"),
    )


def order_items_agg(items: DataFrame) -> DataFrame:
    """Items at order grain: total price and freight, product and seller of the first item.

    Product and seller come from the same item, the smallest by item number, product and seller.
    """
    first = F.min(F.struct("order_item_id", "product_id", "seller_id"))
    return (
        items.groupBy("order_id")
        .agg(
            first.alias("first"),
            _money_total(items, "price").alias("price"),
            _money_total(items, "freight_value").alias("freight_value"),
        )
        .select(
            "order_id",
            F.col("first.product_id").cast("string").alias("product_id"),
            F.col("first.seller_id").cast("string").alias("seller_id"),
            "price",
            "freight_value",
        )
    )


def fact_delivery(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order. Orders without items or with an unknown customer stay, with NULLs.

    `customers` is the deduplicated dimension. Items are brought to order grain before the join, so both
    sides of it are unique; a customer with very many orders is left to adaptive skew-join handling.
    """
    return fact_of_totals(orders, order_items_agg(items), customers)


def fact_of_totals(orders: DataFrame, totals: DataFrame, customers: DataFrame) -> DataFrame:
    """`fact_delivery` from items that are at order grain already. Orders and totals stored in buckets of order_id
    (`workspace.staged_by_key`) join without an exchange."""
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    zips = customers.select("customer_id", "customer_zip_code_prefix")
    joined = (
        clean_orders(orders)
        .join(totals, "order_id", "left")
        .join(zips, "customer_id", "left")
    )
    return (
        joined.withColumn("delivery_duration_hours", delay.delivery_hours(purchased, delivered))
        .withColumn("delay_days", delay.delay_days(delivered, F.col("order_estimated_delivery_date")))
        .withColumn("is_delayed", delay.is_delayed(F.col("delay_days")))
        .withColumn("date_sk", date_key(purchased))
        .select(*schemas.FACT_DELIVERY.names)
    )
