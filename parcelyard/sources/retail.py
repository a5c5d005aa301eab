"""Raw delivery inputs derived from the retail test tables.

The tables have orders, lines, customers, suppliers, parts and a click stream, but no delivery milestones,
coordinates or freight. Those are derived from the keys by fixed arithmetic, so that every row of every
table takes part and another engine can derive the same values.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelyard.functions.delay import delay_days, is_delayed
from parcelyard.functions.timestamps import iso_utc_text, micros_text

ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}
EVENT_TYPE = {
    "click": "ORDER_CREATED",
    "view": "ORDER_APPROVED",
    "purchase": "SHIPPED",
    "signup": "DELIVERED",
}


def _scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def _mapped(column: str, names: dict[str, str]) -> Column:
    out = None
    for key, value in names.items():
        out = F.when(F.col(column) == key, value) if out is None else out.when(F.col(column) == key, value)
    return out


def _zip(nation_key: str) -> Column:
    return F.lpad(F.col(nation_key).cast("string"), 5, "0")


def _city(nation_key: str) -> Column:
    return F.concat(F.lit("city_"), (F.col(nation_key) % 7).cast("string"))


def orders(spark: SparkSession, folder: str, order_id: str | None = None) -> DataFrame:
    """All orders, or the one with `order_id` (compared on the numeric key, so the scan can skip)."""
    k = F.col("o_orderkey")
    source = _scan(spark, folder, "orders")
    if order_id is not None:
        source = source.filter(k == F.lit(order_id).try_cast("bigint"))
    status = _mapped("o_orderstatus", ORDER_STATUS)
    purchase = F.timestamp_add("SECOND", k * 37 % 86400, F.col("o_orderdate"))

    def hours_later(hours: Column) -> Column:
        return F.timestamp_add("HOUR", hours, F.col("order_purchase_timestamp"))

    return (
        source.select(
            k,
            k.cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            status.alias("order_status"),
            purchase.alias("order_purchase_timestamp"),
        )
        .select(
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            F.when(k % 50 != 0, hours_later(k % 48)).alias("order_approved_at"),
            F.when(F.col("order_status") != "processing", hours_later(k % 48 + k * 31 % 120)).alias(
                "order_delivered_carrier_date"
            ),
            F.when(F.col("order_status") == "delivered", hours_later(k * 7919 % 864)).alias(
                "order_delivered_customer_date"
            ),
            F.timestamp_add(
                "DAY", F.lit(30), F.col("order_purchase_timestamp").cast("date").cast("timestamp_ntz")
            ).alias("order_estimated_delivery_date"),
        )
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return _scan(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).alias("freight_value"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer, some of them twice."""
    copies = F.when(F.col("c_custkey") % 100 == 0, 2).otherwise(1)
    return (
        _scan(spark, folder, "customer")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .join(_scan(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            _zip("c_nationkey").alias("customer_zip_code_prefix"),
            _city("c_nationkey").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _scan(spark, folder, "supplier")
        .join(_scan(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("seller_id"),
            _zip("s_nationkey").alias("seller_zip_code_prefix"),
            _city("s_nationkey").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("p_partkey")
    return _scan(spark, folder, "part").select(
        k.cast("string").alias("product_id"),
        F.when(k % 97 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        (F.length("p_name") * 10).cast("double").alias("product_description_lenght"),
        (k % 6 + 1).cast("double").alias("product_photos_qty"),
        F.when(k % 50 != 0, F.col("p_size") * 100).cast("double").alias("product_weight_g"),
        F.col("p_size").cast("double").alias("product_length_cm"),
        (k % 20 + 1).cast("double").alias("product_height_cm"),
        (k % 30 + 5).cast("double").alias("product_width_cm"),
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    """One point per customer, so a zip prefix has many."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return (
        _scan(spark, folder, "customer")
        .join(_scan(spark, folder, "nation"), n == F.col("n_nationkey"))
        .select(
            _zip("c_nationkey").alias("geolocation_zip_code_prefix"),
            (F.lit(-30.0) + n * F.lit(1.25) + (k % 10) * F.lit(0.01)).alias("geolocation_lat"),
            (F.lit(-60.0) + n * F.lit(0.8) + (k % 7) * F.lit(0.01)).alias("geolocation_lng"),
            F.when(k % 11 != 0, _city("c_nationkey")).alias("geolocation_city"),
            F.col("n_name").alias("geolocation_state"),
        )
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """The click stream as keyed JSON messages: some repeated, and each `error` row broken in one of
    three ways (cut short, without `produced_at`, wrapped in an array)."""
    k = F.col("event_id")
    event = [
        k.cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("order_id"),
        F.coalesce(_mapped("event_type", EVENT_TYPE), F.lit("ERROR")).alias("event_type"),
        micros_text(F.col("ts")).alias("event_timestamp"),
    ]
    produced = iso_utc_text(F.timestamp_add("SECOND", k % 300, F.col("ts"))).alias("produced_at")
    whole = F.to_json(F.struct(*event, produced))
    is_error = F.col("event_type") == "error"
    value = (
        F.when(is_error & (k % 3 == 0), F.left(whole, F.lit(25)))
        .when(is_error & (k % 3 == 1), F.to_json(F.struct(*event)))
        .when(is_error, F.concat(F.lit("["), whole, F.lit("]")))
        .otherwise(whole)
    )
    sends = F.when(k % 10 == 0, 2).otherwise(1)
    return _scan(spark, folder, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.explode(F.sequence(F.lit(1), sends)).alias("send"),
    ).drop("send")


def predictions(spark: SparkSession, folder: str, order_id: str | None = None) -> DataFrame:
    """A prediction for every order, with the label that later became known."""
    source = orders(spark, folder, order_id)
    probability = (F.col("order_id").cast("bigint") * 104729 % 1000) / F.lit(1000.0)
    days = delay_days(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    return source.select(
        "order_id",
        is_delayed(days).alias("is_delayed"),
        (probability >= 0.5).cast("double").alias("predicted_is_delayed"),
        probability.alias("delay_probability"),
        "order_purchase_timestamp",
        "order_status",
    )


def earlier_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of an earlier run, made while these orders were still processing."""
    return predictions(spark, folder).filter(F.col("order_status") == "processing")
