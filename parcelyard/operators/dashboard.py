"""Data behind the dashboard: key figures, look-up, recent orders."""

from pyspark.sql import DataFrame, functions as F

PREDICTION_COLUMNS = ["order_id", "is_delayed", "predicted_is_delayed", "delay_probability"]


def dashboard_kpis(predictions: DataFrame) -> DataFrame:
    """One row; NULLs are skipped, and an empty table gives 0 rows and NULL sums."""
    return predictions.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("is_delayed").alias("actual_delayed"),
        F.sum("predicted_is_delayed").alias("predicted_delayed"),
        F.round(F.avg("delay_probability") * 100, 2).alias("avg_delay_probability_percent"),
    )


def order_lookup(predictions: DataFrame, order_id: str) -> DataFrame:
    return predictions.filter(F.col("order_id") == F.lit(order_id)).select(*PREDICTION_COLUMNS)


def first_orders(predictions: DataFrame, rows: int = 100) -> DataFrame:
    """Some `rows` predictions, whichever are read first."""
    return predictions.select(*PREDICTION_COLUMNS).limit(rows)


def recent_orders(predictions: DataFrame, purchases: DataFrame | None = None, rows: int = 100) -> DataFrame:
    """The `rows` latest orders by purchase time. `purchases` supplies `order_purchase_timestamp` when the
    predictions do not carry it."""
    if purchases is not None:
        predictions = predictions.join(
            purchases.select("order_id", "order_purchase_timestamp"), "order_id"
        )
    return (
        predictions.select(*PREDICTION_COLUMNS, "order_purchase_timestamp")
        .orderBy(F.desc_nulls_last("order_purchase_timestamp"), "order_id")
        .limit(rows)
    )
