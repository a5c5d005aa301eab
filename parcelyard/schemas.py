"""Table schemas: fixed values. Column names, including the `lenght` spelling, are part of the contract."""

from pyspark.sql import types as T

_S, _D, _I, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()


def _table(key, **columns):
    return T.StructType([T.StructField(name, kind, name != key) for name, kind in columns.items()])


# ---- raw files: everything is read with an explicit schema ----

ORDERS_TEXT = _table(
    None,
    order_id=_S,
    customer_id=_S,
    order_status=_S,
    order_purchase_timestamp=_S,
    order_approved_at=_S,
    order_delivered_carrier_date=_S,
    order_delivered_customer_date=_S,
    order_estimated_delivery_date=_S,
)
CUSTOMERS = _table(
    None,
    customer_id=_S,
    customer_unique_id=_S,
    customer_zip_code_prefix=_S,
    customer_city=_S,
    customer_state=_S,
)
ORDER_ITEMS = _table(
    None,
    order_id=_S,
    order_item_id=_I,
    product_id=_S,
    seller_id=_S,
    shipping_limit_date=_S,
    price=_D,
    freight_value=_D,
)
PRODUCTS = _table(
    None,
    product_id=_S,
    product_category_name=_S,
    product_name_lenght=_D,
    product_description_lenght=_D,
    product_photos_qty=_D,
    product_weight_g=_D,
    product_length_cm=_D,
    product_height_cm=_D,
    product_width_cm=_D,
)
SELLERS = _table(None, seller_id=_S, seller_zip_code_prefix=_S, seller_city=_S, seller_state=_S)
GEOLOCATION = _table(
    None,
    geolocation_zip_code_prefix=_S,
    geolocation_lat=_D,
    geolocation_lng=_D,
    geolocation_city=_S,
    geolocation_state=_S,
)
RAW_FILES = {
    "orders": ORDERS_TEXT,
    "customers": CUSTOMERS,
    "order_items": ORDER_ITEMS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
}

EVENT_TEXT = _table(
    None, event_id=_S, order_id=_S, event_type=_S, event_timestamp=_S, produced_at=_S
)

# ---- warehouse: the key of a dimension and of the delivery fact is NOT NULL ----

DIM_CUSTOMER = _table(
    "customer_id",
    customer_id=_S,
    customer_unique_id=_S,
    customer_zip_code_prefix=_S,
    customer_city=_S,
    customer_state=_S,
)
DIM_SELLER = _table(
    "seller_id", seller_id=_S, seller_zip_code_prefix=_S, seller_city=_S, seller_state=_S
)
DIM_PRODUCT = _table(
    "product_id", **{f.name: f.dataType for f in PRODUCTS}, product_volume=_D
)
DIM_LOCATION = _table(
    "zip_code_prefix", zip_code_prefix=_S, city=_S, state=_S, latitude=_D, longitude=_D
)
DIM_DATE = _table(
    "date_sk",
    date_sk=_S,
    full_date=T.DateType(),
    year=_I,
    month=_I,
    day=_I,
    day_of_week=_I,
    is_weekend=T.BooleanType(),
)
FACT_DELIVERY = _table(
    "order_id",
    order_id=_S,
    customer_id=_S,
    product_id=_S,
    seller_id=_S,
    order_status=_S,
    order_purchase_timestamp=_TS,
    order_approved_at=_TS,
    order_delivered_carrier_date=_TS,
    order_delivered_customer_date=_TS,
    order_estimated_delivery_date=_TS,
    price=_D,
    freight_value=_D,
    customer_zip_code_prefix=_S,
    delivery_duration_hours=_D,
    delay_days=_I,
    is_delayed=_I,
    date_sk=_S,
)
FACT_DELIVERY_EVENT = _table(
    None, event_id=_S, order_id=_S, status=_S, event_timestamp=_TS, produced_at=_TS
)
FACT_DELIVERY_PREDICTION = _table(
    None, order_id=_S, is_delayed=_I, predicted_is_delayed=_D, delay_probability=_D
)

WAREHOUSE = {
    "dim_customer": DIM_CUSTOMER,
    "dim_seller": DIM_SELLER,
    "dim_product": DIM_PRODUCT,
    "dim_location": DIM_LOCATION,
    "dim_date": DIM_DATE,
    "fact_delivery": FACT_DELIVERY,
    "fact_delivery_event": FACT_DELIVERY_EVENT,
    "fact_delivery_prediction": FACT_DELIVERY_PREDICTION,
}

MILESTONES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def key_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]


def column_ddl(schema: T.StructType) -> str:
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )


def require_columns(df, schema: T.StructType, what: str) -> None:
    """Names and types must match the declared table; nullability is checked on the data instead."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    declared = {f.name: f.dataType.simpleString() for f in schema}
    if found != declared:
        drift = sorted(set(found.items()) ^ set(declared.items()))
        raise ValueError(f"{what}: columns differ from the declared table: {drift}")
