"""SQL twins of the queries, for DuckDB over the same tables.

Each query names the common table expressions it builds on; `_sql` puts those before it.
"""

from __future__ import annotations

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: str, body: str) -> None:
    _CTES[name] = (tuple(needs.split()), body)


def _sql(needs: str, body: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in _CTES[name][0]:
                visit(needed)
            order.append(name)

    for name in needs.split():
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order) + "\n" + body


# ---- raw inputs from the test tables ----

_cte("purchases", "", """
    SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'processing' END
               AS order_status,
           o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS bought
    FROM orders""")
_cte("orders_raw", "purchases", """
    SELECT k, order_id, customer_id, order_status, bought AS order_purchase_timestamp,
           CASE WHEN k % 50 <> 0 THEN bought + to_hours(k % 48) END AS order_approved_at,
           CASE WHEN order_status <> 'processing' THEN bought + to_hours(k % 48 + k * 31 % 120) END
               AS order_delivered_carrier_date,
           CASE WHEN order_status = 'delivered' THEN bought + to_hours(k * 7919 % 864) END
               AS order_delivered_customer_date,
           CAST(date_trunc('day', bought) AS TIMESTAMP) + INTERVAL 30 DAY AS order_estimated_delivery_date
    FROM purchases""")
_cte("customers_raw", "", """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
           'city_' || CAST(c_nationkey % 7 AS VARCHAR) AS customer_city, n_name AS customer_state
    FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 100 = 0) AS twice
    JOIN nation ON c_nationkey = n_nationkey""")
_cte("dim_customer", "customers_raw", "SELECT DISTINCT * FROM customers_raw")
_cte("dim_seller", "", """
    SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
           'city_' || CAST(s_nationkey % 7 AS VARCHAR) AS seller_city, n_name AS seller_state
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
_cte("dim_product", "", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id,
           CASE WHEN p_partkey % 97 <> 0 THEN p_type END AS product_category_name,
           CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
           CAST(length(p_name) * 10 AS DOUBLE) AS product_description_lenght,
           CAST(p_partkey % 6 + 1 AS DOUBLE) AS product_photos_qty,
           CAST(CASE WHEN p_partkey % 50 <> 0 THEN p_size * 100 END AS DOUBLE) AS product_weight_g,
           CAST(p_size AS DOUBLE) AS product_length_cm,
           CAST(p_partkey % 20 + 1 AS DOUBLE) AS product_height_cm,
           CAST(p_partkey % 30 + 5 AS DOUBLE) AS product_width_cm,
           CAST(p_size * (p_partkey % 20 + 1) * (p_partkey % 30 + 5) AS DOUBLE) AS product_volume
    FROM part""")
_cte("dim_location", "", """
    SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code_prefix,
           min(CASE WHEN c_custkey % 11 <> 0 THEN 'city_' || CAST(c_nationkey % 7 AS VARCHAR) END) AS city,
           min(n_name) AS state,
           avg(CAST(-30 AS DOUBLE) + c_nationkey * CAST(1.25 AS DOUBLE) + (c_custkey % 10) * CAST(0.01 AS DOUBLE)) AS latitude,
           avg(CAST(-60 AS DOUBLE) + c_nationkey * CAST(0.8 AS DOUBLE) + (c_custkey % 7) * CAST(0.01 AS DOUBLE)) AS longitude
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1""")
_cte("dim_date", "purchases", """
    SELECT strftime(full_date, '%Y%m%d') AS date_sk, full_date, CAST(year(full_date) AS INTEGER) AS year,
           CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
           CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, dayofweek(full_date) IN (0, 6) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(min(CAST(bought AS DATE)), max(CAST(bought AS DATE)), INTERVAL 1 DAY)) AS DATE)
                 AS full_date
          FROM purchases) AS days""")
_cte("items", "", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight
    FROM lineitem""")
_cte("first_item", "items", """
    SELECT DISTINCT l_orderkey, l_partkey, l_suppkey
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS place
          FROM items) AS ranked
    WHERE place = 1""")
_cte("order_items_agg", "items first_item", """
    SELECT CAST(i.l_orderkey AS VARCHAR) AS order_id, CAST(min(f.l_partkey) AS VARCHAR) AS product_id,
           CAST(min(f.l_suppkey) AS VARCHAR) AS seller_id, CAST(sum(i.price) AS DOUBLE) AS price,
           CAST(sum(i.freight) AS DOUBLE) AS freight_value
    FROM items i JOIN first_item f ON i.l_orderkey = f.l_orderkey
    GROUP BY i.l_orderkey""")
_cte("fact_delivery", "orders_raw order_items_agg dim_customer", """
    SELECT o.order_id, o.customer_id, i.product_id, i.seller_id, o.order_status, o.order_purchase_timestamp,
           o.order_approved_at, o.order_delivered_carrier_date, o.order_delivered_customer_date,
           o.order_estimated_delivery_date, i.price, i.freight_value, c.customer_zip_code_prefix,
           date_diff('second', o.order_purchase_timestamp, o.order_delivered_customer_date) / CAST(3600 AS DOUBLE)
               AS delivery_duration_hours,
           CAST(date_diff('day', CAST(o.order_estimated_delivery_date AS DATE),
                          CAST(o.order_delivered_customer_date AS DATE)) AS INTEGER) AS delay_days,
           CASE WHEN CAST(o.order_delivered_customer_date AS DATE) > CAST(o.order_estimated_delivery_date AS DATE)
                THEN 1 ELSE 0 END AS is_delayed,
           strftime(o.order_purchase_timestamp, '%Y%m%d') AS date_sk
    FROM orders_raw o
    LEFT JOIN order_items_agg i ON o.order_id = i.order_id
    LEFT JOIN dim_customer c ON o.customer_id = c.customer_id""")
_cte("predictions", "fact_delivery", """
    SELECT order_id, is_delayed, CAST(probability >= 0.5 AS DOUBLE) AS predicted_is_delayed,
           probability AS delay_probability, order_purchase_timestamp, order_status
    FROM (SELECT *, (CAST(order_id AS BIGINT) * 104729 % 1000) / CAST(1000 AS DOUBLE) AS probability
          FROM fact_delivery) AS p""")

# ---- events ----

_cte("event_rows", "", """
    SELECT event_id AS k, event_type = 'error' AS broken, CAST(event_id AS VARCHAR) AS event_id,
           CAST(user_id AS VARCHAR) AS order_id,
           CASE event_type WHEN 'click' THEN 'ORDER_CREATED' WHEN 'view' THEN 'ORDER_APPROVED'
                           WHEN 'purchase' THEN 'SHIPPED' WHEN 'signup' THEN 'DELIVERED' ELSE 'ERROR' END AS event_type,
           ts AS event_time, ts + to_seconds(event_id % 300) AS produced_time,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp,
           strftime(ts + to_seconds(event_id % 300), '%Y-%m-%dT%H:%M:%S.%fZ') AS produced_at
    FROM events""")
_cte("sent", "event_rows", """
    SELECT * FROM event_rows UNION ALL SELECT * FROM event_rows WHERE k % 10 = 0""")
_cte("accepted", "sent", """
    SELECT event_id, order_id, event_type, event_timestamp, produced_at, event_time, produced_time
    FROM sent WHERE NOT broken""")
_cte("checked", "sent", """
    SELECT CASE WHEN broken AND k % 3 = 0 THEN substr(start || ending, 1, 25)
                WHEN broken AND k % 3 = 1 THEN start || '}'
                WHEN broken THEN '[' || start || ending || ']'
                ELSE start || ending END AS message,
           CASE WHEN broken AND k % 3 = 0 THEN 'malformed_json'
                WHEN broken AND k % 3 = 1 THEN 'missing_key'
                WHEN broken THEN 'not_an_object' END AS reject_reason
    FROM (SELECT *, '{"event_id":"' || event_id || '","order_id":"' || order_id || '","event_type":"' || event_type
                    || '","event_timestamp":"' || event_timestamp || '"' AS start,
                 ',"produced_at":"' || produced_at || '"}' AS ending
          FROM sent) AS parts""")
_cte("processed", "accepted", """
    SELECT DISTINCT event_id, order_id, event_type, event_time AS event_timestamp, produced_time AS produced_at
    FROM accepted""")
_cte("event_log", "orders_raw", """
    SELECT sha256(order_id || '|' || event_type || '|' || event_timestamp) AS event_id, order_id, event_type,
           event_timestamp, '2024-01-01T00:00:00.000000Z' AS produced_at
    FROM (SELECT order_id, 'ORDER_CREATED' AS event_type,
                 strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp
          FROM orders_raw WHERE order_purchase_timestamp IS NOT NULL
          UNION ALL
          SELECT order_id, 'ORDER_APPROVED', strftime(order_approved_at, '%Y-%m-%d %H:%M:%S')
          FROM orders_raw WHERE order_approved_at IS NOT NULL
          UNION ALL
          SELECT order_id, 'SHIPPED', strftime(order_delivered_carrier_date, '%Y-%m-%d %H:%M:%S')
          FROM orders_raw WHERE order_delivered_carrier_date IS NOT NULL
          UNION ALL
          SELECT order_id, 'DELIVERED', strftime(order_delivered_customer_date, '%Y-%m-%d %H:%M:%S')
          FROM orders_raw WHERE order_delivered_customer_date IS NOT NULL) AS milestones""")

_cte("days_means", "fact_delivery", """
    SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, avg(delay_days) AS days
    FROM fact_delivery WHERE delay_days IS NOT NULL GROUP BY 1""")
_cte("residual_spread", "fact_delivery days_means", """
    SELECT stddev_pop(f.delay_days - m.days) AS spread
    FROM fact_delivery f JOIN days_means m ON strftime(f.order_purchase_timestamp, '%Y-%m') = m.month
    WHERE f.delay_days IS NOT NULL""")

# ---- features ----

_cte("base", "fact_delivery dim_product dim_customer dim_seller dim_location dim_date", """
    SELECT f.order_id, f.is_delayed, f.order_delivered_customer_date, f.order_status, f.price, f.freight_value,
           p.product_weight_g, p.product_volume,
           lc.latitude AS cust_lat, lc.longitude AS cust_lon, ls.latitude AS seller_lat, ls.longitude AS seller_lon,
           c.customer_state, s.seller_state, d.is_weekend, d.month, d.day_of_week
    FROM fact_delivery f
    JOIN dim_product p ON f.product_id = p.product_id
    JOIN dim_customer c ON f.customer_id = c.customer_id
    JOIN dim_location lc ON c.customer_zip_code_prefix = lc.zip_code_prefix
    JOIN dim_seller s ON f.seller_id = s.seller_id
    JOIN dim_location ls ON s.seller_zip_code_prefix = ls.zip_code_prefix
    JOIN dim_date d ON f.date_sk = d.date_sk""")
_BASE_OUT = """order_id, {label}price, freight_value, product_weight_g, product_volume,
    round(cust_lat, 6) AS cust_lat, round(cust_lon, 6) AS cust_lon,
    round(seller_lat, 6) AS seller_lat, round(seller_lon, 6) AS seller_lon,
    customer_state, seller_state, is_weekend, month, day_of_week"""
_cte("located", "base", """
    SELECT *, 2 * 6371.0 * asin(sqrt(least(1.0,
        pow(sin(radians(seller_lat - cust_lat) / 2), 2)
        + cos(radians(cust_lat)) * cos(radians(seller_lat)) * pow(sin(radians(seller_lon - cust_lon) / 2), 2)))) AS distance
    FROM base""")
_cte("features", "located", """
    SELECT order_id, is_delayed, price, freight_value, product_weight_g, product_volume, distance AS distance_km,
           CAST(is_weekend AS DOUBLE) AS is_weekend, CAST(month AS DOUBLE) AS month,
           CAST(day_of_week AS DOUBLE) AS day_of_week,
           CASE WHEN customer_state = seller_state THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS is_cross_state,
           freight_value / (price + CAST(1e-5 AS DOUBLE)) AS freight_ratio,
           CASE WHEN substr(md5('42:' || order_id), 1, 4) < '3333' THEN 'test' ELSE 'train' END AS split
    FROM located""")

_FEATURES = ["price", "freight_value", "product_weight_g", "product_volume", "distance_km", "is_weekend",
             "month", "day_of_week", "is_cross_state", "freight_ratio"]


def _each(template: str, between: str = ", ") -> str:
    return between.join(template.format(c=c) for c in _FEATURES)


_cte("medians", "features",
     "SELECT " + _each("quantile_cont({c}, 0.5) AS med_{c}") + " FROM features WHERE split = 'train'")
_cte("imputed", "features medians",
     "SELECT order_id, is_delayed, split, " + _each("coalesce({c}, med_{c}) AS {c}") + " FROM features, medians")
_cte("scaling", "imputed",
     "SELECT " + _each("avg({c}) AS mean_{c}, stddev_pop({c}) AS dev_{c}") + " FROM imputed WHERE split = 'train'")

_REVENUE = "CAST(price + freight_value AS DECIMAL(38,12))"

ORACLE_SQL: dict[str, str] = {
    "clean_orders": _sql("orders_raw", "SELECT * EXCLUDE (k) FROM orders_raw"),
    "dim_customer": _sql("dim_customer", "SELECT * FROM dim_customer"),
    "dim_seller": _sql("dim_seller", "SELECT * FROM dim_seller"),
    "dim_product": _sql("dim_product", "SELECT * FROM dim_product"),
    "dim_location": _sql("dim_location", """
        SELECT zip_code_prefix, city, state, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
        FROM dim_location"""),
    "dim_date": _sql("dim_date", "SELECT * FROM dim_date"),
    "order_items_agg": _sql("order_items_agg", "SELECT * FROM order_items_agg"),
    "fact_delivery": _sql("fact_delivery", "SELECT * FROM fact_delivery"),
    "monthly_performance": _sql("fact_delivery", f"""
        SELECT CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
               CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month,
               count(DISTINCT order_id) AS total_orders, CAST(round(sum({_REVENUE}), 2) AS DOUBLE) AS total_revenue,
               CAST(sum(is_delayed) AS BIGINT) AS delayed_orders,
               round(sum(is_delayed) / CAST(count(DISTINCT order_id) AS DOUBLE) * 100, 2) AS delay_rate_percent
        FROM fact_delivery GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC"""),
    "state_performance": _sql("fact_delivery dim_customer", """
        SELECT c.customer_state, count(f.order_id) AS total_deliveries,
               CAST(sum(f.is_delayed) AS BIGINT) AS delayed_deliveries,
               round(sum(f.is_delayed) / CAST(count(f.order_id) AS DOUBLE) * 100, 2) AS delay_rate_percent,
               round(avg(f.delivery_duration_hours), 2) AS avg_delivery_hours
        FROM fact_delivery f JOIN dim_customer c ON f.customer_id = c.customer_id
        GROUP BY c.customer_state HAVING count(f.order_id) > 500
        ORDER BY delay_rate_percent DESC, customer_state LIMIT 10"""),
    "state_performance_1000": _sql("fact_delivery dim_customer", """
        SELECT c.customer_state, count(f.order_id) AS total_deliveries,
               CAST(sum(f.is_delayed) AS BIGINT) AS delayed_deliveries,
               round(sum(f.is_delayed) / CAST(count(f.order_id) AS DOUBLE) * 100, 2) AS delay_rate_percent,
               round(avg(f.delivery_duration_hours), 2) AS avg_delivery_hours
        FROM fact_delivery f JOIN dim_customer c ON f.customer_id = c.customer_id
        GROUP BY c.customer_state HAVING count(f.order_id) > 1000
        ORDER BY delay_rate_percent DESC, customer_state LIMIT 10"""),
    "seller_revenue_top10": _sql("fact_delivery dim_seller", """
        SELECT s.seller_id, s.seller_city, s.seller_state, count(f.order_id) AS total_orders,
               CAST(round(sum(CAST(f.price AS DECIMAL(38,12))), 2) AS DOUBLE) AS total_revenue,
               round(avg(f.delivery_duration_hours), 2) AS avg_delivery_hours,
               CAST(sum(f.is_delayed) AS BIGINT) AS delayed_orders
        FROM fact_delivery f JOIN dim_seller s ON f.seller_id = s.seller_id
        GROUP BY s.seller_id, s.seller_city, s.seller_state
        ORDER BY total_revenue DESC, s.seller_id LIMIT 10"""),
    "category_performance": _sql("fact_delivery dim_product", """
        SELECT p.product_category_name, count(f.order_id) AS items_sold,
               round(avg(p.product_weight_g), 2) AS avg_weight_g, round(avg(p.product_volume), 2) AS avg_volume_cm3,
               round(avg(f.delivery_duration_hours), 2) AS avg_delivery_hours,
               round(sum(f.is_delayed) / CAST(count(f.order_id) AS DOUBLE) * 100, 2) AS delay_rate_percent
        FROM fact_delivery f JOIN dim_product p ON f.product_id = p.product_id
        WHERE p.product_category_name IS NOT NULL
        GROUP BY p.product_category_name HAVING count(f.order_id) > 500
        ORDER BY avg_delivery_hours DESC NULLS LAST, p.product_category_name LIMIT 15"""),
    "dashboard_kpis": _sql("predictions", """
        SELECT count(*) AS total_orders, CAST(sum(is_delayed) AS BIGINT) AS actual_delayed,
               sum(predicted_is_delayed) AS predicted_delayed,
               round(avg(delay_probability) * 100, 2) AS avg_delay_probability_percent
        FROM predictions"""),
    "order_lookup": _sql("predictions", """
        SELECT order_id, is_delayed, predicted_is_delayed, delay_probability
        FROM predictions WHERE order_id = '1234'"""),
    "recent_orders": _sql("predictions", """
        SELECT order_id, is_delayed, predicted_is_delayed, delay_probability, order_purchase_timestamp
        FROM predictions ORDER BY order_purchase_timestamp DESC NULLS LAST, order_id LIMIT 100"""),
    "event_log": _sql("event_log", "SELECT * FROM event_log"),
    "event_messages": _sql("event_log", """
        SELECT order_id AS key,
               '{"event_id":"' || event_id || '","order_id":"' || order_id || '","event_type":"' || event_type
               || '","event_timestamp":"' || event_timestamp || '","produced_at":"' || produced_at || '"}' AS value
        FROM event_log"""),
    "validate_events": _sql("checked", "SELECT * FROM checked"),
    "stream_rejects": _sql("checked", "SELECT * FROM checked WHERE reject_reason IS NOT NULL"),
    "stream_ledger": _sql("checked", """
        SELECT 10 AS batches, 1 AS repeated_batches, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted,
               count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected
        FROM checked"""),
    "events_scan": _sql("accepted", "SELECT * EXCLUDE (event_time, produced_time) FROM accepted"),
    "stream_ingest": _sql("accepted", "SELECT * EXCLUDE (event_time, produced_time) FROM accepted"),
    "stream_dedup": _sql("accepted", "SELECT DISTINCT * EXCLUDE (event_time, produced_time) FROM accepted"),
    "dedup_events": _sql("accepted", "SELECT DISTINCT * EXCLUDE (event_time, produced_time) FROM accepted"),
    "dedup_report": _sql("accepted", """
        SELECT count(*) AS raw_events, count(DISTINCT event_id) AS clean_events FROM accepted"""),
    "event_places": _sql("orders_raw", """
        SELECT order_id, event_type, row_number() OVER (ORDER BY bought NULLS LAST, order_id, step) - 1 AS place
        FROM (SELECT order_id, order_purchase_timestamp AS bought, 'ORDER_CREATED' AS event_type, 0 AS step
              FROM orders_raw WHERE order_purchase_timestamp IS NOT NULL
              UNION ALL SELECT order_id, order_purchase_timestamp, 'ORDER_APPROVED', 1 FROM orders_raw WHERE order_approved_at IS NOT NULL
              UNION ALL SELECT order_id, order_purchase_timestamp, 'SHIPPED', 2 FROM orders_raw WHERE order_delivered_carrier_date IS NOT NULL
              UNION ALL SELECT order_id, order_purchase_timestamp, 'DELIVERED', 3 FROM orders_raw WHERE order_delivered_customer_date IS NOT NULL) AS e"""),
    "processed_layer": _sql("processed", "SELECT * FROM processed"),
    "curated_fact": _sql("fact_delivery", "SELECT * FROM fact_delivery"),
    "processed_events": _sql("processed", "SELECT * FROM processed"),
    "fact_delivery_event": _sql("processed", """
        SELECT event_id, order_id, event_type AS status, event_timestamp, produced_at FROM processed"""),
    "null_rates": _sql("orders_raw", """
        SELECT round(avg(CAST(order_approved_at IS NULL AS INTEGER)) * 100, 4) AS order_approved_at,
               round(avg(CAST(order_delivered_carrier_date IS NULL AS INTEGER)) * 100, 4) AS order_delivered_carrier_date,
               round(avg(CAST(order_delivered_customer_date IS NULL AS INTEGER)) * 100, 4) AS order_delivered_customer_date
        FROM orders_raw"""),
    "key_uniqueness": _sql("orders_raw customers_raw accepted", """
        SELECT table_name, key_column, rows, distinct_keys, rows = distinct_keys AS is_unique
        FROM (SELECT 'orders' AS table_name, 'order_id' AS key_column, count(*) AS rows,
                     count(DISTINCT order_id) AS distinct_keys FROM orders_raw
              UNION ALL
              SELECT 'customers', 'customer_id', count(*), count(DISTINCT customer_id) FROM customers_raw
              UNION ALL
              SELECT 'events', 'event_id', count(*), count(DISTINCT event_id) FROM accepted) AS checks"""),
    "layer_row_counts": _sql("accepted", """
        SELECT 'raw_events' AS table_name, count(*) AS rows FROM accepted
        UNION ALL SELECT 'processed_events', count(DISTINCT event_id) FROM accepted
        UNION ALL SELECT 'dim_customer', count(*) FROM customer
        UNION ALL SELECT 'dim_seller', count(*) FROM supplier
        UNION ALL SELECT 'dim_product', count(*) FROM part
        UNION ALL SELECT 'dim_location', count(DISTINCT c_nationkey) FROM customer
        UNION ALL SELECT 'fact_delivery', count(*) FROM orders"""),
    "warehouse_fact": _sql("fact_delivery", "SELECT * FROM fact_delivery"),
    "warehouse_predictions": _sql("predictions", """
        SELECT order_id, CAST(NULL AS INTEGER) AS is_delayed, predicted_is_delayed, delay_probability FROM predictions"""),
    "load_warehouse": _sql("accepted dim_date", """
        SELECT table_name, rows, true AS ok, CAST(NULL AS VARCHAR) AS error
        FROM (SELECT 'dim_customer' AS table_name, count(*) AS rows FROM customer
              UNION ALL SELECT 'dim_seller', count(*) FROM supplier
              UNION ALL SELECT 'dim_product', count(*) FROM part
              UNION ALL SELECT 'dim_location', count(DISTINCT c_nationkey) FROM customer
              UNION ALL SELECT 'dim_date', count(*) FROM dim_date
              UNION ALL SELECT 'fact_delivery', count(*) FROM orders
              UNION ALL SELECT 'fact_delivery_event', count(DISTINCT event_id) FROM accepted) AS loads"""),
    "csv_rejects": _sql("orders_raw items", """
        SELECT 'orders' AS data_set, order_id AS record_key, 'order_purchase_timestamp' AS column_name, 'oops' AS value,
               'not_timestamp_ntz' AS reason FROM orders_raw WHERE k % 97 = 0
        UNION ALL SELECT 'orders', order_id, 'order_approved_at', '1995-02-30 00:00:00', 'not_timestamp_ntz' FROM orders_raw WHERE k % 89 = 0
        UNION ALL SELECT 'order_items', CAST(l_orderkey AS VARCHAR), 'price', 'n/a', 'not_double' FROM items WHERE l_orderkey % 101 = 0
        UNION ALL SELECT 'order_items', CAST(l_orderkey AS VARCHAR), 'order_item_id', '2.5', 'not_int' FROM items WHERE l_orderkey % 103 = 0"""),
    "csv_orders": _sql("orders_raw", """
        SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 97 <> 0 THEN order_purchase_timestamp END AS order_purchase_timestamp,
                                      CASE WHEN k % 89 <> 0 THEN order_approved_at END AS order_approved_at)
        FROM orders_raw"""),
    "fact_by_month": _sql("fact_delivery", """
        SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, count(*) AS orders,
               CAST(sum(is_delayed) AS BIGINT) AS delayed, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS price
        FROM fact_delivery GROUP BY 1"""),
    "fact_of_month": _sql("fact_delivery", """
        SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, order_id, delay_days
        FROM fact_delivery WHERE strftime(order_purchase_timestamp, '%Y-%m') BETWEEN '1995-03' AND '1995-05'"""),
    "training_base": _sql("base", f"SELECT {_BASE_OUT.format(label='is_delayed, ')} FROM base"),
    "scoring_base": _sql("base", f"""
        SELECT {_BASE_OUT.format(label='')} FROM base WHERE order_delivered_customer_date IS NULL"""),
    "unscored_orders": _sql("base predictions", f"""
        SELECT {_BASE_OUT.format(label='')} FROM base
        WHERE order_delivered_customer_date IS NULL
          AND order_id NOT IN (SELECT order_id FROM predictions WHERE order_status = 'processing')"""),
    "order_distance": _sql("located", "SELECT order_id, round(distance, 6) AS distance_km FROM located"),
    "features": _sql("features", "SELECT order_id, is_delayed, " + _each("round({c}, 6) AS {c}") + " FROM features"),
    "train_test_split": _sql("features", "SELECT order_id, is_delayed, split FROM features"),
    "class_ratio": _sql("features", """
        SELECT count(*) FILTER (WHERE is_delayed = 0) AS on_time, count(*) FILTER (WHERE is_delayed = 1) AS delayed,
               round(count(*) FILTER (WHERE is_delayed = 0)
                     / CAST(nullif(count(*) FILTER (WHERE is_delayed = 1), 0) AS DOUBLE), 6) AS ratio
        FROM features"""),
    "feature_medians": _sql("medians", _each(
        "SELECT '{c}' AS feature, round(med_{c}, 6) AS median FROM medians", " UNION ALL ")),
    "feature_moments": _sql("features", _each(
        "SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS stddev FROM features",
        " UNION ALL ")),
    "features_imputed": _sql("imputed", "SELECT order_id, is_delayed, " + _each("round({c}, 6) AS {c}")
                             + " FROM imputed"),
    "features_scaled": _sql("imputed scaling", "SELECT order_id, is_delayed, " + _each(
        "round(({c} - mean_{c}) / CASE WHEN dev_{c} = 0 THEN 1 ELSE dev_{c} END, 6) AS {c}") + " FROM imputed, scaling"),
    "delay_probability_maps": _sql("fact_delivery residual_spread", """
        SELECT order_id, delay_days, CAST(delay_days > 0 AS INTEGER) AS predicted_is_delayed,
               CASE WHEN delay_days IS NOT NULL
                    THEN round(greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), delay_days / CAST(10 AS DOUBLE))), 6)
               END AS clamped_probability,
               round(1 / (1 + exp(-delay_days / CAST(2 AS DOUBLE))), 6) AS logistic_probability,
               round(1 / (1 + exp(-delay_days / spread)), 6) AS recorded_probability
        FROM fact_delivery, residual_spread"""),
    "days_scores": _sql("days_means residual_spread", """
        SELECT f.order_id, CAST(NULL AS INTEGER) AS is_delayed, CAST(m.days > 0 AS DOUBLE) AS predicted_is_delayed,
               round(1 / (1 + exp(-m.days / spread)), 6) AS delay_probability
        FROM fact_delivery f LEFT JOIN days_means m ON strftime(f.order_purchase_timestamp, '%Y-%m') = m.month, residual_spread
        WHERE f.delay_days IS NULL"""),
    "classification_metrics": _sql("predictions", """
        SELECT round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy,
               coalesce(round(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 6), 0) AS precision,
               coalesce(round(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 6), 0) AS recall,
               coalesce(round(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 6), 0) AS f1
        FROM (SELECT count(*) FILTER (WHERE is_delayed = 1 AND delay_probability >= 0.5) AS tp,
                     count(*) FILTER (WHERE is_delayed = 0 AND delay_probability >= 0.5) AS fp,
                     count(*) FILTER (WHERE is_delayed = 1 AND delay_probability < 0.5) AS fn,
                     count(*) FILTER (WHERE is_delayed = 0 AND delay_probability < 0.5) AS tn
              FROM predictions) AS counts"""),
    "roc_auc": _sql("predictions", """
        SELECT round(sum(pos * (neg_below + neg / CAST(2 AS DOUBLE))) / (sum(pos) * sum(neg)), 6) AS roc_auc
        FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY delay_probability) - neg AS neg_below
              FROM (SELECT delay_probability, CAST(sum(is_delayed) AS DOUBLE) AS pos,
                           CAST(sum(1 - is_delayed) AS DOUBLE) AS neg
                    FROM predictions GROUP BY delay_probability) AS scores) AS ranked"""),
    "confusion_counts": _sql("predictions", """
        SELECT is_delayed AS actual, CAST(predicted_is_delayed AS INTEGER) AS predicted, count(*) AS rows
        FROM predictions GROUP BY 1, 2"""),
    "fold_counts": _sql("features", """
        SELECT CAST((place - 1) % 3 AS INTEGER) AS fold, is_delayed, count(*) AS rows
        FROM (SELECT is_delayed, row_number() OVER (PARTITION BY is_delayed ORDER BY md5('42:' || order_id), order_id) AS place
              FROM features WHERE split = 'train') AS ranked
        GROUP BY 1, 2"""),
    "known_rule_scores": _sql("features", """
        SELECT order_id, CAST(month >= 7 AS DOUBLE) AS predicted_is_delayed,
               round(1 / (1 + exp(CASE WHEN month >= 7 THEN CAST(-2 AS DOUBLE) ELSE CAST(2 AS DOUBLE) END)), 6) AS delay_probability
        FROM features"""),
    "held_out_confusion": _sql("features", """
        SELECT is_delayed AS actual, CAST(month >= 7 AS INTEGER) AS predicted, count(*) AS rows
        FROM features WHERE split = 'test' GROUP BY 1, 2"""),
}
