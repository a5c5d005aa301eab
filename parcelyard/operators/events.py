"""Order life-cycle events: produce, check, clean."""

from pyspark.sql import Column, DataFrame, functions as F

from parcelyard.functions import messages as msg
from parcelyard.functions.timestamps import event_time_text, iso_utc_text, utc_clock, utc_now
from parcelyard.operators.dedup import keep_one
from parcelyard.operators.ranking import rank_within

# fixed values: order column -> event type, in life-cycle order
LIFE_CYCLE = {
    "order_purchase_timestamp": "ORDER_CREATED",
    "order_approved_at": "ORDER_APPROVED",
    "order_delivered_carrier_date": "SHIPPED",
    "order_delivered_customer_date": "DELIVERED",
}
EVENT_COLUMNS = list(msg.REQUIRED_KEYS)


def event_log(
    orders: DataFrame, produced_at: Column | None = None, global_order: bool = False
) -> DataFrame:
    """Up to four events per order, one per milestone that has a time.

    Orders are unfolded where they are, so the events of an order stay together in life-cycle order without a
    shuffle; `global_order` sorts all orders by purchase time first (see also `emission_places`).
    The event id is a digest of order, type and time: a retried task repeats it, so replays can be dropped.
    """
    produced_at = utc_now() if produced_at is None else produced_at
    source = orders.select(F.col("order_id").cast("string").alias("order_id"), *LIFE_CYCLE)
    ordered = source.orderBy(F.asc_nulls_last("order_purchase_timestamp"), F.asc("order_id")) if global_order else source
    steps = F.array(
        *[
            F.struct(
                F.lit(kind).alias("event_type"),
                event_time_text(F.col(column)).alias("event_timestamp"),
            )
            for column, kind in LIFE_CYCLE.items()
        ]
    )
    return (
        ordered.select("order_id", F.inline(steps))
        .filter(F.col("event_timestamp").isNotNull())
        .select(
            F.sha2(F.concat_ws("|", "order_id", "event_type", "event_timestamp"), 256).alias("event_id"),
            "order_id",
            "event_type",
            "event_timestamp",
            iso_utc_text(produced_at).alias("produced_at"),
        )
    )


def emission_places(orders: DataFrame) -> DataFrame:
    """order_id, event_type and the place, from 0, of each event when events are emitted one by one: by the order's purchase
    time (unknown last), order id and life-cycle step. The sort is by range, with one number a partition counted on."""
    steps = [F.struct(F.lit(kind).alias("event_type"), F.lit(step).alias("step"), F.col(c).alias("at")) for step, (c, kind) in enumerate(LIFE_CYCLE.items())]
    order_id, purchased = F.col("order_id").cast("string").alias("order_id"), F.col("order_purchase_timestamp").alias("purchased")
    events = orders.select(order_id, purchased, F.inline(F.array(*steps))).filter(F.col("at").isNotNull())
    order = [F.asc_nulls_last("purchased"), F.asc("order_id"), F.asc("step")]
    return rank_within(events.withColumn("all", F.lit(0)), "all", order, "place").select("order_id", "event_type", "place")


def event_messages(events: DataFrame) -> DataFrame:
    """Keyed messages. The key is the order, so a topic keeps an order's events in one partition."""
    body = F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"})
    return events.select(
        F.encode("order_id", "UTF-8").alias("key"), F.encode(body, "UTF-8").alias("value")
    )


def check_messages(messages: DataFrame) -> DataFrame:
    """Add `text` and `reject_reason` (NULL when the message is accepted) to each message.

    Text, its end mark, the parsed JSON and its fields each come out of a generator, so a message is decoded, hashed
    and parsed once: nothing above can be merged into them or pushed below them and do it again.
    """

    def once(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))

    text, mark, parts, fields = (F.col(c) for c in ("text", "_mark", "_parts", "_fields"))
    decoded = once(messages, text=msg.decoded_text(F.col("value")))
    parsed = once(once(decoded, _mark=msg.end_mark(text)), _parts=msg.parsed_parts(text, mark))
    reason = (
        F.when(text.isNull(), "undecodable")
        .when(fields.isNull() & msg.is_other_json(text, mark), "not_an_object")
        .when(fields.isNull(), "malformed_json")
        .when(msg.lacks_required_key(fields), "missing_key")
    )
    whole = once(parsed, _fields=msg.object_fields(parts, mark)).drop("_parts")
    return once(whole, reject_reason=reason).drop("_mark", "_fields")


def accepted_lines(checked: DataFrame) -> DataFrame:
    """Accepted messages as JSON Lines text. The whole object is kept, unknown keys included; a line break
    can only stand between JSON tokens, so a space may replace it."""
    line = F.regexp_replace("text", r"[\r\n]+", " ")
    return checked.filter(F.col("reject_reason").isNull()).select(line.alias("value"))


def accepted_events(checked: DataFrame) -> DataFrame:
    """Accepted messages as five text columns."""
    accepted = checked.filter(F.col("reject_reason").isNull())
    return accepted.select(F.inline(F.array(msg.required_values(F.col("text")))))


def rejected_messages(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNotNull()).select(
        F.col("value").cast("binary").alias("value"), "reject_reason"
    )


def dedup_events(events: DataFrame) -> DataFrame:
    return keep_one(events.select(*EVENT_COLUMNS), "event_id")


def processed_events(events: DataFrame) -> DataFrame:
    """One row per event id, with typed times. Text that is not a time becomes NULL."""
    return dedup_events(events).select(
        "event_id",
        "order_id",
        "event_type",
        utc_clock(F.col("event_timestamp")).alias("event_timestamp"),
        utc_clock(F.col("produced_at")).alias("produced_at"),
    )


def fact_delivery_event(processed: DataFrame) -> DataFrame:
    return processed.select(
        "event_id", "order_id", F.col("event_type").alias("status"), "event_timestamp", "produced_at"
    )


def dedup_report(events: DataFrame) -> DataFrame:
    """Raw and distinct event counts in one pass; a NULL id counts as one event, as in `dedup_events`."""
    return (
        events.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("raw_events"),
            F.count(F.lit(1)).alias("clean_events"),
        )
    )
