"""Every operator as a query over the retail test tables."""

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelyard import schemas
from parcelyard.functions import scores
from parcelyard.models import days, search
from parcelyard.models.scoring import PREDICTION_COLUMNS, load_model, save_model, score
from parcelyard.models.search import SEED, fold_scores
from parcelyard.models.training import Grid, train_delay_model
from parcelyard.operators import dashboard, events, evaluation, features as feat, quality, reports, star
from parcelyard.operators.ranking import stratified_folds
from parcelyard.plans.delay_model import train_and_evaluate
from parcelyard.plans.etl import TABLE_ORDER
from parcelyard.sinks import warehouse
from parcelyard.sinks.files import MONTH, fact_months, write_clean_csv, write_event_lines, write_fact_months, write_recorded
from parcelyard.sources import files, retail
from parcelyard.sources.files import event_files, warehouse_table
from parcelyard.sources.kafka import message_files
from parcelyard.streaming import ingest, ledger
from parcelyard.workspace import new_folder, staged, staged_by_key

PRODUCED_AT = "2024-01-01 00:00:00"
LOOKED_UP_ORDER = "1234"
# the reports' own thresholds suit millions of orders; the test tables have far fewer per state
STATE_THRESHOLD = 500
FOLDS = 3
# batches of the streamed messages, and the one that fails once
BATCHES, FAILING_BATCH, DEDUP_BATCHES = 10, 4, 3
# months of `fact_by_month` and `fact_of_month`
RELOADED_MONTH, LAST_MONTH = "1995-03", "1995-05"
# layers whose rows are counted
COUNTED = ("raw_events", "processed_events", "dim_customer", "dim_seller", "dim_product", "dim_location", "fact_delivery")
# a label that follows from one feature, and the one tree with one cut that learns it
RULE_MONTH = 7
RULE_GRID = Grid(trees=(1,), learning_rates=(0.1,), depths=(1,), weight_factors=(1.0,))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# what this process has stored: (application, folder, name) -> table, path or model
_made: dict[tuple[str, str, str], object] = {}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _once(spark, folder, name, make):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# ---- star schema ----


@_query
def clean_orders(spark, folder):
    return star.clean_orders(retail.orders(spark, folder))


@_query
def dim_customer(spark, folder):
    return star.dim_customer(retail.customers(spark, folder))


@_query
def dim_seller(spark, folder):
    return star.dim_seller(retail.sellers(spark, folder))


@_query
def dim_product(spark, folder):
    return star.dim_product(retail.products(spark, folder))


@_query
def dim_location(spark, folder):
    return _rounded(_locations(spark, folder), "latitude", "longitude")


def _locations(spark, folder):
    return star.dim_location(retail.geolocation(spark, folder))


@_query
def dim_date(spark, folder):
    return star.dim_date(retail.orders(spark, folder))


@_query
def order_items_agg(spark, folder):
    return star.order_items_agg(retail.order_items(spark, folder))


def _fact(spark, folder, customers):
    return star.fact_delivery(
        retail.orders(spark, folder), retail.order_items(spark, folder), customers
    )


def _lean_fact(spark, folder):
    """The fact for queries that do not read the customer's zip. The unstaged dimension is known to have one
    row per customer, so the optimizer drops its join; the join with the items goes the same way."""
    return _fact(spark, folder, dim_customer(spark, folder))


def _runs(spark, folder):
    """The table of runs: one row per layer written."""
    return _once(spark, folder, "runs", lambda: new_folder(spark, "layer-runs"))


def _layer(spark, folder, name, build):
    """A layer that is written once, with its row count recorded, and read back."""

    def write():
        rows, path = build(), new_folder(spark, name)
        write_recorded(rows, path, name, _runs(spark, folder))
        return spark.read.schema(rows.schema).parquet(path)

    return _once(spark, folder, f"layer {name}", write)


def curated(spark, folder, name):
    """A table of the star schema, built once and read back from storage."""
    build = {
        "dim_customer": dim_customer,
        "dim_seller": dim_seller,
        "dim_product": dim_product,
        "dim_location": _locations,
        "dim_date": dim_date,
        "fact_delivery": fact_delivery,
        "fact_delivery_event": lambda *_: events.fact_delivery_event(_processed(spark, folder)),
    }[name]
    return _layer(spark, folder, name, lambda: build(spark, folder))


def _by_order(spark, folder, name, build):
    """A table of orders, stored once in buckets of order_id."""
    return _once(spark, folder, f"by order {name}", lambda: staged_by_key(build(), name, "order_id"))


def _stored_fact(spark, folder):
    """The fact with the customer's zip, stored once: its Parquet layer."""
    return curated(spark, folder, "fact_delivery")


def _order_fact(spark, folder):
    """What the features read of the fact, in buckets of order_id. The zip is not among it, so neither orders nor fact
    are dealt by customer here: items and orders are dealt by order once, and stored where they join."""
    return _by_order(spark, folder, "feature_fact", lambda: _lean_fact(spark, folder).select(*feat.FACT_COLUMNS))


def _raw_events(spark, folder):
    return _layer(spark, folder, "raw_events", lambda: _accepted(spark, folder))


def _processed(spark, folder):
    return _layer(spark, folder, "processed_events", lambda: events.processed_events(_raw_events(spark, folder)))


@_query
def fact_delivery(spark, folder):
    return _fact(spark, folder, curated(spark, folder, "dim_customer"))


def _csv_files(spark, folder):
    """Orders and items as CSV files whose header is in another order than declared, with values that do not fit."""

    def write():
        path, k = new_folder(spark, "csv"), F.col("order_id").cast("bigint")
        orders = retail.orders(spark, folder).withColumns(
            {
                "order_purchase_timestamp": F.when(k % 97 == 0, F.lit("oops")).otherwise(F.col("order_purchase_timestamp").cast("string")),
                "order_approved_at": F.when(k % 89 == 0, F.lit("1995-02-30 00:00:00")).otherwise(F.col("order_approved_at").cast("string")),
            }
        )
        items = retail.order_items(spark, folder).withColumns(
            {
                "price": F.when(k % 101 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string")),
                "order_item_id": F.when(k % 103 == 0, F.lit("2.5")).otherwise(F.col("order_item_id").cast("string")),
                "shipping_limit_date": F.lit(None).cast("string"),
            }
        )
        write_clean_csv(orders.select(*reversed(orders.columns)), f"{path}/orders.csv")
        write_clean_csv(items.select(*reversed(items.columns)), f"{path}/order_items.csv")
        return path

    return _once(spark, folder, "csv files", write)


@_query
def csv_rejects(spark, folder):
    path = _csv_files(spark, folder)
    return files.csv_rejects(spark, "orders", f"{path}/orders.csv").unionByName(files.csv_rejects(spark, "order_items", f"{path}/order_items.csv"))


@_query
def csv_orders(spark, folder):
    """The orders that the CSV files give, cleaned: what does not fit is NULL."""
    return star.clean_orders(files.raw_csv(spark, "orders", f"{_csv_files(spark, folder)}/orders.csv"))


@_query
def curated_fact(spark, folder):
    """The fact as its Parquet layer has it."""
    return curated(spark, folder, "fact_delivery")


# ---- reports and dashboard ----


@_query
def monthly_performance(spark, folder):
    return reports.monthly_performance(_lean_fact(spark, folder))


@_query
def state_performance(spark, folder, min_deliveries=STATE_THRESHOLD):
    return reports.state_performance(
        _lean_fact(spark, folder), dim_customer(spark, folder), min_deliveries
    )


@_query
def state_performance_1000(spark, folder):
    """The same report with its own threshold, which the smaller test tables do not reach."""
    return state_performance(spark, folder, reports.MIN_STATE_DELIVERIES)


@_query
def seller_revenue_top10(spark, folder):
    return reports.seller_revenue(_lean_fact(spark, folder), dim_seller(spark, folder))


@_query
def category_performance(spark, folder):
    return reports.category_performance(_lean_fact(spark, folder), dim_product(spark, folder))


@_query
def dashboard_kpis(spark, folder):
    return dashboard.dashboard_kpis(retail.predictions(spark, folder))


@_query
def order_lookup(spark, folder):
    return dashboard.order_lookup(
        retail.predictions(spark, folder, LOOKED_UP_ORDER), LOOKED_UP_ORDER
    )


@_query
def recent_orders(spark, folder):
    return dashboard.recent_orders(retail.predictions(spark, folder))


# ---- events ----


def _checked(spark, folder):
    return events.check_messages(retail.messages(spark, folder))


def _accepted(spark, folder):
    return events.accepted_events(_checked(spark, folder))


def _event_log(spark, folder):
    return events.event_log(
        retail.orders(spark, folder), F.lit(PRODUCED_AT).cast("timestamp_ntz")
    )


@_query
def event_log(spark, folder):
    return _event_log(spark, folder)


@_query
def event_places(spark, folder):
    return events.emission_places(retail.orders(spark, folder))


@_query
def event_messages(spark, folder):
    sent = events.event_messages(_event_log(spark, folder))
    return sent.select(*[F.decode(c, "UTF-8").alias(c) for c in ("key", "value")])


@_query
def validate_events(spark, folder):
    return _checked(spark, folder).select(F.col("text").alias("message"), "reject_reason")


@_query
def events_scan(spark, folder):
    path = new_folder(spark, "event-lines")
    write_event_lines(events.accepted_lines(_checked(spark, folder)), path)
    return event_files(spark, path).select(*events.EVENT_COLUMNS)


@_query
def dedup_events(spark, folder):
    return events.dedup_events(_accepted(spark, folder))


@_query
def dedup_report(spark, folder):
    return events.dedup_report(_accepted(spark, folder))


@_query
def processed_events(spark, folder):
    return events.processed_events(_accepted(spark, folder))


@_query
def fact_delivery_event(spark, folder):
    return events.fact_delivery_event(processed_events(spark, folder))


@_query
def processed_layer(spark, folder):
    """The processed events as their Parquet layer has them."""
    return _processed(spark, folder)


def _message_stream(spark, folder, batches=None):
    """The messages as a stream; with `batches`, in that many files, one for each batch."""
    path = new_folder(spark, "messages")
    lines = retail.messages(spark, folder).select(F.col("value").cast("string").alias("value"))
    write_event_lines(lines.repartition(batches) if batches else lines, path)
    return message_files(spark, path, 1 if batches else None)


def _ingested(spark, folder):
    """The sink of an ingest in `BATCHES` batches. One of them fails between sink and commit and runs again, and half
    way the batches so far are compacted."""

    def fail_once(batch_id):
        if batch_id == FAILING_BATCH:
            raise RuntimeError("forced: stored, but not committed")

    def run():
        sink, messages = new_folder(spark, "ingest"), _message_stream(spark, folder, BATCHES)
        with suppress(StreamingQueryException):
            ingest.start_ingest(messages, sink, f"{sink}/checkpoint", stored=fail_once).awaitTermination()
        ledger.compact(spark, sink)
        ingest.start_ingest(messages, sink, f"{sink}/checkpoint").awaitTermination()
        return sink

    return _once(spark, folder, "ingested", run)


@_query
def stream_ingest(spark, folder):
    return ingest.ingested_events(spark, _ingested(spark, folder)).select(*events.EVENT_COLUMNS)


@_query
def stream_rejects(spark, folder):
    rejects = ingest.ingested_rejects(spark, _ingested(spark, folder))
    return rejects.select(F.decode("value", "UTF-8").alias("message"), "reject_reason")


@_query
def stream_ledger(spark, folder):
    return ledger.summary(ledger.entries(spark, _ingested(spark, folder)))


@_query
def stream_dedup(spark, folder):
    """Events of the messages, streamed in `DEDUP_BATCHES` batches, without repeats that come within ten minutes."""
    sink, checkpoint = new_folder(spark, "stream-dedup"), new_folder(spark, "checkpoint")
    ingest.start_dedup(_message_stream(spark, folder, DEDUP_BATCHES), sink, checkpoint).awaitTermination()
    return spark.read.schema(schemas.EVENT_TEXT).json(sink)


# ---- quality ----


@_query
def null_rates(spark, folder):
    return quality.null_rates(retail.orders(spark, folder))


@_query
def key_uniqueness(spark, folder):
    checks = [
        quality.key_uniqueness(retail.orders(spark, folder), "order_id", "orders"),
        quality.key_uniqueness(retail.customers(spark, folder), "customer_id", "customers"),
        quality.key_uniqueness(_accepted(spark, folder), "event_id", "events"),
    ]
    return reduce(DataFrame.unionByName, checks)


@_query
def layer_row_counts(spark, folder):
    """Counts that the writes of the layers observed."""
    _processed(spark, folder)
    for name in COUNTED[2:]:
        curated(spark, folder, name)
    runs = spark.read.schema("layer string, rows long, finished_at timestamp_ntz").parquet(_runs(spark, folder))
    return quality.recorded_row_counts(runs.filter(F.col("layer").isin(*COUNTED)))


def _warehouse(spark, folder):
    """A database whose tables were loaded twice, and the status of the second load."""

    def load():
        location = new_folder(spark, "warehouse")
        database = location.rsplit("/", 1)[-1].replace("-", "_")
        warehouse.create_tables(spark, database, location)
        tables = {name: (lambda n=name: curated(spark, folder, n)) for name in TABLE_ORDER}
        warehouse.load_tables(spark, database, {name: (lambda n=name: curated(spark, folder, n).limit(1)) for name in TABLE_ORDER})
        return database, warehouse.load_tables(spark, database, tables)

    return _once(spark, folder, "warehouse", load)


@_query
def load_warehouse(spark, folder):
    return _warehouse(spark, folder)[1]


@_query
def warehouse_fact(spark, folder):
    """The fact as the warehouse has it after a second load replaced the first."""
    return warehouse_table(spark, _warehouse(spark, folder)[0], "fact_delivery")


@_query
def warehouse_predictions(spark, folder):
    """Predictions appended in two runs; the second leaves out orders that have one."""

    def append():
        database = _warehouse(spark, folder)[0]
        found = retail.predictions(spark, folder).select("order_id", "predicted_is_delayed", "delay_probability")
        warehouse.append_predictions(found.filter(F.col("order_id").cast("bigint") % 3 == 0), database, skip_scored=True)
        warehouse.append_predictions(found, database, skip_scored=True)
        return database

    database = _once(spark, folder, "predictions appended", append)
    return warehouse_table(spark, database, "fact_delivery_prediction")


# ---- features and model ----


@_query
def fact_by_month(spark, folder):
    """Rows and delays by month folder, after one month was loaded a second time by itself."""
    path = new_folder(spark, "fact-months")
    fact = _stored_fact(spark, folder)
    write_fact_months(fact, path)
    write_fact_months(fact.filter(F.date_format("order_purchase_timestamp", "yyyy-MM") == RELOADED_MONTH), path)
    return (
        fact_months(spark, path)
        .groupBy(MONTH)
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("is_delayed").alias("delayed"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("price"))
    )


@_query
def fact_of_month(spark, folder):
    """The orders of three months, from their folders alone."""
    path = _once(spark, folder, "fact months", lambda: new_folder(spark, "fact-months"))
    _once(spark, folder, "fact months written", lambda: write_fact_months(_stored_fact(spark, folder), path))
    return fact_months(spark, path, RELOADED_MONTH, LAST_MONTH).select(MONTH, "order_id", "delay_days")


def _feature_base(spark, folder):
    dims = {
        name: curated(spark, folder, f"dim_{name}")
        for name in ("customer", "seller", "product", "location", "date")
    }
    return feat.feature_base(
        _order_fact(spark, folder),
        dims["product"],
        dims["customer"],
        dims["seller"],
        dims["location"],
        dims["date"],
    )


_COORDINATES = ("cust_lat", "cust_lon", "seller_lat", "seller_lon")


@_query
def training_base(spark, folder):
    return _rounded(feat.training_base(_feature_base(spark, folder)), *_COORDINATES)


@_query
def scoring_base(spark, folder):
    return _rounded(feat.scoring_base(_feature_base(spark, folder)), *_COORDINATES)


@_query
def unscored_orders(spark, folder):
    scored = _by_order(spark, folder, "earlier_predictions", lambda: retail.earlier_predictions(spark, folder))
    return _rounded(feat.scoring_base(_feature_base(spark, folder), scored), *_COORDINATES)


@_query
def order_distance(spark, folder):
    base = feat.training_base(_feature_base(spark, folder))
    return base.select("order_id", F.round(feat.distance_km(), 6).alias("distance_km"))


def training_features(spark, folder):
    """Read several times by what follows, so stored."""
    rows = lambda: feat.features(feat.training_base(_feature_base(spark, folder)))
    return _once(spark, folder, "training features", lambda: staged(rows(), "training-features"))


def _train_side(spark, folder):
    split = feat.with_split(training_features(spark, folder))
    return split.filter(F.col("split") == "train").drop("split")


@_query
def features(spark, folder):
    rows = feat.features(feat.training_base(_feature_base(spark, folder)))
    return _rounded(rows, *feat.FEATURES)


@_query
def train_test_split(spark, folder):
    return feat.with_split(feat.training_base(_feature_base(spark, folder))).select(
        "order_id", "is_delayed", "split"
    )


@_query
def class_ratio(spark, folder):
    return _rounded(feat.class_ratio(feat.training_base(_feature_base(spark, folder))), "ratio")


def _medians(spark, folder):
    return _once(spark, folder, "medians", lambda: feat.exact_medians(_train_side(spark, folder)))


@_query
def feature_medians(spark, folder):
    rows = spark.createDataFrame(list(_medians(spark, folder).items()), "feature string, median double")
    return _rounded(rows, "median")


@_query
def feature_moments(spark, folder):
    return _rounded(feat.moments(training_features(spark, folder)), "mean", "stddev")


@_query
def features_imputed(spark, folder):
    return _rounded(feat.impute(training_features(spark, folder), _medians(spark, folder)), *feat.FEATURES)


@_query
def features_scaled(spark, folder):
    medians = _medians(spark, folder)
    scaling = feat.collected_moments(feat.impute(_train_side(spark, folder), medians))
    filled = feat.impute(training_features(spark, folder), medians)
    return _rounded(feat.scale(filled, scaling), *feat.FEATURES)


def _orders_by_month(spark, folder):
    return _stored_fact(spark, folder).select("order_id", "delay_days", F.date_format("order_purchase_timestamp", "yyyy-MM").alias(MONTH))


def _days_model(spark, folder):
    """A stored model of delay days by month of purchase."""

    def train():
        path = new_folder(spark, "days-model")
        days.train_days_model(_orders_by_month(spark, folder), MONTH, path)
        return path

    return _once(spark, folder, "days model", train)


@_query
def days_scores(spark, folder):
    """Orders without a delivery, scored by the stored model of delay days."""
    waiting = _orders_by_month(spark, folder).filter(F.col("delay_days").isNull())
    return _rounded(days.score_days(spark, waiting, MONTH, _days_model(spark, folder)), "delay_probability")


@_query
def delay_probability_maps(spark, folder):
    recorded = days.residual_scale(days.read_metadata(spark, _days_model(spark, folder)))
    late = F.col("delay_days").cast("double")
    return _lean_fact(spark, folder).select(
        "order_id",
        "delay_days",
        scores.delayed_class(late).alias("predicted_is_delayed"),
        F.round(scores.clamped_probability(late), 6).alias("clamped_probability"),
        F.round(scores.logistic_probability(late), 6).alias("logistic_probability"),
        F.round(scores.logistic_probability(late, recorded), 6).alias("recorded_probability"),
    )


@_query
def classification_metrics(spark, folder):
    metrics = evaluation.classification_metrics(retail.predictions(spark, folder))
    return _rounded(metrics, *metrics.columns)


@_query
def roc_auc(spark, folder):
    area = evaluation.roc_auc(retail.predictions(spark, folder))
    return _rounded(spark.createDataFrame([(area,)], "roc_auc double"), "roc_auc")


@_query
def confusion_counts(spark, folder):
    return evaluation.confusion_counts(retail.predictions(spark, folder), "predicted_is_delayed")


@_query
def fold_counts(spark, folder):
    """Rows per fold and class of the exactly stratified folds over all training rows."""
    folds = stratified_folds(_train_side(spark, folder).select("order_id", feat.LABEL), FOLDS, feat.LABEL, "order_id", SEED)
    return folds.groupBy("fold", feat.LABEL).agg(F.count(F.lit(1)).alias("rows"))


@_query
def grid_scores(spark, folder):
    """All 81 points of the default grid on three folds, learned from all training rows."""
    train = _train_side(spark, folder)
    ratio = feat.class_ratio(train).first()["ratio"] or 1.0
    return search.grid_scores(fold_scores(train, _medians(spark, folder), ratio, Grid(), FOLDS), FOLDS)


def _trained(spark, folder):
    """The model's path and its metrics on the test side: the full grid, then a fit on all training rows."""

    def train():
        path = new_folder(spark, "model")
        trained, metrics = train_and_evaluate(training_features(spark, folder))
        save_model(trained.model, path, trained.signature)
        return path, metrics

    return _once(spark, folder, "model", train)


@_query
def train_eval(spark, folder):
    return _trained(spark, folder)[1]


@_query
def score_orders(spark, folder):
    """Undelivered orders, scored with the model that training stored."""
    rows = feat.features(feat.scoring_base(_feature_base(spark, folder)))
    return score(load_model(_trained(spark, folder)[0]), rows).select(*PREDICTION_COLUMNS)


def _rule_model(spark, folder):
    """A stored model whose output is known: one tree of one cut, learned from a label that is a cut of one feature.
    Its leaves hold one class each, so a score is 1 / (1 + e^-2) or 1 / (1 + e^2)."""

    def train():
        path = new_folder(spark, "rule-model")
        rule = (F.col("month") >= RULE_MONTH).cast("int")
        trained = train_delay_model(_train_side(spark, folder).withColumn(feat.LABEL, rule), RULE_GRID)
        save_model(trained.model, path, trained.signature)
        return path

    return load_model(_once(spark, folder, "rule-model", train))


@_query
def known_rule_scores(spark, folder):
    scored = score(_rule_model(spark, folder), training_features(spark, folder))
    return _rounded(scored.select(*PREDICTION_COLUMNS), "delay_probability")


@_query
def held_out_confusion(spark, folder):
    """Test orders by known class and the class that the rule's model gives."""
    split = feat.with_split(training_features(spark, folder))
    test = split.filter(F.col("split") == "test").drop("split")
    return evaluation.confusion_counts(score(_rule_model(spark, folder), test), "predicted_is_delayed")
