"""Delay features: base joins, derived columns, imputation and scaling."""

from functools import reduce
from math import isnan
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from parcelyard.functions.geo import haversine_km

LABEL = "is_delayed"
# fixed values: the model's inputs, in order
FEATURES = [
    "price",
    "freight_value",
    "product_weight_g",
    "product_volume",
    "distance_km",
    "is_weekend",
    "month",
    "day_of_week",
    "is_cross_state",
    "freight_ratio",
]
# what the features read of the delivery fact
FACT_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "seller_id",
    "date_sk",
    "order_delivered_customer_date",
    LABEL,
    "price",
    "freight_value",
]
TEST_SHARE_HEX = "3333"  # first four hex digits of a digest below this: one fifth
SPLIT_SEED = 42

_BINS = 4096
_SKETCH = 10_000  # accuracy of the quantile sketch: ranks are off by a 10,000th of the rows at most


def feature_base(
    fact: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    locations: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """Fact rows with everything the features need; rows whose product, seller, zip or day is unknown
    drop out.

    Coordinates are joined to customers and sellers first, so the fact is never shuffled by zip prefix.
    """
    place = locations.select(F.col("zip_code_prefix"), "latitude", "longitude")

    def located(dim: DataFrame, who: str, short: str) -> DataFrame:
        return dim.join(
            place, F.col(f"{who}_zip_code_prefix") == F.col("zip_code_prefix")
        ).select(
            f"{who}_id",
            f"{who}_state",
            F.col("latitude").alias(f"{short}_lat"),
            F.col("longitude").alias(f"{short}_lon"),
        )

    return (
        fact.select(*FACT_COLUMNS)
        .join(dates.select("date_sk", "is_weekend", "month", "day_of_week"), "date_sk")
        .join(located(customers, "customer", "cust"), "customer_id")
        .join(located(sellers, "seller", "seller"), "seller_id")
        .join(products.select("product_id", "product_weight_g", "product_volume"), "product_id")
        .select(
            "order_id",
            LABEL,
            "order_delivered_customer_date",
            "price",
            "freight_value",
            "product_weight_g",
            "product_volume",
            "cust_lat",
            "cust_lon",
            "seller_lat",
            "seller_lon",
            "customer_state",
            "seller_state",
            "is_weekend",
            "month",
            "day_of_week",
        )
    )


def training_base(base: DataFrame, delivered_only: bool = False) -> DataFrame:
    """Rows to learn from. The label of an undelivered order is 0; `delivered_only` leaves those out."""
    rows = base.filter(F.col("order_delivered_customer_date").isNotNull()) if delivered_only else base
    return rows.drop("order_delivered_customer_date")


def scoring_base(base: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """Undelivered orders, without those in `scored` if given."""
    rows = base.filter(F.col("order_delivered_customer_date").isNull()).drop(
        "order_delivered_customer_date", LABEL
    )
    return rows if scored is None else unscored(rows, scored)


def unscored(orders: DataFrame, predictions: DataFrame) -> DataFrame:
    """Orders without a prediction. Repeated predictions collapse before the join."""
    return orders.join(predictions.select("order_id").distinct(), "order_id", "left_anti")


def distance_km() -> Column:
    return haversine_km(*[F.col(c) for c in ("cust_lat", "cust_lon", "seller_lat", "seller_lon")])


def cross_state() -> Column:
    """1.0 unless both states are known and equal."""
    return F.coalesce(F.col("customer_state") != F.col("seller_state"), F.lit(True)).cast("double")


def freight_ratio() -> Column:
    return F.try_divide(F.col("freight_value"), F.col("price") + F.lit(1e-5))


def features(base: DataFrame) -> DataFrame:
    """Order id, label if there is one, and the model's inputs as doubles."""
    derived = {
        "distance_km": distance_km(),
        "is_cross_state": cross_state(),
        "freight_ratio": freight_ratio(),
    }
    label = [LABEL] if LABEL in base.columns else []
    return base.withColumns(derived).select(
        "order_id", *label, *[F.col(c).cast("double").alias(c) for c in FEATURES]
    )


def with_split(df: DataFrame, seed: int = SPLIT_SEED) -> DataFrame:
    """Mark a fifth of the orders as test. A digest of the id decides, so an order's side never depends
    on partitioning or on the other rows."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("order_id")))
    is_test = F.substring(digest, 1, 4) < TEST_SHARE_HEX
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def class_ratio(df: DataFrame) -> DataFrame:
    """On-time rows per delayed row; NULL when nothing is delayed."""
    counts = df.agg(
        F.count_if(F.col(LABEL) == 0).alias("on_time"), F.count_if(F.col(LABEL) == 1).alias("delayed")
    )
    return counts.withColumn("ratio", F.try_divide("on_time", "delayed"))


def known(column: str) -> Column:
    """NaN and infinite values count as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def exact_medians(df: DataFrame, columns=FEATURES) -> dict[str, float | None]:
    """Exact median of each column (mean of the middle two for an even count). Runs jobs on `df`, three as a rule.

    The first pass takes a mergeable quantile sketch of each column, which gives a narrow bracket around the middle.
    The next two count the rows below each bracket and, in bins, the values inside. Should the middle be outside its
    bracket after all, or in a bin of several values, further passes narrow that column down. What leaves the
    executors is a sketch and a few thousand counts per column, however many rows there are and however often
    one value repeats.
    """
    span = df.agg(*[a for c in columns for a in _span(c)]).first()
    medians: dict[str, float | None] = {c: None for c in columns}
    # column -> bounds of the open range, ranks of the two middle values (counted from the range's start or the column's)
    search = {
        c: (*span[f"at_{c}"], (span[f"n_{c}"] - 1) // 2, span[f"n_{c}"] // 2)
        for c in columns
        if span[f"n_{c}"]
    }
    first = True
    while search:
        below, found = _bin_counts(df, search)
        for c, (lo, hi, left, right) in list(search.items()):
            if first:
                left, right = left - below[c], right - below[c]
            bins, held = found[c], sum(b["n"] for b in found[c])
            if left < 0 or right >= held:
                if not first:
                    raise ArithmeticError(f"the middle of {c} is lost")
                search[c] = (span[f"lo_{c}"], span[f"hi_{c}"], left + below[c], right + below[c])
                continue
            lower, upper = _bin_of_rank(bins, left), _bin_of_rank(bins, right)
            if lower is not upper:  # the middle falls between two bins
                medians[c] = (lower["hi"] + upper["lo"]) / 2
                del search[c]
            elif lower["lo"] == lower["hi"]:
                medians[c] = lower["lo"]
                del search[c]
            else:
                if (lower["lo"], lower["hi"]) == (lo, hi):
                    raise ArithmeticError(f"the range of {c} does not narrow")
                before = sum(b["n"] for b in bins if b["bin"] < lower["bin"])
                search[c] = (lower["lo"], lower["hi"], left - before, right - before)
        first = False
    return medians


def _span(column: str) -> list[Column]:
    """Count, ends and a bracket of the middle that the sketch's error cannot miss by much."""
    value, around = known(column), 2 / _SKETCH
    bracket = F.percentile_approx(value, [0.5 - around, 0.5 + around], _SKETCH)
    return [F.count(value).alias(f"n_{column}"), F.min(value).alias(f"lo_{column}"), F.max(value).alias(f"hi_{column}"), bracket.alias(f"at_{column}")]


def _bin_counts(df: DataFrame, search: dict) -> tuple[dict[str, int], dict[str, list]]:
    """Rows below each column's open range, and counts and ends of the bins inside it.

    One plain aggregate counts what is below every range, and at a range of one value. Only rows that are inside some
    wider range, few of all as a rule, are taken apart by column and binned.
    """

    def inside(c: str) -> Column:
        return known(c).between(*search[c][:2])

    def binned(c: str) -> Column:
        lo, hi = search[c][:2]
        value = known(c)
        # dividing both ends first keeps a range wider than the largest double finite
        share = (value / 2 - lo / 2) / F.lit(hi / 2 - lo / 2)
        place = F.least(F.lit(_BINS - 1), F.floor(share * _BINS).cast("int"))
        return F.struct(
            F.lit(c).alias("column"),
            F.when(inside(c), place).cast("long").alias("bin"),
            value.alias("value"),
        )

    counts = [F.count_if(known(c) < search[c][0]).alias(f"below_{c}") for c in search]
    counted = df.agg(*counts, *[F.count_if(inside(c)).alias(f"in_{c}") for c in search]).first()
    under, out = {c: counted[f"below_{c}"] for c in search}, {c: [] for c in search}
    wide = []
    for c, (lo, hi, *_) in search.items():
        if lo < hi and counted[f"in_{c}"]:
            wide.append(c)
        elif counted[f"in_{c}"]:
            out[c].append({"bin": 0, "n": counted[f"in_{c}"], "lo": lo, "hi": lo})
    if wide:
        # filtering after the explode, not the array before it, stays in generated code
        rows = (
            df.filter(reduce(or_, [inside(c) for c in wide]))
            .select(F.explode(F.array(*[binned(c) for c in wide])).alias("v"))
            .select("v.*")
            .filter(F.col("bin").isNotNull())
            .groupBy("column", "bin")
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
            .collect()
        )
        for row in sorted(rows, key=lambda r: r["bin"]):
            out[row["column"]].append(row)
    return under, out


def _bin_of_rank(bins: list, rank: int):
    for b in bins:
        if rank < b["n"]:
            return b
        rank -= b["n"]
    raise ValueError("rank beyond the counted values")


def impute(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Fill missing values. A column without any known value is filled with 0."""
    return df.withColumns(
        {c: F.coalesce(known(c), F.lit(0.0 if m is None else float(m))) for c, m in medians.items()}
    )


def moments(df: DataFrame, columns=FEATURES) -> DataFrame:
    """Mean and population standard deviation of each column, one row per column."""
    wide = df.agg(*[F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"),
                             F.stddev_pop(c).alias("stddev")).alias(c) for c in columns])
    return wide.select(F.explode(F.array(*columns)).alias("m")).select("m.*")


def collected_moments(df: DataFrame, columns=FEATURES) -> dict[str, tuple[float, float]]:
    """`moments` as numbers: one row per column, so at most a handful. A constant column gets deviation 1,
    which leaves it 0 after centring."""
    def divisor(stddev):
        return 1.0 if stddev is None or isnan(stddev) or stddev == 0 else stddev

    return {r["feature"]: (r["mean"] or 0.0, divisor(r["stddev"])) for r in moments(df, columns).collect()}


def scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - mean) / F.lit(dev) for c, (mean, dev) in fitted.items()})
