import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.support import rows
from parcelyard.operators import evaluation, features as feat, star

BASE = (
    "order_id string, is_delayed int, price double, freight_value double, product_weight_g double, "
    "product_volume double, cust_lat double, cust_lon double, seller_lat double, seller_lon double, "
    "customer_state string, seller_state string, is_weekend boolean, month int, day_of_week int"
)


@pytest.fixture(scope="module")
def base(raw):
    customers = star.dim_customer(raw["customers"])
    fact = star.fact_delivery(raw["orders"], raw["order_items"], customers)
    return feat.feature_base(
        fact,
        star.dim_product(raw["products"]),
        customers,
        star.dim_seller(raw["sellers"]),
        star.dim_location(raw["geolocation"]),
        star.dim_date(star.clean_orders(raw["orders"])),
    )


def test_base_drops_rows_with_an_unknown_side(base):
    assert {r["order_id"] for r in base.collect()} == {"A", "B", "C", "D", "F"}
    assert {r["order_id"] for r in feat.training_base(base, delivered_only=True).collect()} == {"A", "B", "D"}


def test_scoring_base(base, spark):
    assert {r["order_id"] for r in feat.scoring_base(base).collect()} == {"C", "F"}
    scored = spark.createDataFrame([("F",), ("F",), ("Z",)], "order_id string")
    assert {r["order_id"] for r in feat.scoring_base(base, scored).collect()} == {"C"}


def test_an_empty_base_keeps_its_columns(base):
    none = feat.features(feat.scoring_base(base.limit(0)))
    assert none.count() == 0 and none.columns == ["order_id", *feat.FEATURES]


def test_derived_features(spark):
    def row(price, freight, customer, seller, lat):
        return ("o", 0, price, freight, 1.0, 1.0, lat, -46.63, -22.91, -43.17, customer, seller, True, 7, 1)

    data = [
        row(0.0, 5.0, "SP", "SP", -23.55),
        row(10.0, 5.0, "SP", "RJ", -23.55),
        row(10.0, None, None, "SP", None),
        row(-1e-5, 5.0, None, None, -23.55),
    ]
    got = feat.features(spark.createDataFrame(data, BASE)).collect()
    assert [r["is_cross_state"] for r in got] == [0.0, 1.0, 1.0, 1.0]
    assert got[0]["freight_ratio"] == pytest.approx(5 / 1e-5)
    assert (got[2]["freight_ratio"], got[3]["freight_ratio"]) == (None, None)
    assert got[0]["distance_km"] == pytest.approx(360.6238809880915)
    assert got[2]["distance_km"] is None
    assert (got[0]["is_weekend"], got[0]["month"], got[0]["day_of_week"]) == (1.0, 7.0, 1.0)


def test_split_is_a_stable_fifth(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("order_id"))
    test = {r[0] for r in feat.with_split(ids).filter("split = 'test'").select("order_id").collect()}
    again = feat.with_split(ids.repartition(7).filter("cast(order_id as int) > 500")).filter("split = 'test'")
    assert {r[0] for r in again.select("order_id").collect()} == {i for i in test if int(i) > 500}
    assert 0.18 < len(test) / 20_000 < 0.22


def test_class_ratio(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "is_delayed int")
    assert rows(feat.class_ratio(df)) == [(3, 1, 3.0)]
    assert rows(feat.class_ratio(df.filter("is_delayed = 0"))) == [(3, 0, None)]


@pytest.mark.parametrize("seed", range(4))
def test_medians_against_brute_force(spark, seed, monkeypatch):
    """Few bins force many passes; hot values, long tails, ties, NULL and NaN are all there."""
    monkeypatch.setattr(feat, "_BINS", 5)
    rnd = random.Random(seed)
    n = rnd.choice([1, 2, 501, 1000])
    data = [
        (
            rnd.gauss(0, 1),
            7.0 if rnd.random() < 0.34 else rnd.uniform(6.9, 7.1),
            rnd.choice([None, float("nan"), 1e-3, 1e12 * rnd.random()]),
            float(rnd.choice([0, 1])),
            rnd.lognormvariate(0, 3),
            3.0,
            None,
        )
        for _ in range(n)
    ]
    names = [f"x{i}" for i in range(7)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in names)).repartition(3)
    want = {}
    for i, c in enumerate(names):
        known = [r[i] for r in data if r[i] is not None and r[i] == r[i]]
        want[c] = statistics.median(known) if known else None
    assert feat.exact_medians(df, names) == want


def test_medians_of_neighbouring_and_extreme_doubles(spark):
    values = [-1.7e308, 1.0, 1.0 + 2**-52, 1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert feat.exact_medians(df, ["x"]) == {"x": statistics.median(values)}


def test_impute_and_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0), (8.0, None)], "x double, k double")
    medians = feat.exact_medians(df, ["x", "k"])
    assert medians == {"x": 3.0, "k": 5.0}
    filled = feat.impute(df, medians)
    assert sorted(r["x"] for r in filled.collect()) == [1.0, 3.0, 3.0, 8.0]
    fitted = feat.collected_moments(filled, ["x", "k"])
    assert fitted["x"] == (3.75, pytest.approx(2.5860, abs=1e-4)) and fitted["k"] == (5.0, 1.0)
    scaled = feat.scale(filled, fitted).collect()
    assert {r["k"] for r in scaled} == {0.0}
    assert sum(r["x"] for r in scaled) == pytest.approx(0.0)


SCORED = "is_delayed int, delay_probability double"


def test_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.4), (0, 0.3), (0, 0.4)], SCORED)
    assert rows(evaluation.classification_metrics(df)) == [(0.6, 0.5, 0.5, 0.5)]
    assert evaluation.roc_auc(df) == pytest.approx(0.75)
    assert rows(evaluation.classification_metrics(df, threshold=0.95)) == [(0.6, 0.0, 0.0, 0.0)]


def test_auc_against_brute_force(spark):
    rnd = random.Random(5)
    data = [(int(rnd.random() < 0.2), round(rnd.random(), 2) if rnd.random() < 0.7 else 0.5) for _ in range(400)]
    pos, neg = [p for y, p in data if y], [p for y, p in data if not y]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    df = spark.createDataFrame(data, SCORED).repartition(5)
    assert evaluation.roc_auc(df) == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


@pytest.fixture
def spread(spark):
    k = F.col("id")
    return spark.range(0, 30_000, 1, 6).select(
        (k * 7919 % 30_011).cast("double").alias("a"), F.when(k % 3 == 0, 1.0).otherwise(2.0).alias("b"), (1 / (k + 1)).alias("c"),
        F.when(k % 5 > 0, k.cast("double")).alias("d"), F.lit(None).cast("double").alias("e"),
    )


def counted_passes(monkeypatch):
    passes, plain = [], feat._bin_counts
    monkeypatch.setattr(feat, "_bin_counts", lambda df, search: passes.append(dict(search)) or plain(df, search))
    return passes


def test_medians_take_one_sketch_and_one_count(spread, monkeypatch):
    passes = counted_passes(monkeypatch)
    held = spread.toPandas()
    want = {c: None if held[c].isna().all() else held[c].median() for c in held}
    assert feat.exact_medians(spread, list("abcde")) == want
    assert len(passes) == 1 and set(passes[0]) == set("abcd")
    # the bracket holds a few thousandths of the rows
    low, high = passes[0]["a"][:2]
    assert held["a"].between(low, high).sum() < 60


@pytest.mark.parametrize("bracket", [(0.1, 0.2), (0.8, 0.9), (0.0, 1.0)])
def test_a_bracket_that_misses_the_middle(spread, monkeypatch, bracket):
    plain = feat._span

    def off(column):
        *ends, at = plain(column)
        return [*ends, F.percentile_approx(feat.known(column), list(bracket), 100).alias(f"at_{column}")]

    monkeypatch.setattr(feat, "_span", off)
    passes = counted_passes(monkeypatch)
    held = spread.toPandas()
    assert feat.exact_medians(spread, ["a", "c", "d"]) == {c: held[c].median() for c in "acd"}
    assert len(passes) > 1


def test_median_passes_unfold_few_rows(spread, monkeypatch):
    """Values outside the brackets are counted where they are; only those inside are binned."""
    binned, count = [], feat._bin_counts

    def seen(df, search):
        below, found = count(df, search)
        binned.append((dict(search), below, found))
        return below, found

    monkeypatch.setattr(feat, "_bin_counts", seen)
    same = spread.withColumn("same", F.lit(7.0))
    want = feat.exact_medians(spread, ["a"])["a"]
    assert feat.exact_medians(same, ["a", "same"]) == {"a": want, "same": 7.0}
    search, below, found = binned[-1]
    lo, hi = search["a"][:2]
    held = [r["a"] for r in same.select("a").collect() if r["a"] is not None]
    assert below["a"] == sum(v < lo for v in held)
    assert sum(b["n"] for b in found["a"]) == sum(lo <= v <= hi for v in held)
    assert found["same"] == [{"bin": 0, "n": same.count(), "lo": 7.0, "hi": 7.0}]
