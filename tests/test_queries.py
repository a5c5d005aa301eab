"""Every registered query against its SQL twin, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry_module
from tests.support import plan_of
from oracle import ORACLE_SQL as ORACLE
from parcelyard.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield con
    con.close()


def by_column_name(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("NULL" if row[i] is None else f"={row[i]}" for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert by_column_name(df.collect(), df.columns) == by_column_name(cursor.fetchall(), columns)


def test_every_twin_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(QUERIES) - set(ORACLE) == {"train_eval", "score_orders", "grid_scores"}


def test_entry(spark):
    got = entry_module.entry(spark)
    assert got.columns == ["customer_state", "total_deliveries", "delayed_deliveries", "delay_rate_percent",
                           "avg_delivery_hours"]
    assert 0 < got.count() <= 10


def test_grid_scores(spark):
    points = QUERIES["grid_scores"](spark, FOLDER).collect()
    assert len({(p["trees"], p["learning_rate"], p["depth"], p["weight_factor"]) for p in points}) == len(points) == 81
    assert sum(p["chosen"] for p in points) == 1
    assert all(0.0 <= p[f"auc_fold_{k}"] <= 1.0 for p in points for k in range(3))


def test_model_queries(spark):
    metrics = QUERIES["train_eval"](spark, FOLDER).first()
    assert all(0.0 <= metrics[c] <= 1.0 for c in metrics.asDict())
    scored = QUERIES["score_orders"](spark, FOLDER)
    assert scored.columns == ["order_id", "predicted_is_delayed", "delay_probability"]
    assert scored.count() == QUERIES["scoring_base"](spark, FOLDER).count()


PLANNED = [n for n in QUERIES if n not in ("train_eval", "score_orders", "grid_scores", "stream_ingest", "stream_rejects", "stream_ledger", "stream_dedup")]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_python_and_no_cross_join(spark, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "BatchEvalPython", "MapInPandas"):
        assert unwanted not in plan
    assert "Exchange SinglePartition" not in plan or name in SCALARS


# one-row results end in a single partition of partial aggregates
SCALARS = {"dim_date", "dashboard_kpis", "null_rates", "dedup_report", "key_uniqueness", "layer_row_counts",
           "class_ratio", "classification_metrics", "feature_moments"}
