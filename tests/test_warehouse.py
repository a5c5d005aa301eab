import pytest
from pyspark.sql import functions as F

from tests.support import rows
from parcelyard import schemas
from parcelyard.operators import star
from parcelyard.plans import etl
from parcelyard.sinks import warehouse
from parcelyard.sinks.files import write_clean_csv, write_layer
from parcelyard.sources.files import curated_table, event_files, raw_csv, warehouse_table

EVENTS = """{"event_id":"e1","order_id":"A","event_type":"SHIPPED","event_timestamp":"2018-01-01 10:00:00","produced_at":"2018-01-01T10:00:00Z"}
{"event_id":"e1","order_id":"A","event_type":"SHIPPED","event_timestamp":"2018-01-01 10:00:00","produced_at":"2018-01-01T10:00:00Z"}
{"event_id":"e2","order_id":"A","event_type":"DELIVERED","event_timestamp":"oops","produced_at":"2018-01-01T10:00:00Z"}
"""


def test_files_to_warehouse(spark, raw, tmp_path):
    for name, df in raw.items():
        write_clean_csv(df, str(tmp_path / "raw" / f"{name}.csv"))
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "batch_1.json").write_text(EVENTS)

    assert etl.build_processed(spark, str(tmp_path / "events"), str(tmp_path / "processed")) == 2
    processed = spark.read.parquet(str(tmp_path / "processed" / "delivery_events"))
    inputs = etl.raw_inputs(spark, str(tmp_path / "raw"))
    assert inputs["customers"].filter("customer_zip_code_prefix = '01037'").count() == 2

    curated = str(tmp_path / "curated")
    counts = etl.build_curated(spark, inputs, processed, curated)
    assert counts == {
        "dim_customer": 2, "dim_seller": 2, "dim_product": 3, "dim_location": 2, "dim_date": 2,
        "fact_delivery": 6, "fact_delivery_event": 2,
    }
    direct = star.fact_delivery(raw["orders"], raw["order_items"], star.dim_customer(raw["customers"]))
    assert rows(curated_table(spark, curated, "fact_delivery")) == rows(direct)

    warehouse.create_tables(spark, "etl_test", str(tmp_path / "db"))
    status = etl.load_warehouse(spark, curated, "etl_test")
    assert {r["table_name"]: r["rows"] for r in status.collect() if r["ok"]} == counts
    etl.load_warehouse(spark, curated, "etl_test")  # replaces, does not add
    assert rows(warehouse_table(spark, "etl_test", "fact_delivery")) == rows(direct)


def test_broken_event_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "batch_1.json").write_text(EVENTS + '{"event_id": "e3"\n')
    lines = event_files(spark, str(tmp_path / "*.json"))
    got = lines.select("event_id", "_corrupt_record").collect()
    assert [r["_corrupt_record"] for r in got if r["event_id"] is None] == ['{"event_id": "e3"']
    assert len(got) == 4


def test_create_tables_twice_keeps_rows(spark, raw, tmp_path):
    warehouse.create_tables(spark, "ddl_test", str(tmp_path / "db"))
    assert warehouse.replace_table(star.dim_seller(raw["sellers"]), "ddl_test", "dim_seller") == 2
    warehouse.create_tables(spark, "ddl_test")
    assert spark.table("ddl_test.dim_seller").count() == 2
    for name, schema in schemas.WAREHOUSE.items():
        found = spark.table(f"ddl_test.{name}").schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]


def test_one_failing_table_does_not_stop_the_rest(spark, raw, tmp_path):
    warehouse.create_tables(spark, "load_test", str(tmp_path / "db"))
    sellers = star.dim_seller(raw["sellers"])
    no_key = sellers.withColumn("seller_id", F.lit(None).cast("string"))
    tables = {
        "dim_location": lambda: curated_table(spark, str(tmp_path / "nowhere"), "dim_location"),
        "dim_product": lambda: sellers,
        "dim_seller": lambda: sellers,
    }
    got = {r["table_name"]: (r["rows"], r["ok"]) for r in warehouse.load_tables(spark, "load_test", tables).collect()}
    assert got == {"dim_location": (None, False), "dim_product": (None, False), "dim_seller": (2, True)}
    with pytest.raises(RuntimeError, match="dim_location"):
        warehouse.load_tables(spark, "load_test", tables, raise_on_error=True)
    with pytest.raises(ValueError, match="seller_id is NULL"):
        warehouse.replace_table(no_key, "load_test", "dim_seller")
    assert spark.table("load_test.dim_seller").count() == 2


def test_layer_files(spark, tmp_path):
    df = spark.range(1000).withColumn("month", F.col("id") % 3)
    path = str(tmp_path / "layer")
    assert write_layer(df, path) == 1000
    assert write_layer(df, path, files=4) == 1000
    assert len(list((tmp_path / "layer").glob("*.parquet"))) == 4
    assert write_layer(df, path, partition_by=("month",)) == 1000
    assert spark.read.parquet(path).filter("month = 1").count() == 333


def test_csv_round_trip(spark, raw, tmp_path):
    write_clean_csv(raw["geolocation"], str(tmp_path / "geo"))
    assert rows(raw_csv(spark, "geolocation", str(tmp_path / "geo"))) == rows(raw["geolocation"])


def test_a_failing_load_leaves_the_table_readable(spark, raw, tmp_path, monkeypatch):
    warehouse.create_tables(spark, "swap_test", str(tmp_path / "db"))
    sellers = star.dim_seller(raw["sellers"])
    assert warehouse.replace_table(sellers, "swap_test", "dim_seller") == 2
    before = rows(spark.table("swap_test.dim_seller"))
    stops = sellers.withColumn("seller_city", F.raise_error(F.lit("half way")).cast("string"))
    with pytest.raises(Exception, match="half way"):
        warehouse.replace_table(stops, "swap_test", "dim_seller")
    # files that do not hold what was written are not taken
    plain = warehouse._digest
    calls = []

    def other(schema):
        calls.append(1)
        return plain(schema) if len(calls) == 1 else [F.count(F.lit(1)).alias("rows"), F.lit(0).cast("decimal(38,0)").alias("digest")]

    monkeypatch.setattr(warehouse, "_digest", other)
    with pytest.raises(ValueError, match="does not hold the rows"):
        warehouse.replace_table(sellers.limit(1), "swap_test", "dim_seller")
    monkeypatch.undo()
    assert rows(spark.table("swap_test.dim_seller")) == before


def test_a_reader_keeps_the_rows_it_began_with(spark, raw, tmp_path):
    warehouse.create_tables(spark, "reader_test", str(tmp_path / "db"))
    sellers = star.dim_seller(raw["sellers"])
    warehouse.replace_table(sellers, "reader_test", "dim_seller")
    began = spark.table("reader_test.dim_seller")
    assert began.count() == 2
    assert warehouse.replace_table(sellers.limit(0), "reader_test", "dim_seller") == 0
    assert began.count() == 2 and spark.table("reader_test.dim_seller").count() == 0
    assert warehouse.replace_table(sellers.unionByName(sellers), "reader_test", "dim_seller") == 4


def test_appends_go_to_the_replaced_table(spark, tmp_path):
    warehouse.create_tables(spark, "append_test", str(tmp_path / "db"))
    scores = spark.createDataFrame([("a", 1.0, 0.9), ("b", 0.0, 0.1)], "order_id string, predicted_is_delayed double, delay_probability double")
    full = scores.withColumn("is_delayed", F.lit(None).cast("int"))
    assert warehouse.replace_table(full, "append_test", "fact_delivery_prediction") == 2
    assert warehouse.append_predictions(scores.limit(1), "append_test") == 1
    assert spark.table("append_test.fact_delivery_prediction").count() == 3


def test_the_digest_does_not_depend_on_order(spark):
    schema = schemas.WAREHOUSE["dim_seller"]
    data = [(str(k), None if k % 3 else "z", "c", "s") for k in range(50)]
    df = spark.createDataFrame(data, schema)
    want = df.agg(*warehouse._digest(schema)).first()
    assert df.repartition(5).agg(*warehouse._digest(schema)).first() == want
    assert spark.createDataFrame([*data[1:], ("0", None, "c", "s")], schema).agg(*warehouse._digest(schema)).first() != want
