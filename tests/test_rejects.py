"""Values of raw files that do not fit are kept, with column and reason."""

import pytest

from parcelyard import schemas
from parcelyard.plans import etl
from parcelyard.sources.files import csv_rejects, raw_csv
from tests.support import rows

HEADERS = {name: ",".join(schema.names) for name, schema in schemas.RAW_FILES.items()}


def write(folder, name, *lines, header=None):
    (folder / f"{name}.csv").write_text("\n".join([header or HEADERS[name], *lines]) + "\n")
    return str(folder / f"{name}.csv")


@pytest.fixture
def items(tmp_path):
    """Columns in another order, and one more; values that do not fit; lines cut off and too long."""
    return write(
        tmp_path, "order_items",
        "1.5,o1,1,note,p1,s1,2018-01-01,0.5", "n/a,o2,2.5,,p2,s2,,0.5", ",o3,,,p3,s3,,", "2.0,o4,1,x,p4,s4,,1e3,extra", "3.0,o5,1",
        header="price,order_id,order_item_id,remark,product_id,seller_id,shipping_limit_date,freight_value",
    )


def test_rejects_have_key_column_value_and_reason(spark, items):
    got = csv_rejects(spark, "order_items", items)
    assert got.columns == ["data_set", "record_key", "column_name", "value", "reason"]
    assert {tuple(r)[1:] for r in got.collect()} == {
        ("o2", "price", "n/a", "not_double"),
        ("o2", "order_item_id", "2.5", "not_int"),
        ("o4", None, "2.0,o4,1,x,p4,s4,,1e3,extra", "wrong_number_of_values"),
        ("o5", None, "3.0,o5,1", "wrong_number_of_values"),
    }


def test_the_layer_keeps_its_rows(spark, items):
    got = {r["order_id"]: (r["order_item_id"], r["price"], r["freight_value"]) for r in raw_csv(spark, "order_items", items).collect()}
    assert got == {"o1": (1, 1.5, 0.5), "o2": (None, None, 0.5), "o3": (None, None, None), "o4": (1, 2.0, 1000.0), "o5": (1, 3.0, None)}


def test_times_of_orders(spark, tmp_path):
    path = write(tmp_path, "orders", "a,c,delivered,oops,2018-01-01 10:00:00,,2018-02-30 00:00:00,2018-01-10")
    got = csv_rejects(spark, "orders", path)
    assert [tuple(r)[1:] for r in got.orderBy("column_name").collect()] == [
        ("a", "order_delivered_customer_date", "2018-02-30 00:00:00", "not_timestamp_ntz"),
        ("a", "order_purchase_timestamp", "oops", "not_timestamp_ntz"),
    ]


def test_a_missing_column_raises(spark, tmp_path):
    path = write(tmp_path, "sellers", "s1,01037,x", header="seller_id,seller_zip_code_prefix,city")
    with pytest.raises(ValueError, match="lacks.*seller_city"):
        csv_rejects(spark, "sellers", path)


def test_rejects_of_all_data_sets_are_written(spark, items, tmp_path):
    for name in schemas.RAW_FILES:
        if name != "order_items":
            write(tmp_path, name)
    write(tmp_path, "geolocation", "01037,-23.5,west,sao paulo,SP")
    out = str(tmp_path / "out")
    assert etl.build_rejects(spark, str(tmp_path), out) == 5
    found = spark.read.parquet(f"{out}/rejects")
    assert rows(found.groupBy("data_set").count()) == [("geolocation", 1), ("order_items", 4)]
    with pytest.raises(ValueError, match="5 values do not fit"):
        etl.build_rejects(spark, str(tmp_path), out, raise_on_reject=True)
    write(tmp_path, "geolocation", "01037,-23.5,-46.6,sao paulo,SP")
    write(tmp_path, "order_items", "o1,1,p1,s1,,1.0,2.0")
    assert etl.build_rejects(spark, str(tmp_path), out, raise_on_reject=True) == 0
