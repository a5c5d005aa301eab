import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """A session in a zone with daylight saving gaps, so that nothing can lean on UTC."""
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master(f"local[{os.cpu_count()}]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/Sao_Paulo")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def sample():
    """Small raw inputs with one of each edge case."""
    day = "2018-01-10 00:00:00"
    orders = [
        ("A", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "2018-01-03 00:00:00", "2018-01-11 09:00:00", day),
        ("B", "c1", "delivered", "2018-01-01 23:59:59", None, None, "2018-01-10 23:59:59", day),
        ("C", "c2", "shipped", "2018-01-02 00:00:00", "2018-01-02 01:00:00", None, None, day),
        ("D", "c2", "delivered", "2018-01-02 00:00:00", None, None, "2018-01-03 12:30:00", day),
        ("E", "nobody", "delivered", "2018-01-02 00:00:00", None, None, "2018-01-03 12:30:00", day),
        ("F", "c2", "delivered", "2018-01-02 00:00:00", None, None, "oops", day),
    ]
    items = [
        ("A", 2, "p2", "s2", None, 10.00, 1.00),
        ("A", 1, "p1", "s1", None, 20.10, 2.20),
        ("B", 1, "p2", "s2", None, 5.00, 0.50),
        ("C", 1, "p1", "s1", None, 7.00, 0.70),
        ("D", 1, "p1", "s2", None, 9.00, 0.90),
        ("F", 1, "p3", "s1", None, 1.00, 0.10),
    ]
    customers = [
        ("c1", "u1", "01037", "sao paulo", "SP"),
        ("c1", "u1", "01037", "sao paulo", "SP"),
        ("c2", "u2", "20040", "rio", "RJ"),
    ]
    products = [
        ("p1", "toys", 10.0, 100.0, 1.0, 500.0, 10.0, 20.0, 30.0),
        ("p2", None, 10.0, 100.0, 1.0, None, 10.0, 20.0, None),
        ("p3", "books", 10.0, 100.0, 1.0, 300.0, 1.0, 2.0, 3.0),
    ]
    sellers = [("s1", "01037", "sao paulo", "SP"), ("s2", "20040", "rio", "RJ")]
    geolocation = [
        ("01037", -23.5, -46.6, "sao paulo", "SP"),
        ("01037", -23.7, -46.8, None, "SP"),
        ("20040", -22.91, -43.17, "rio", "RJ"),
    ]
    return {
        "orders": orders,
        "order_items": items,
        "customers": customers,
        "products": products,
        "sellers": sellers,
        "geolocation": geolocation,
    }


@pytest.fixture(scope="session")
def raw(spark, sample):
    from parcelyard import schemas

    return {name: spark.createDataFrame(data, schemas.RAW_FILES[name]) for name, data in sample.items()}
