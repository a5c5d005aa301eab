from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parcelyard.functions import delay, geo, scores, timestamps as ts


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, clock",
    [
        ("2018-11-04 00:30:00", datetime(2018, 11, 4, 0, 30)),  # does not exist in the session zone
        ("2018-11-04T00:30:00.5Z", datetime(2018, 11, 4, 0, 30, 0, 500000)),
        ("2018-11-04T03:30:00+03:00", datetime(2018, 11, 4, 0, 30)),
        ("2018-11-04", datetime(2018, 11, 4)),
        ("oops", None),
        ("", None),
    ],
)
def test_utc_clock(spark, text, clock):
    assert one(spark, ts.utc_clock(F.col("t")), t=text) == clock


def test_null_text_is_null(spark):
    assert one(spark, ts.utc_clock(F.lit(None).cast("string"))) is None


def test_wall_clock_ignores_the_session_zone(spark):
    assert one(spark, ts.wall_clock(F.col("t")), t="2018-11-04 00:30:00") == datetime(2018, 11, 4, 0, 30)


@pytest.mark.parametrize(
    "clock, micros, event",
    [
        ("2018-11-04 00:00:00", "2018-11-04 00:00:00.000000", "2018-11-04 00:00:00"),
        ("2018-11-04 00:00:00.12", "2018-11-04 00:00:00.120000", "2018-11-04 00:00:00.120000"),
    ],
)
def test_time_texts(spark, clock, micros, event):
    value = F.col("t").cast("timestamp_ntz")
    assert one(spark, ts.micros_text(value), t=clock) == micros
    assert one(spark, ts.event_time_text(value), t=clock) == event
    assert one(spark, ts.iso_utc_text(value), t=clock) == micros.replace(" ", "T") + "Z"


def test_date_key(spark):
    assert one(spark, ts.date_key(F.lit("2018-11-04 00:00:00").cast("timestamp_ntz"))) == "20181104"
    assert one(spark, ts.date_key(F.lit(date(2018, 1, 9)))) == "20180109"


def test_haversine(spark):
    def km(*places):
        return one(spark, geo.haversine_km(*[F.lit(p).cast("double") for p in places]))

    assert km(-23.55, -46.63, -22.91, -43.17) == pytest.approx(360.6238809880915, abs=1e-9)
    assert km(1.0, 2.0, 1.0, 2.0) == 0.0
    assert km(0.0, 0.0, 0.0, 180.0) == pytest.approx(6371.0 * 3.141592653589793)
    assert km(None, 2.0, 1.0, 2.0) is None


@pytest.mark.parametrize(
    "days, late, clamped, logistic",
    [
        (-3.0, 0, 0.0, 0.18242552380635635),
        (0.0, 0, 0.0, 0.5),
        (2.0, 1, 0.2, 0.7310585786300049),
        (25.0, 1, 1.0, 0.9999962733607158),
        (None, None, None, None),
    ],
)
def test_delay_days_to_probability(spark, days, late, clamped, logistic):
    d = F.lit(days).cast("double")
    assert one(spark, scores.delayed_class(d)) == late
    assert one(spark, scores.clamped_probability(d)) == clamped
    assert one(spark, scores.logistic_probability(d, 2.0)) == (
        None if logistic is None else pytest.approx(logistic, abs=1e-15)
    )


def test_rate_of_nothing_is_null(spark):
    assert one(spark, delay.rate_percent(F.lit(0), F.lit(0))) is None
    assert one(spark, delay.rate_percent(F.lit(1), F.lit(3))) == 33.33
