"""Delivery measures."""

from pyspark.sql import Column, functions as F


def delivery_hours(purchased: Column, delivered: Column) -> Column:
    return (F.unix_timestamp(delivered) - F.unix_timestamp(purchased)) / F.lit(3600.0)


def delay_days(delivered: Column, estimated: Column) -> Column:
    """Calendar days late (negative when early); NULL until delivered."""
    return F.date_diff(delivered.cast("date"), estimated.cast("date"))


def is_delayed(days: Column) -> Column:
    """1 when late. An order that is not delivered yet counts as not late."""
    return F.when(days > 0, 1).otherwise(0)


def rate_percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 2)
