"""Predicted delay days to class and probability."""

from pyspark.sql import Column, functions as F

# fixed value: spread of the residual days when none was recorded
DEFAULT_RESIDUAL_SCALE = 2.0


def delayed_class(days: Column) -> Column:
    return (days > 0).cast("int")


def clamped_probability(days: Column) -> Column:
    """Ten days late or more is certain, on time is impossible, linear between. NULL stays NULL."""
    share = days / F.lit(10.0)
    return F.when(share.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def logistic_probability(days: Column, scale: float = DEFAULT_RESIDUAL_SCALE) -> Column:
    return 1 / (1 + F.exp(-days / F.lit(float(scale))))
