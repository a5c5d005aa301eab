"""A model of delay days by group, and what training it observed.

The prediction is the mean delay of the group; its residuals' spread turns predicted days into a probability.
"""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from parcelyard.functions.scores import DEFAULT_RESIDUAL_SCALE
from parcelyard.models.scoring import predictions_from_days, write_note

DAYS = "predicted_days"


def train_days_model(rows: DataFrame, group: str, path: str, label: str = "delay_days") -> dict[str, float]:
    """Learn the mean of `label` per `group` from `rows`, store it and the training predictions under `path`, and return
    the metadata: rows used and spread of the residuals, observed while the predictions were written."""
    spark, path = rows.sparkSession, path.rstrip("/")
    known = rows.filter(F.col(label).isNotNull())
    known.groupBy(group).agg(F.avg(label).alias(DAYS)).write.mode("overwrite").parquet(f"{path}/means")
    predicted = with_days(spark, known.select("order_id", group, F.col(label).cast("double").alias("days")), group, path)
    residual, observed = F.col("days") - F.col(DAYS), Observation()
    watched = predicted.observe(observed, F.count(residual).alias("rows"), F.stddev_pop(residual).alias("residual_std"))
    watched.select("order_id", DAYS).write.mode("overwrite").parquet(f"{path}/training")
    metadata = {k: v for k, v in observed.get.items() if v is not None}
    write_note(spark, f"{path}/metadata", json.dumps(metadata))
    return metadata


def with_days(spark: SparkSession, rows: DataFrame, group: str, path: str) -> DataFrame:
    """`rows` with the predicted days of their group; NULL for a group that training did not see."""
    means = spark.read.parquet(f"{path.rstrip('/')}/means").withColumnRenamed(group, "_group")
    return rows.join(means, rows[group].eqNullSafe(means["_group"]), "left").drop("_group")


def read_metadata(spark: SparkSession, path: str) -> dict[str, float]:
    """What training noted; empty if there is no note."""
    try:
        lines = spark.read.text(f"{path.rstrip('/')}/metadata", wholetext=True).collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return json.loads(lines[0]["value"]) if lines else {}


def residual_scale(metadata: dict[str, float]) -> float:
    """The recorded spread, or the default where none was recorded or all residuals were 0."""
    return metadata.get("residual_std") or DEFAULT_RESIDUAL_SCALE


def score_days(spark: SparkSession, rows: DataFrame, group: str, path: str) -> DataFrame:
    """Predictions of a stored model, their probability by the spread that its training recorded."""
    return predictions_from_days(with_days(spark, rows, group, path), DAYS, residual_scale(read_metadata(spark, path)))
