"""Mixing of sources to target weights by capped water-filling and seeded repetition.

A source's size is the number of words of its documents. Sources share the total by weight; a source never gives more
than `EPOCHS` times its size, and what it can't give is shared again by weight until no target is above its limit.
A document is repeated as often as its source's target goes into its size: the whole part for every document, the
fraction by a seeded draw. Draws of a source are made in buckets of about `BUCKET` documents, from long to short, and
what one draw leaves over the next makes up for, so that a source's words come near its target.

Null text has size 0. Null sources are one source, last in order. Documents of size 0 follow the same repetition.
The result depends on the rows alone, not on their order or layout (equal rows get their draws in any order).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import GOLD, give_back, mixed, stage, steps, table, utf8, word_spans

WEIGHTS, EPOCHS, BUCKET, SEED = (5.0, 2.0, 1.0), 3.0, 2048, 20


@F.arrow_udf(LongType())
def word_count(text: pa.Array) -> pa.Array:
    data, offsets = utf8(text)
    counts = [np.diff(np.searchsorted(word_spans(data, p)[0], p - p[0])) for p in (offsets[a : b + 1] for a, b in steps(offsets))]
    give_back()
    return pa.array(np.concatenate([*counts, np.zeros(0, np.int64)]))


@F.pandas_udf(LongType())
def _repeat_number(doc_id: pd.Series, size: pd.Series) -> pd.Series:
    """How often a row came before in its batch, so that equal rows can go to different buckets."""
    return pd.DataFrame({"d": doc_id.fillna(-1), "s": size}).groupby(["d", "s"]).cumcount().astype("int64")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place in code-point order (null last), by a range sort; one number a partition is gathered."""
    order = sources.sort(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    order = stage(order.withColumn("at", F.monotonically_increasing_id()), "sources")
    counts = {r["part"]: r["count"] for r in order.groupBy("part").count().collect()}
    before, seen = {}, 0
    for part in sorted(counts):
        before[part], seen = seen, seen + counts[part]
    if not before:
        return order.withColumn("place", F.lit(0)).drop("part", "at")
    shift = F.create_map([F.lit(x) for item in before.items() for x in item])[F.col("part")]
    return order.withColumn("place", shift + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "at")


def targets(sizes: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS) -> DataFrame:
    """source, source_size, docs, target for rows (source, size)."""
    sources = _ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stage(sources.withColumn("weight", weight), "weights")
    limit, level = F.col("source_size") * F.lit(float(epochs)), None
    while True:
        clamped = F.lit(False) if level is None else F.col("weight") * F.lit(level) > limit
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(clamped, limit).otherwise(0.0)).alias("held"),
            F.sum(F.when(clamped, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        now = (row["total"] - row["held"]) / row["free"] if row["free"] else 0.0
        if level is not None and now <= level:
            break
        level = now
    return sources.select("source", "source_size", "docs", F.least(F.col("weight") * F.lit(level), limit).alias("target"))


def _draw(seed: int):
    def draw(rows: pa.Table) -> pa.Table:
        size, rate = rows.column("__size").to_numpy(), rows.column("__rate").to_numpy()
        ids = rows.column("__id").to_numpy().view(np.uint64)
        with np.errstate(over="ignore"):
            chance = (mixed(ids * GOLD + np.uint64(seed)) >> np.uint64(11)).astype(float) / (1 << 53)
        copies = np.floor(rate).astype(np.int64)
        part, owed = rate - copies, 0.0
        for k in np.lexsort((chance, -size)):
            owed += part[k] * size[k]
            if owed >= chance[k] * size[k] if size[k] else chance[k] < part[k]:
                copies[k] += 1
                owed -= size[k]
        give_back()
        return rows.append_column("__copies", pa.array(copies))

    return draw


def mix(docs: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """`docs` with __size, __source_size, __target and __copies (how often the mix holds the row)."""
    size = F.col("__size") if "__size" in docs.columns else word_count("text")
    docs = docs.withColumn("__size", size)
    found = stage(targets(docs.select("source", F.col("__size").alias("size")), weights, epochs), "targets")
    found = found.toDF("__source", "__source_size", "__docs", "__target")
    rows = docs.join(found, docs["source"].eqNullSafe(found["__source"]))
    key = F.xxhash64("doc_id", "__size", _repeat_number(F.col("doc_id").cast("long"), "__size"))
    rate = F.when(F.col("__source_size") > 0, F.least(F.col("__target") / F.col("__source_size"), F.lit(float(epochs)))).otherwise(0.0)
    rows = rows.withColumn("__id", key).withColumn("__rate", rate)
    rows = rows.withColumn("__bucket", F.pmod("__id", F.ceil(F.col("__docs") / BUCKET)))
    fields = [*rows.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", __copies long"
    return rows.groupBy("__source", "__bucket").applyInArrow(_draw(seed), schema).drop("__source", "__docs", "__id", "__rate", "__bucket")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of `docs`."""
    drawn = mix(docs).where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return drawn.select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stage(docs.select("doc_id", "source", word_count("text").alias("__size")), "sizes")
    taken = (F.col("__copies") * F.col("__size")).alias("taken")
    return mix(sized).select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), taken)
