"""Shards by k-d tree: split at weighted medians along the widest metadata dimension until leaves reach the target bytes.

A node that is to hold k shards is split where the bytes before the cut come nearest to floor(k / 2) of its k shares, in
the order of its widest dimension (width against the whole table's; ties to the dimension listed first). Ties of the
dimension are ordered by doc_id, text_crc32, size and row, so even one value with a third of all rows can be cut. As
a long document may straddle the cut, one row of about the surplus moves over; leaves then differ by little.

The order of a level is one range sort with running sums: sums inside a partition by a window, sums before it
from one number per partition and node. Only metadata is sorted, not texts; per level at most one row per node comes
to the driver.

Sizes are the UTF-8 bytes of the text plus 1; null text counts as empty. Dimensions are whole numbers, or texts, of
which the first 7 bytes count; null is -1. Rows that agree in all listed columns are interchangeable. The slot of
a row in its shard follows doc_id (null first), text_crc32 and size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import stage, table

SHARDS, LAW = 16, "bytes"
DIMENSIONS = ("lang", "source", "n_chars", "doc_id")
_ORDER = ("doc_id", "text_crc32", "size", "__row")


@dataclass(frozen=True)
class Node:
    first: int
    shards: int

    @property
    def halves(self) -> tuple[Node, Node]:
        left = self.shards // 2
        return Node(self.first, left), Node(self.first + left, self.shards - left)


def _facts(docs: DataFrame, dimensions, inside: str = "") -> list[Column]:
    """doc_id, size, text_crc32 and the dimensions d0, d1, ... of `docs`, whose columns may lie inside a struct."""

    def number(name: str) -> Column:
        held = F.col(inside + name)
        if isinstance(docs.schema[name].dataType, StringType):
            held = F.conv(F.rpad(F.hex(F.substring(F.encode(held, "UTF-8"), 1, 7)), 14, "0"), 16, 10)
        return F.coalesce(held.cast("long"), F.lit(-1))

    text = F.encode(F.coalesce(F.col(inside + "text"), F.lit("")), "UTF-8")
    size = (F.octet_length(text) + 1).cast("long")
    own = [F.col(inside + "doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32")]
    return own + [number(d).alias(f"d{k}") for k, d in enumerate(dimensions)]


def metadata(docs: DataFrame, dimensions=DIMENSIONS) -> DataFrame:
    """What `place` reads of `docs`, with a stored number of each row."""
    return stage(docs.select(*_facts(docs, dimensions), F.monotonically_increasing_id().alias("__row")), "metadata")


def _running(rows: DataFrame, group: str, order: tuple[str, ...], weight: Column) -> DataFrame:
    """`rows` with __before, the sum of `weight` over the rows of its group that come before it in `order`."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__part", F.spark_partition_id())
    ranged = stage(ranged.withColumn("__weight", weight.cast("long")), "ranged")
    earlier = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(group, "__part").agg(F.sum("__weight").alias("__held"))
    parts = parts.select(group, "__part", F.coalesce(F.sum("__held").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__part", group).orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("__inside", F.coalesce(F.sum("__weight").over(inside), F.lit(0)))
    joined = summed.join(parts, ["__part", group])
    return joined.withColumn("__before", F.col("__inside") + F.col("__offset")).drop("__part", "__weight", "__inside", "__offset")


def _by_node(values: dict[int, Column], otherwise: Column) -> Column:
    return reduce(lambda whole, one: whole.when(F.col("node") == one[0], one[1]), values.items(), F.when(F.lit(False), otherwise)).otherwise(otherwise)


def _widest(rows: DataFrame, dims: list[str]) -> tuple[dict[int, str], dict[int, int]]:
    """The widest dimension and the bytes of each node."""
    ends = [f(d).cast("double").alias(f"{n}_{d}") for d in dims for n, f in (("low", F.min), ("high", F.max))]
    found = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()
    whole = {d: max(r[f"high_{d}"] for r in found) - min(r[f"low_{d}"] for r in found) for d in dims} if found else {}
    width = lambda r, d: (r[f"high_{d}"] - r[f"low_{d}"]) / whole[d] if whole[d] else 0.0
    return {r["node"]: max(dims, key=lambda d: width(r, d)) for r in found}, {r["node"]: r["bytes"] for r in found}


def _split(rows: DataFrame, nodes: list[Node], dims: list[str]) -> DataFrame:
    """`rows` with each of `nodes` cut in two."""
    widest, held = _widest(rows, dims)
    cut = {n.first: n for n in nodes if n.shards > 1 and n.first in held}
    coordinate = _by_node({first: F.col(widest[first]) for first in cut}, F.lit(0))
    ordered = _running(rows.withColumn("__at", coordinate.cast("long")), "node", ("__at", *_ORDER), F.col("size"))
    # in whole numbers: twice the bytes up to the row's middle, against the left share of twice the node's bytes
    left = _by_node({f: (2 * F.col("__before") + F.col("size")) * n.shards <= 2 * held[f] * n.halves[0].shards for f, n in cut.items()}, F.lit(True))
    sided = stage(ordered.withColumn("__left", left).drop("__before", "__at"), "sided")
    bytes_left = {r["node"]: r["bytes"] for r in sided.where("__left").groupBy("node").agg(F.sum("size").alias("bytes")).collect()}
    surplus = {f: bytes_left.get(f, 0) * n.shards - held[f] * n.halves[0].shards for f, n in cut.items()}
    over = _by_node({f: F.lit(s).cast("long") for f, s in surplus.items()}, F.lit(0).cast("long"))
    shards = _by_node({f: F.lit(n.shards) for f, n in cut.items()}, F.lit(1))
    fits = (F.col("__left") == (over > 0)) & (F.col("size") * shards < 2 * F.abs(over))
    apart = F.abs(F.col("size") * shards - F.abs(over)).alias("apart")
    key = F.struct(apart, *[F.col(c) for c in _ORDER])
    moved = {r["node"]: r["row"] for r in sided.where(fits).groupBy("node").agg(F.min(key)["__row"].alias("row")).collect()}
    swap = _by_node({f: F.col("__row") == row for f, row in moved.items()}, F.lit(False))
    right = _by_node({f: F.lit(n.halves[1].first) for f, n in cut.items()}, F.col("node"))
    return sided.withColumn("node", F.when(F.col("__left") != swap, F.col("node")).otherwise(right)).drop("__left")


def place(rows: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """Rows of `metadata` with shard and slot. Without `shards`, as many as `target_bytes` asks for."""
    dims = [c for c in rows.columns if c[0] == "d" and c[1:].isdigit()]
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    nodes, placed = [Node(0, shards)], rows.withColumn("node", F.lit(0))
    while any(n.shards > 1 for n in nodes):
        placed = _split(placed, nodes, dims)
        nodes = [half for n in nodes for half in (n.halves if n.shards > 1 else (n,))]
    slots = _running(placed, "node", _ORDER, F.lit(1))
    return slots.withColumnRenamed("node", "shard").withColumnRenamed("__before", "slot")


def sharded(docs: DataFrame, dimensions=DIMENSIONS, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """`docs` with the columns __shard and __slot, which replace columns of these names."""
    held = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "documents")
    facts = stage(held.select(*_facts(docs, dimensions, "doc."), F.col("row").alias("__row")), "metadata")
    found = place(facts, shards, target_bytes).select(F.col("__row").alias("row"), "shard", "slot")
    kept = [F.col(f"doc.{c}") for c in docs.columns if c not in ("__shard", "__slot")]
    return held.join(found, "row").select(*kept, F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """One folder `__shard=k` per shard, its rows in the order of their slots inside each file."""
    sharded(docs, **how).repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot").write.partitionBy("__shard").parquet(path)


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = place(metadata(table(spark, sf_dir, "documents")))
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _level_sql(k: int) -> str:
    """Table `level{k + 1}` from `level{k}`, whose nodes hold `SHARDS >> k` shards each."""
    shards = SHARDS >> k
    at = " ".join(f"WHEN {d} THEN d{d}" for d in range(len(DIMENSIONS)))
    widths = ", ".join(f"coalesce((max(d{d})::DOUBLE - min(d{d})::DOUBLE) / nullif(any_value(w{d}), 0), 0)" for d in range(len(DIMENSIONS)))
    whole = ", ".join(f"(SELECT max(d{d})::DOUBLE - min(d{d})::DOUBLE FROM level0) AS w{d}" for d in range(len(DIMENSIONS)))
    return f"""
, stats{k} AS MATERIALIZED (
  SELECT node, held, list_position(widths, list_max(widths)) - 1 AS widest FROM (
    SELECT node, sum(size)::BIGINT AS held, [{widths}] AS widths FROM level{k}, (SELECT {whole}) GROUP BY node))
, sided{k} AS MATERIALIZED (
  SELECT *, (2 * running - size) * {shards} <= 2 * held * {shards // 2} AS is_left FROM (
    SELECT l.*, s.held, (sum(size) OVER (PARTITION BY l.node ORDER BY CASE s.widest {at} END, doc_id NULLS FIRST, text_crc32, size, row_key))::BIGINT AS running
    FROM level{k} l JOIN stats{k} s ON l.node = s.node))
, surplus{k} AS MATERIALIZED (
  SELECT node, (coalesce(sum(size) FILTER (is_left), 0) * {shards} - any_value(held) * {shards // 2})::BIGINT AS over FROM sided{k} GROUP BY node)
, swapped{k} AS MATERIALIZED (
  SELECT row_key FROM (
    SELECT row_key, row_number() OVER (PARTITION BY s.node ORDER BY abs(size * {shards} - abs(over)), doc_id NULLS FIRST, text_crc32, size, row_key) AS place
    FROM sided{k} s JOIN surplus{k} u ON s.node = u.node WHERE is_left = (over > 0) AND size * {shards} < 2 * abs(over)) WHERE place = 1)
, level{k + 1} AS MATERIALIZED (
  SELECT row_key, doc_id, size, text_crc32, {", ".join(f"d{d}" for d in range(len(DIMENSIONS)))},
    CASE WHEN is_left <> (row_key IN (SELECT row_key FROM swapped{k})) THEN node ELSE node + {shards // 2} END AS node FROM sided{k})"""


_PREFIX = "coalesce(('0x' || rpad(substr(hex(encode({0})), 1, 14), 14, '0'))::BIGINT, -1)"
# the CRC-32 of a text's bytes: the polynomial's table by rule, then one step per byte
ORACLE_SQL = {
    "op12_kd_shards": f"""
WITH RECURSIVE steps AS (
  SELECT i, i AS c, 0 AS done FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, done + 1 FROM steps WHERE done < 8)
, crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM steps WHERE done = 8)
, texts AS MATERIALIZED (SELECT *, row_number() OVER () AS row_key, coalesce(text, '') AS whole, hex(encode(coalesce(text, ''))) AS digits FROM documents)
, level0 AS MATERIALIZED (
  SELECT row_key, doc_id, strlen(whole) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(whole)), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
      lambda a, b: xor(a // 256, crcs[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32,
    {_PREFIX.format("lang")} AS d0, {_PREFIX.format("source")} AS d1, coalesce(n_chars, -1) AS d2, coalesce(doc_id, -1) AS d3, 0 AS node
  FROM texts, crc_table)
{"".join(_level_sql(k) for k in range(SHARDS.bit_length() - 1))}
SELECT doc_id, size, text_crc32, '{LAW}' AS law, node AS shard,
  row_number() OVER (PARTITION BY node ORDER BY doc_id NULLS FIRST, text_crc32, size, row_key) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM level{SHARDS.bit_length() - 1}"""
}
