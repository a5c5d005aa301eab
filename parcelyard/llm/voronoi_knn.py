"""Exact top-k inner products by a Voronoi join.

Vectors are integers, floor(`SCALE` * x). An added last component makes all data vectors equally long (queries get 0
there), so the largest inner products are the nearest points.

* Queries and data are grouped by the nearest of `PIVOTS` pivots, data vectors with the smallest hashes.
* From the distances to its pivot of each data cell's `k` + 1 nearest ids (a query's own id takes no part, however often it occurs), and from the largest distance in a query cell, the triangle
  inequality bounds the k-th distance of all queries of that cell from above.
* A data vector goes only to query cells where its own lower bound is within that distance. Query cells are put
  together to chunks of about `CHUNK` queries (a larger cell is cut), data to blocks of about `BLOCK`, so a task is a
  matrix of bounded size; the best k of each block are merged by a window over each query.

Vectors that are null or hold null or non-finite components, and rows without an id, take no part. Shorter vectors count
as ending in zeros. Repeated rows all count, but rows with the query's own id never do. Ties go to the smaller id.
Inner products must fit 64 bits; they are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import GOLD, map_batches, mixed, stage, table
from .vectors import matrix, ragged

SCALE, K, PIVOTS, CHUNK, BLOCK, EVERY = 64, 20, 64, 1024, 16_384, 20


def _whole_numbers(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, ints (64-bit components, without zeros at the end) and norm (their squared length)."""

    def step(batch):
        flat, offsets, whole = ragged(batch.column("embedding"))
        keep = np.flatnonzero(whole & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False))
        scaled = np.floor(scale * flat.astype(np.float64))
        with np.errstate(invalid="ignore"):
            numbers = scaled.astype("<i8")
        own = [np.trim_zeros(numbers[offsets[k] : offsets[k + 1]], "b") for k in keep]
        return {"vec_id": batch.column("vec_id").take(pa.array(keep)), "ints": [x.tobytes() for x in own], "norm": [float((x.astype(float) ** 2).sum()) for x in own]}

    return map_batches(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), step, "vec_id long, ints binary, norm double")


def _decoded(column) -> np.ndarray:
    return matrix([np.frombuffer(x, "<i8") for x in column], np.int64)


def _to_pivots(vectors: np.ndarray, last: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots, whose last column is the added component."""
    wide = np.zeros((len(vectors), max(vectors.shape[1], pivots.shape[1] - 1)))
    wide[:, : vectors.shape[1]] = vectors
    held = np.zeros((len(pivots), wide.shape[1]))
    held[:, : pivots.shape[1] - 1] = pivots[:, :-1]
    square = (wide**2).sum(1)[:, None] + (last**2)[:, None] + (pivots**2).sum(1)[None, :]
    return np.sqrt(np.maximum(square - 2 * (wide @ held.T + last[:, None] * pivots[:, -1][None, :]), 0))


def _placed(rows: DataFrame, pivots: np.ndarray, longest: float, query: bool) -> DataFrame:
    def step(batch):
        vectors = _decoded(batch.column("ints").to_pylist())
        last = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(longest - batch.column("norm").to_numpy(), 0))
        far = _to_pivots(vectors.astype(float), last, pivots)
        cell = far.argmin(axis=1)
        return {"vec_id": batch.column("vec_id"), "ints": batch.column("ints"), "cell": cell, "far": far[np.arange(len(cell)), cell]}

    return map_batches(rows, step, "vec_id long, ints binary, cell int, far double")


def _nearest_of_cells(placed: DataFrame, k: int) -> pd.DataFrame:
    """The `k` nearest ids of each cell and their distances, first within each task: `PIVOTS` * `k` rows come back."""

    def step(batch):
        rows = pd.DataFrame({c: batch.column(c).to_numpy() for c in ("cell", "vec_id", "far")})
        best = rows.sort_values("far").drop_duplicates(["cell", "vec_id"]).groupby("cell").head(k)
        return {c: best[c].to_numpy() for c in ("cell", "vec_id", "far")}

    few = map_batches(placed.select("cell", "vec_id", "far"), step, "cell int, vec_id long, far double")
    few = few.groupBy("cell", "vec_id").agg(F.min("far").alias("far"))
    order = Window.partitionBy("cell").orderBy("far", "vec_id")
    return few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("cell", "vec_id", "far").toPandas()


def _block_best(k: int):
    def solve(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_id": "int64", "vec_id": "int64", "score": "int64"}
        if not len(queries) or not len(data):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in columns.items()})
        q, x = _decoded(queries["ints"]), _decoded(data["ints"])
        width = max(q.shape[1], x.shape[1])
        q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
        largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, width)
        ids, asked, out = data["vec_id"].to_numpy(), queries["vec_id"].to_numpy(), []
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            score = (part.astype(float) @ x.T.astype(float)).astype(np.int64) if largest < 2**52 else part @ x.T
            own = asked[at : at + 256, None] == ids[None, :]
            score[own] = np.iinfo(np.int64).min
            least = np.partition(score, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)] if len(ids) > k else score.min(axis=1)
            row, column = np.nonzero((score >= least[:, None]) & ~own)
            value = score[row, column]
            order = np.lexsort((ids[column], -value, row))
            row, column, value = row[order], column[order], value[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            keep = place < k
            out.append((asked[at + row[keep]], ids[column[keep]], value[keep]))
        return pd.DataFrame(dict(zip(columns, (np.concatenate(c) for c in zip(*out, strict=True)), strict=True)))

    return solve


def top_inner_products(queries: DataFrame, data: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the `k` best rows of `data` for each row of `queries` (both vec_id, embedding)."""
    data, queries = stage(_whole_numbers(data, scale), "data"), stage(_whole_numbers(queries, scale), "queries")
    longest = data.agg(F.max("norm")).first()[0] or 0.0
    chosen = data.orderBy(F.xxhash64("ints"), "vec_id").limit(PIVOTS).toPandas()
    base = _decoded(list(chosen["ints"])).astype(float)
    pivots = np.hstack([base, np.sqrt(np.maximum(longest - chosen["norm"].to_numpy(float), 0))[:, None]])
    if not len(pivots):
        pivots = np.zeros((1, 1))
    data, queries = stage(_placed(data, pivots, longest, False), "cells"), stage(_placed(queries, pivots, longest, True), "cells")

    between = _to_pivots(pivots[:, :-1], pivots[:, -1], pivots)
    near = _nearest_of_cells(data, k + 1)
    groups = queries.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).toPandas().sort_values("cell")
    reach, chunk, chunks, filled = {}, {}, 0, CHUNK
    for cell, far, n in zip(groups["cell"], groups["far"], groups["n"], strict=True):
        upper = far + between[cell, near["cell"]] + near["far"].to_numpy()
        upper = np.sort(pd.Series(upper).groupby(near["vec_id"].to_numpy()).min().to_numpy())
        # rounding of the distances must not cost a neighbour
        reach[cell] = (far, upper[k] * (1 + 1e-6) + 1e-3 if len(upper) > k else np.inf)
        if filled + n > CHUNK:
            chunks, filled = chunks + 1, 0
        parts = max(1, -(-n // CHUNK))
        chunk[cell] = (chunks - 1, parts)
        chunks, filled = chunks + parts - 1, (filled + n if parts == 1 else CHUNK)

    cells = sorted(reach)
    blocks = max(1, -(-data.count() // BLOCK))
    numbers = sorted({c for first, parts in chunk.values() for c in range(first, first + parts)})

    def send(batch):
        cell, far = batch.column("cell").to_numpy(), batch.column("far").to_numpy()
        wanted = np.zeros((batch.num_rows, len(numbers)), bool)
        for c in cells:
            most, limit = reach[c]
            lower = np.abs(far - between[c, cell]) - most  # distance of the vector from the query cell's pivot, less its radius
            first, parts = chunk[c]
            at = np.searchsorted(numbers, np.arange(first, first + parts))
            wanted[:, at] |= (lower <= limit)[:, None]
        row, column = np.nonzero(wanted)
        ids = batch.column("vec_id").take(pa.array(row))
        with np.errstate(over="ignore"):  # rows that share an id or a residue are dealt out too
            block = (mixed(ids.to_numpy().astype(np.uint64) * GOLD + row.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
        return {"chunk": np.array(numbers, np.int64)[column] if len(numbers) else column, "block": block, "vec_id": ids, "ints": batch.column("ints").take(pa.array(row))}

    sent = map_batches(data, send, "chunk long, block long, vec_id long, ints binary")
    lookup = F.create_map([F.lit(int(x)) for c in cells for x in (c, chunk[c][0])]) if cells else F.create_map(F.lit(0), F.lit(0))
    parts = F.create_map([F.lit(int(x)) for c in cells for x in (c, chunk[c][1])]) if cells else F.create_map(F.lit(0), F.lit(1))
    asked = queries.withColumn("chunk", (lookup[F.col("cell")] + F.pmod(F.xxhash64("vec_id"), parts[F.col("cell")])).cast("long"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    asked = asked.select("chunk", "block", "vec_id", "ints")
    best = asked.groupBy("chunk", "block").cogroup(sent.groupBy("chunk", "block")).applyInPandas(_block_best(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_inner_products(rows.where(F.col("vec_id") % EVERY == 0), rows)


ORACLE_SQL = {
    "op5_voronoi_knn": f"""
    WITH whole AS (SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
               FROM whole q JOIN whole d ON q.vec_id <> d.vec_id WHERE q.vec_id % {EVERY} = 0),
    ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""
}
