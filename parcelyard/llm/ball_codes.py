"""Vector compression: one short code per part of a vector, from codebooks fitted by ball k-means.

Components become integers (floor of `SCALE` times the component) and vectors are cut into equal consecutive parts. A
part position has a codebook, which starts from the vectors with the smallest ids and is refined in a fixed number of
rounds: every part goes to its nearest entry, then every entry moves to the floored mean of its parts.

An entry and the parts that chose it last time form a ball. An entry farther from the ball's entry than twice a part's
own distance cannot be as near to that part, ties included. So the ball's radius tells which entries are its neighbours;
parts inside half the way to the nearest neighbour (the stable core) are done without a comparison; around the core lie
rings, each of which is compared with the few entries that reach it. All of it is exact integer arithmetic, so the
result is that of comparing with every entry.

Parts never leave their task: a round reads and writes the vectors with their codes, and only sums per entry (as many as
the codebooks hold) are shuffled and reach the driver.

Rows with a null vector, or null or non-finite components, are dropped. Shorter vectors count as padded with zeros
to the longest one, and that length is rounded up to whole parts. Integers are held to +-2**24 (components beyond
+-16,384), so that distances over up to 4,096 components fit 64 bits. Repeated ids count row by row; null ids come
last. With fewer vectors than entries the codebooks are smaller. A label's error beyond 64 bits is null. Columns
besides vec_id, embedding and label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_arrow, give_back, map_batches, pa_schema, stage, table
from .vectors import ragged

SCALE, LIMIT = 1024, 1 << 24
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Rings hold the parts whose number of candidates is at most this (and beyond the ring before).
RINGS = (4, 16, 64, 1 << 62)

INTEGERS = "vec_id long, label {label}, integers array<int>"
CODED = INTEGERS + ", codes array<int>, distances array<long>, part int, entry int, sums array<long>"


@dataclass
class Codebook:
    """Entries of one part position, with every entry's distances to the others in rising order."""

    entries: np.ndarray
    near: np.ndarray = field(init=False)
    gaps: np.ndarray = field(init=False)
    norms: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.norms = (self.entries**2).sum(1)
        apart = np.stack([((self.entries - e) ** 2).sum(1) for e in self.entries]) if len(self.entries) else np.zeros((0, 0), np.int64)
        np.fill_diagonal(apart, -1)
        self.near = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(apart, self.near, axis=1)

    def nearest(self, parts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part and its squared distance, from a guess `codes`; ties go to the lower entry."""
        best, chosen = ((parts - self.entries[codes]) ** 2).sum(1), codes.copy()
        order = np.argsort(codes, kind="stable")
        edges = np.flatnonzero(np.diff(codes[order], prepend=-1, append=len(self.entries)))
        for low, high in zip(edges[:-1], edges[1:]):
            ball, entry = order[low:high], codes[order[low]]
            # an entry can win where its gap is at most twice the part's distance: squared, four times
            reach = np.searchsorted(self.gaps[entry], 4 * best[ball], side="right")
            inner = 0
            for outer in RINGS:
                ring = ball[(reach > inner) & (reach <= outer)]
                if len(ring):
                    rivals = self.near[entry, : min(outer, reach.max())]
                    distance = self._distances(parts[ring], rivals)
                    least = distance.min(1)
                    first = np.where(distance == least[:, None], rivals, len(self.entries)).min(1)
                    won = (least < best[ring]) | ((least == best[ring]) & (first < entry))
                    chosen[ring[won]], best[ring[won]] = first[won], least[won]
                inner = outer
        return chosen, best

    def _distances(self, parts: np.ndarray, rivals: np.ndarray) -> np.ndarray:
        to = self.entries[rivals]
        size = 2 * max(int(np.abs(parts).max(initial=0)), int(np.abs(to).max(initial=0)))
        if size * size * parts.shape[1] < 1 << 52:  # exact in doubles
            products = (parts.astype(np.float64) @ to.T.astype(np.float64)).astype(np.int64)
        else:
            products = parts @ to.T
        return (parts**2).sum(1)[:, None] + self.norms[rivals] - 2 * products


def _integers(vectors: DataFrame) -> DataFrame:
    """Whole vectors as integers."""
    kind = vectors.schema["label"].dataType.simpleString()

    def step(batch: pa.RecordBatch) -> dict:
        flat, offsets, whole = ragged(batch.column("embedding"))
        with np.errstate(invalid="ignore"):
            scaled = np.floor(SCALE * flat.astype(np.float64))
        scaled = np.clip(np.where(np.isfinite(flat), scaled, 0), -LIMIT, LIMIT).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(scaled))
        return {n: c.filter(pa.array(whole)) for n, c in zip(("vec_id", "label", "integers"), (batch.column("vec_id"), batch.column("label"), lists))}

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return map_batches(rows, step, INTEGERS.format(label=kind))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    lengths = np.diff(offsets)
    out[np.arange(width) < lengths[:, None]] = flat[offsets[0] : offsets[-1]]
    return out


def _assigned(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """`rows` with the nearest entry of each part, and at each task's end one row of sums per entry used there.

    A row of sums has part, entry, the componentwise sums and last the number of parts; its other columns are null.
    """
    spark = rows.sparkSession
    schema = CODED.format(label=rows.schema["label"].dataType.simpleString())
    shipped, target = spark.sparkContext.broadcast(books), pa_schema(spark, schema)
    n, width = len(books), books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:
                held = [Codebook(b) for b in shipped.value]
                sums = np.zeros((n, len(shipped.value[0]), width + 1), np.int64)
            vectors = _matrix(batch.column("integers"), n * width)
            codes, distances = np.zeros((len(vectors), n), np.int64), np.zeros((len(vectors), n), np.int64)
            if "codes" in batch.schema.names:
                codes[:] = batch.column("codes").flatten().to_numpy().reshape(-1, n)
            for p, book in enumerate(held):
                parts = vectors[:, p * width : (p + 1) * width]
                codes[:, p], distances[:, p] = book.nearest(parts, codes[:, p])
                for at in range(width):
                    sums[p, :, at] += np.bincount(codes[:, p], parts[:, at], len(book.entries)).astype(np.int64)
                sums[p, :, width] += np.bincount(codes[:, p], minlength=len(book.entries))
            edges = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * n)
            made = {c: batch.column(c) for c in ("vec_id", "label", "integers")}
            made["codes"] = pa.ListArray.from_arrays(edges, pa.array(codes.ravel().astype(np.int32)))
            made["distances"] = pa.ListArray.from_arrays(edges, pa.array(distances.ravel()))
            yield _filled(made, target, len(vectors))
            give_back()
        if sums is not None:
            part, entry = np.nonzero(sums[:, :, width])
            edges = pa.array(np.arange(len(part) + 1, dtype=np.int32) * (width + 1))
            made = {"part": pa.array(part.astype(np.int32)), "entry": pa.array(entry.astype(np.int32))}
            made["sums"] = pa.ListArray.from_arrays(edges, pa.array(sums[part, entry].ravel()))
            yield _filled(made, target, len(part))

    return rows.mapInArrow(run, schema)


def _filled(columns: dict, target: pa.Schema, rows: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([as_arrow(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in target], schema=target)


def _moved(coded: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every entry at the floored mean of its parts; unused entries stay."""
    each = coded.where("part IS NOT NULL").select("part", "entry", F.posexplode("sums").alias("at", "value"))
    totals = each.groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    width, found = books[0].shape[1], {(r["part"], r["entry"], r["at"]): int(r["value"]) for r in totals}
    moved = [b.copy() for b in books]
    for (part, entry, at), value in found.items():
        if at < width:
            moved[part][entry, at] = value // found[part, entry, width]
    return moved


def fit_and_encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[np.ndarray], DataFrame]:
    """The codebooks (a matrix per part position) and rows (vec_id, label, codes, distances): one of each per part."""
    rows = stage(_integers(vectors), "integers")
    longest = rows.agg(F.max(F.size("integers"))).first()[0] or 0
    width = -(-longest // parts)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "integers").limit(entries).select("integers").collect()
    start = np.zeros((len(first), parts * width), np.int64)
    for k, row in enumerate(first):
        start[k, : len(row["integers"])] = row["integers"]
    books = [start[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    for _ in range(rounds):
        coded = stage(_assigned(rows, books), "codes")
        books = _moved(coded, books)
        rows = coded.where("part IS NULL").select("vec_id", "label", "integers", "codes")
    done = stage(_assigned(rows, books).where("part IS NULL").select("vec_id", "label", "codes", "distances"), "coded")
    return books, done


def codebook_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def hex_code(codes: str, entries: int = ENTRIES) -> Column:
    """The codes as hex digits, as many each as the largest index needs."""
    digits = len(f"{max(entries - 1, 0):x}")
    return F.concat_ws("", F.transform(F.col(codes), lambda c: F.lower(F.lpad(F.hex(c), digits, "0"))))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, coded = fit_and_encode(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, b: a + b)
    rows = coded.select("vec_id", "label", hex_code("codes").alias("code"), error.alias("error"))
    labels = rows.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = rows.join(labels, rows["label"].eqNullSafe(labels["of"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    """Assignment to the entries of `books{k}` and, from it, `books{k + 1}`."""
    return f"""
, near{k} AS MATERIALIZED (
  SELECT p.row_key, p.part, min(list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 256 + b.entry) AS best
  FROM parts p JOIN books{k} b ON p.part = b.part GROUP BY p.row_key, p.part)
, means{k} AS MATERIALIZED (
  SELECT part, entry, list(floor_mean ORDER BY place) AS v FROM (
    SELECT part, entry, place, (total - ((total % n) + n) % n) // n AS floor_mean FROM (
      SELECT p.part, near{k}.best % 256 AS entry, places.place, sum(p.v[places.place])::BIGINT AS total, count(*) AS n
      FROM parts p JOIN near{k} ON p.row_key = near{k}.row_key AND p.part = near{k}.part, (SELECT unnest(range(1, 17)) AS place) places
      GROUP BY p.part, near{k}.best % 256, places.place)) GROUP BY part, entry)
, books{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM books{k} b LEFT JOIN means{k} m ON b.part = m.part AND b.entry = m.entry)"""


#: For vectors of 64 components, the length in the test tables.
ORACLE_SQL = {
    "op11_vector_codes": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row_key, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
, parts AS MATERIALIZED (
  SELECT row_key, part, list_slice(v, part * 16 + 1, part * 16 + 16) AS v FROM kept, (SELECT unnest(range(4)) AS part))
, books0 AS MATERIALIZED (SELECT part, row_key - 1 AS entry, v FROM parts WHERE row_key <= 256)
{"".join(_round_sql(k) for k in range(ROUNDS))}
, last_near AS MATERIALIZED (
  SELECT p.row_key, p.part, min(list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 256 + b.entry) AS best
  FROM parts p JOIN books{ROUNDS} b ON p.part = b.part GROUP BY p.row_key, p.part)
, coded AS (
  SELECT row_key, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error FROM last_near GROUP BY row_key)
, digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row_key), digest"""
}
