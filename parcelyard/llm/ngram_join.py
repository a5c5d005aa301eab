"""Similarity join on word shingles with an R-tree over count vectors.

A document is the set of its distinct `width`-word shingles (fewer words: the whole sequence as one). Two sets link
when 100 * intersection >= `percent` * union.

* Shingles are hashed into groups, more for larger sets; the counts per group are the document's point. Two sets share at most the
  summed minima of their coordinates, and a bounding box holds the largest coordinate of each group, so the same sum
  bounds all points of a subtree.
* Points are dealt to buckets by pigeonhole: sets that link share one of the first `n - ceil(percent * n / 100) + 1`
  shingles in any fixed order. Shingles that are common in a sample of documents come last in that order, which only
  saves work. Each bucket with two points or more gets its own R-tree; buckets with the same members are kept once.
* Surviving pairs are compared set by set, in two passes: each point with the best bounded partner before it, then,
  where a bucket still spans several components, every pair of points of different components within the bound.
  A pair that is skipped lies within one component, so no component is lost.

Documents with equal sets are one point. Empty or null texts have an empty set and link with nothing. Rows without a
doc_id are counted but link with nothing; rows that share a doc_id are one document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GOLD, map_batches, may_be_in, mixed, pa_schema, seeded, stage, steps, table, utf8, words_of
from .graph import components

#: Groups for sets of up to twice as many shingles; the coarser counts are sums of the finer ones.
GROUPS = (256, 1024, 4096, 16384)
#: One document in so many is looked at to tell which shingles are common, and this many shingles are noted at most.
SAMPLE_EVERY, COMMON = 16, 65_536
#: Points of a bucket that one task compares; larger buckets are compared in blocks.
BLOCK = 2048
LEAF = 32


def shingles(data: np.ndarray, offsets: np.ndarray, low: int, high: int, width: int) -> list[np.ndarray]:
    """For each row from `low` to `high`, its distinct shingles as sorted 64-bit hashes."""
    words, first = words_of(data, offsets, low, high)
    places = seeded(99, width) | np.uint64(1)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width if len(rolled) else 0):
            rolled += words[k : k + len(rolled)] * places[k]
        rolled = mixed(rolled)
        out = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                out.append(np.unique(rolled[a : b - width + 1]))
            elif b > a:
                few = (words[a:b] * places[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * GOLD
                out.append(mixed(np.array([few])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _rows(batch: pa.RecordBatch, width: int):
    data, offsets = utf8(batch.column("text"))
    for low, high in steps(offsets):
        yield low, high, shingles(data, offsets, low, high, width)


def _grade(n):
    return np.searchsorted(2 * np.array(GROUPS[:-1]), n, side="left")


def _packed(own: np.ndarray, groups: int) -> bytes:
    """The counts of a set's groups, in the narrowest unsigned type that holds them all."""
    counts = np.bincount((own >> np.uint64(40)).astype(np.int64) % groups, minlength=groups)
    most = int(counts.max())
    return counts.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def _unpacked(packed: list[bytes], own: list[int], groups: int) -> np.ndarray:
    """Points of `own` groups each as rows of `groups` counts."""
    return np.array([np.frombuffer(x, f"<u{len(x) // g}").reshape(-1, groups).sum(axis=0, dtype=np.int32) for x, g in zip(packed, own, strict=True)])


def _points(docs: DataFrame, common: np.ndarray, width: int, percent: int) -> DataFrame:
    """(doc_id, n, digest, firsts, rough and fine point). Of equal sets in a batch, the one with the smallest id lists its first shingles."""

    def step(batch):
        ids = batch.column("doc_id").to_pylist()
        n, firsts, rough, points, digests, lister = [], [], [], [], [], {}
        for _, _, sets in _rows(batch, width):
            for s in sets:
                late = np.zeros(len(s), bool)
                if len(s) and len(common):
                    late = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
                keep = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                firsts.append(np.concatenate([s[~late][:keep], s[late][: max(0, keep - int((~late).sum()))]]).view(np.int64))
                rough.append(_packed(s, GROUPS[0]))
                points.append(_packed(s, GROUPS[int(_grade(len(s)))]))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                me = ids[len(n)]
                if me is not None:
                    lister[digests[-1]] = min(me, lister.get(digests[-1], me))
                n.append(len(s))
        firsts = [f if lister.get(d) == i else None for f, d, i in zip(firsts, digests, ids, strict=True)]
        return {"doc_id": batch.column("doc_id"), "n": n, "digest": digests, "firsts": firsts, "rough": rough, "point": points}

    return map_batches(docs, step, "doc_id long, n long, digest binary, firsts array<long>, rough binary, point binary")


def _common_shingles(docs: DataFrame, width: int) -> np.ndarray:
    def step(batch):
        for _, _, sets in _rows(batch, width):
            yield {"shingle": np.concatenate([*sets, np.zeros(0, np.uint64)])}

    sample = docs.where(F.crc32(F.col("doc_id").cast("string")) % SAMPLE_EVERY == 0).select("doc_id", "text")
    counts = map_batches(sample, step, "shingle long").groupBy("shingle").count().where("count >= 3")
    found = counts.orderBy(F.desc("count"), "shingle").limit(COMMON).select("shingle").toPandas()["shingle"]
    return np.sort(found.to_numpy(np.int64).view(np.uint64))


def _shared(postings: DataFrame) -> DataFrame:
    """Postings of the shingles that two documents or more start with; a shingle's rows stream by in order."""
    schema = "shingle long, doc_id long"
    target = pa_schema(postings.sparkSession, schema)

    def run(batches):
        held = np.zeros((2, 0), np.int64)  # the last row seen, and whether it has gone out
        gone = False
        for batch in batches:
            rows = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            both = np.concatenate([held, rows], axis=1)
            same = both[0, 1:] == both[0, :-1]
            out = np.zeros(both.shape[1], bool)
            out[1:] |= same
            out[:-1] |= same
            last = bool(out[-1]) if len(out) else False
            if gone:
                out[0] = False
            if len(out) == 1 and gone:
                last = True
            yield pa.RecordBatch.from_arrays([pa.array(both[0, out]), pa.array(both[1, out])], schema=target)
            held, gone = both[:, -1:], last

    return postings.repartition("shingle").sortWithinPartitions("shingle", "doc_id").mapInArrow(run, schema)


def _buckets(shared: DataFrame) -> DataFrame:
    """(shingle, rows) of one shingle for each set of two members or more."""
    member = [F.count("*").alias("rows"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("doc_id", F.lit(7))).alias("x")]
    return shared.groupBy("shingle").agg(*member).where("rows > 1").groupBy("rows", "s", "x").agg(F.min("shingle").alias("shingle")).select("shingle", "rows")


def _dealt(shared: DataFrame, buckets: DataFrame) -> DataFrame:
    """Each bucket's members; a bucket over `BLOCK` is laid out as pairs of blocks, so that each task has two at most."""
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = shared.join(buckets, "shingle").withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", other)
    return rows.select("shingle", "doc_id", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))


class RTree:
    """Sort-tile-recursive packing of points (size, group counts); a box keeps sizes and the largest counts."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        slab = max(LEAF, int(np.ceil(np.sqrt(len(order) / LEAF))) * LEAF)
        for at in range(0, len(order), slab):
            part = order[at : at + slab]
            widest = int(points[part].var(axis=0).argmax())
            order[at : at + slab] = part[np.argsort(points[part, widest], kind="stable")]
        self.leaves = [order[at : at + LEAF] for at in range(0, len(order), LEAF)]
        boxes = [(points[x].max(axis=0), sizes[x].min(), sizes[x].max()) for x in self.leaves]
        self.levels = [boxes]
        while len(boxes) > LEAF:
            groups = [boxes[at : at + LEAF] for at in range(0, len(boxes), LEAF)]
            boxes = [(np.max([b[0] for b in g], axis=0), min(b[1] for b in g), max(b[2] for b in g)) for g in groups]
            self.levels.append(boxes)

    def near(self, top: np.ndarray, low: int, high: int, percent: int) -> list[np.ndarray]:
        """Leaves that may hold a partner for points with counts up to `top` and sizes from `low` to `high`."""
        at = range(len(self.levels[-1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            boxes, kept = self.levels[depth], []
            for k in at:
                most, smallest, largest = boxes[k]
                if 100 * largest < percent * low or 100 * high < percent * smallest:
                    continue
                if (100 + percent) * int(np.minimum(most, top).sum()) >= percent * int(low + smallest):
                    kept.append(k)
            at = kept if not depth else [c for k in kept for c in range(k * LEAF, min((k + 1) * LEAF, len(self.levels[depth - 1])))]
        return [self.leaves[k] for k in at]


def _candidates(points: np.ndarray, sizes: np.ndarray, ids: np.ndarray, percent: int, apart: np.ndarray, best: bool):
    """Index pairs (later, earlier by id) within the bound whose `apart` classes differ, and their scores; or each one's best."""
    tree = RTree(points, sizes) if len(ids) > LEAF else None
    everything = np.arange(len(ids))
    left, right, scores = [], [], []
    for group in tree.leaves if tree else [everything]:
        partners = [everything]
        if tree:
            partners = tree.near(points[group].max(axis=0), sizes[group].min(), sizes[group].max(), percent)
        top, chosen = np.full(len(group), -1, np.int64), np.full(len(group), -1, np.int64)
        for leaf in partners:
            shared = np.minimum(points[group][:, None, :], points[leaf][None, :, :]).sum(axis=2)
            fits = (100 + percent) * shared >= percent * (sizes[group][:, None] + sizes[leaf][None, :])
            fits &= (ids[leaf][None, :] < ids[group][:, None]) & (apart[leaf][None, :] != apart[group][:, None])
            score = np.where(fits, shared * 1_000_000 // (sizes[group][:, None] + sizes[leaf][None, :] - shared + 1), -1)
            if best:
                at = score.argmax(axis=1)
                value = score[np.arange(len(group)), at]
                better = value > top
                top[better], chosen[better] = value[better], leaf[at[better]]
            else:
                a, b = np.nonzero(fits)
                left.append(group[a])
                right.append(leaf[b])
                scores.append(score[a, b])
        if best:
            left.append(group[chosen >= 0])
            right.append(chosen[chosen >= 0])
            scores.append(top[chosen >= 0])
    return tuple(np.concatenate([*x, np.zeros(0, np.int64)]) for x in (left, right, scores))


def _pairs(dealt: DataFrame, percent: int, best: bool) -> DataFrame:
    """Candidate pairs (a, b) of each bucket or pair of blocks, with the bucket; or the best of them there for each `a`.

    `dealt` has a column `class`: pairs within one are left out. The best ones are told by the coarsest counts alone.
    """
    columns = ["shingle", "i", "j", "mine", "doc_id", "n", "class", "point"]
    schema = "a long, b long, score long, shingle long, i int, j int"
    target = pa_schema(dealt.sparkSession, schema)

    def solve(parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts)
        ids, sizes, kind, mine = (rows.column(c).to_numpy() for c in ("doc_id", "n", "class", "mine"))
        packed = rows.column("point").to_pylist()
        grades, found = np.zeros(len(ids), np.int64) if best else _grade(sizes), []
        for grade in np.unique(grades):  # partners are of the same grade or the next
            some = np.flatnonzero((grades == grade) | (grades == grade + 1))
            held = [GROUPS[k] for k in grades[some]]
            points = _unpacked([packed[k] for k in some], held, GROUPS[grade])
            a, b, score = _candidates(points, sizes[some], ids[some], percent, kind[some], best)
            a, b = some[a], some[b]
            new = (grades[a] == grade) | (grades[b] == grade)
            found.append((a[new], b[new], score[new]))
        a, b, score = (np.concatenate(x) for x in zip(*found, strict=True))
        if rows.column("i")[0] != rows.column("j")[0] and not best:  # two blocks: each is compared within itself elsewhere
            across = mine[a] != mine[b]
            a, b, score = a[across], b[across], score[across]
        key = [np.full(len(a), rows.column(c)[0].as_py()) for c in ("shingle", "i", "j")]
        return ids[a], ids[b], score, key[0], key[1].astype(np.int32), key[2].astype(np.int32)

    def run(batches):
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shingle", "i", "j")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            out: list = []
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if high == low:
                    continue
                now = tuple(keys[:, low])
                if now != key and held:
                    out.append(solve(held))
                    held = []
                key = now
                held.append(batch.slice(low, high - low))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], schema=target)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in solve(held)], schema=target)

    ordered = dealt.select(columns).repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "doc_id")
    return ordered.mapInArrow(run, schema)


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose sets link. Texts travel, not sets: they are half the size, and only those of some pair."""
    pairs = stage(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = docs.select("doc_id", "text").where(may_be_in(ids)("doc_id"))
    both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")

    def check(batch):
        keep = np.zeros(batch.num_rows, bool)
        sides = [utf8(batch.column(c)) for c in ("x", "y")]
        for low, high in steps(sides[0][1] + sides[1][1]):
            mine, other = (shingles(data, offsets, low, high, width) for data, offsets in sides)
            for k, x, y in zip(range(low, high), mine, other, strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[k] = 100 * common >= percent * (len(x) + len(y) - common) > 0
        kept = pa.array(keep)
        return {"a": batch.column("a").filter(kept), "b": batch.column("b").filter(kept)}

    return map_batches(both.select("a", "b", "x", "y"), check, "a long, b long")


def join_components(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of `docs` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    points = stage(_points(docs, _common_shingles(docs, width), width, percent), "points")
    known = points.where("n > 0 AND doc_id IS NOT NULL")
    classes = stage(known.groupBy("digest").agg(F.min("doc_id").alias("class")), "classes")
    shared = _shared(known.select(F.explode("firsts").alias("shingle"), "doc_id"))
    shared = stage(shared.join(classes.select(F.col("class").alias("doc_id")), "doc_id", "left_semi"), "shared").distinct()
    dealt = stage(_dealt(shared, _buckets(shared)), "dealt")

    rough = dealt.withColumn("class", F.col("doc_id")).join(known.select("doc_id", "n", F.col("rough").alias("point")), "doc_id")
    first = stage(_pairs(rough, percent, best=True), "first")
    best = first.groupBy("a").agg(F.max(F.struct("score", "b")).alias("top")).select("a", "top.b")
    links = stage(_verified(best, docs, width, percent), "links")
    found = components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("known"))
    # a bucket where no point has a partner within the bound has no pair
    keys = ["shingle", "i", "j"]
    marked = dealt.join(first.select(*keys).distinct(), keys, "left_semi").join(found, "doc_id", "left")
    marked = stage(marked.withColumn("class", F.coalesce("known", "doc_id")).drop("known"), "marked")
    split = marked.groupBy(*keys).agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least < most").select(*keys)
    fine = marked.join(split, keys, "left_semi").join(known.select("doc_id", "n", "point"), "doc_id")
    more = _verified(_pairs(fine, percent, best=False).select("a", "b").distinct(), docs, width, percent)
    linked = components(links.unionByName(more)).withColumnsRenamed({"node": "class", "component": "linked"})

    classes = classes.join(linked, "class", "left").select("digest", F.coalesce("linked", "class").alias("reached"))
    joined = points.join(classes, "digest", "left")
    own = F.when(F.col("n") > 0, F.col("reached")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(table(spark, sf_dir, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: For tables whose ids are distinct and not null.
ORACLE_SQL = {
    "op9_ngram_join": rf"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS words FROM documents)
, shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, place, place + 4), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS place FROM texts WHERE len(words) > 0))
, sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id)
, shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2)
, links AS MATERIALIZED (
  SELECT a, b FROM shared s JOIN sizes x ON s.a = x.doc_id JOIN sizes y ON s.b = y.doc_id WHERE 100 * s.n >= 75 * (x.n + y.n - s.n))
, reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
, least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT t.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, least(t.doc_id, coalesce(l.b, t.doc_id)) AS component_id
FROM texts t LEFT JOIN sizes z ON t.doc_id = z.doc_id LEFT JOIN least l ON t.doc_id = l.a"""
}
