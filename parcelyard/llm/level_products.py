"""Source divergence audit: how far the sources of a language use its words differently.

A language keeps the terms that occur in at least `LEAST` of its documents. A group is a source within a language. The
smoothed share of a term depends on a group only through the term's count there (its level), so the distance of two
groups, summed over all kept terms, follows from their joint table: how many terms have level c here and level d
there. The terms' one-hot indicator columns, one for each (group, level), level 0 included, times their transpose hold
all joint tables at once. The product is made in blocks of terms and blocks of groups, in counts below 2**24 that
single precision holds exactly, and each block prices its tables in 64-bit integers: sums over blocks are the distances.

Counting adds up inside a task first, so a hot group or term leaves a task as one row. Blocks hold about `TERMS`
terms of like frequency (few levels each) and pairs of blocks of about `GROUPS` groups; a block is a task's
unit, however large one source is. The result holds every pair of a language's groups, so it grows with their square.

Null text, lang and source are ''. Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased.
Documents without terms still make their group. A language without kept terms has distances 0 and no term rows.
Repeated documents count each time. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back, pa_schema, stage, table, utf8

LEAST, TOP, UNIT, PRIOR = 30, 50, 1_000_000_000, 5
TERMS, GROUPS = 1024, 128
#: Indicator columns of one product, about; counted terms a task holds before it passes them on; bytes split at once.
COLUMNS, HELD, STEP = 1024, 300_000, 1 << 20

_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded piece at a time; pieces end between terms."""
    at, step = 0, STEP
    while at < len(text):
        piece = text[at : at + step].translate(_SPLIT)
        cut = piece.rfind(b" ") if at + step < len(text) else len(piece)
        if cut < 0:  # inside one long term
            step *= 2
            continue
        yield piece[:cut].split()
        at, step = at + cut + 1, STEP


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count and docs (documents that hold it). Every group has a row with the term '' as well."""
    schema = "lang string, source string, term string, count long, docs long"
    target = pa_schema(docs.sparkSession, schema)

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
        each = pa.array(np.repeat(np.arange(len(held)), [len(counts) for counts, _ in held.values()]))
        groups = [pa.array([key[i] for key in held]).take(each) for i in (0, 1)]
        terms = pa.array([t for counts, _ in held.values() for t in counts], pa.binary()).cast(pa.string())
        count = pa.array([n for counts, _ in held.values() for n in counts.values()], pa.int64())
        docs_with = pa.array([found[t] for counts, found in held.values() for t in counts], pa.int64())
        return pa.RecordBatch.from_arrays([*groups, terms, count, docs_with], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for k, group in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
                counts, found = held.setdefault(group, (Counter({b"": 0}), Counter()))
                size -= len(counts)
                seen = set()
                for words in _words(data[offsets[k] : offsets[k + 1]].tobytes()):
                    counts.update(words)
                    seen.update(words)
                found.update(seen)
                size += len(counts)
                if size > HELD:
                    yield rows(held)
                    held, size = {}, 0
                    give_back()
        if held:
            yield rows(held)
            give_back()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*text).mapInArrow(run, schema)
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _blocks(kept: DataFrame) -> DataFrame:
    """`kept` with its terms dealt to blocks of about `TERMS` terms of a language, of like frequency (by powers of 2)."""
    kept = kept.withColumn("rarity", F.floor(F.log2("total")).cast("int"))
    slices = kept.groupBy("lang", "rarity").agg(F.ceil(F.count("*") / TERMS).alias("slices"))
    return kept.join(slices, ["lang", "rarity"]).withColumn("slice", F.pmod(F.xxhash64("term"), "slices")).drop("slices")


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * terms)), exactly: UNIT is taken in three steps of 1000."""
    below = total + PRIOR * terms
    share, rest = np.zeros(len(counts), np.int64), counts + PRIOR
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, below)
        share = share * 1000 + digits
    return share + 1


def _distances(counts: np.ndarray, totals: np.ndarray, terms: int, absent: int, here: int, there: int) -> np.ndarray:
    """Share differences, summed over the block's terms (rows), between the `here` first groups (columns) and those from `there` on.

    `absent` terms of the block occur in none of the groups.
    """
    groups = counts.shape[1]
    none = np.array([_shares(np.zeros(1, np.int64), int(t), terms)[0] for t in totals]) if absent else np.zeros(groups, np.int64)
    out = absent * np.abs(none[:here, None] - none[None, there:])
    counts = counts[np.argsort(counts.sum(1), kind="stable")]
    most = np.maximum.accumulate(counts, axis=0)
    at = 0
    while at < len(counts):
        # the longest stretch whose groups have few enough levels; a stretch of one term always goes
        step = len(counts) - at
        while step > 1 and np.minimum(most[at + step - 1] + 1, step).sum() > COLUMNS:
            step //= 2
        part = counts[at : at + step]
        flat = part + np.arange(groups) * (int(part.max()) + 1)
        levels, column = np.unique(flat, return_inverse=True)
        group, level = np.divmod(levels, int(part.max()) + 1)
        marks = np.zeros((step, len(levels)), np.float32)
        marks[np.arange(step)[:, None], column.reshape(step, groups)] = 1
        edges = np.searchsorted(group, np.arange(groups))
        split = edges[there] if there < groups else len(levels)
        end = edges[here] if here < groups else len(levels)
        joint = (marks[:, :end].T @ marks[:, split:]).astype(np.int64)
        shares = np.concatenate([_shares(level[a:b], int(totals[g]), terms) for g, (a, b) in enumerate(zip(edges, [*edges[1:], len(levels)]))])
        priced = joint * np.abs(shares[:end, None] - shares[None, split:])
        out += np.add.reduceat(np.add.reduceat(priced, edges[:here], axis=0), edges[there:] - split, axis=1)
        at += step
    return out


def _priced(rows: pa.Table) -> pa.Table:
    """One block: distances of every pair of groups, over the terms that it holds.

    Rows with a total are groups (`side` tells which block of groups), the others counts of a term.
    """
    source, term = (rows.column(c).combine_chunks().dictionary_encode() for c in ("source", "term"))
    if isinstance(source, pa.ChunkedArray):
        source, term = source.combine_chunks(), term.combine_chunks()
    at_source = source.indices.to_numpy(zero_copy_only=False)
    total = rows.column("total")
    head = total.is_valid().to_numpy()
    side = rows.column("side").to_numpy()
    names, sides = np.array(source.dictionary.to_pylist(), object)[at_source[head]], side[head]
    order = np.argsort(sides, kind="stable")
    place = np.zeros(len(source.dictionary), np.int64)
    place[at_source[head][order]] = np.arange(len(order))
    counts = np.zeros((len(term.dictionary), len(order)), np.int64)
    at_term = term.indices.fill_null(0).to_numpy(zero_copy_only=False)
    counts[at_term[~head], place[at_source[~head]]] = rows.column("count").to_numpy()[~head]
    names, sides = names[order], sides[order]
    alone = sides[0] == sides[-1] and rows.column("low")[0] == rows.column("high")[0]
    here = len(names) if alone else int((sides == sides[0]).sum())
    there = 0 if alone else here
    terms, held = (int(rows.column(c).to_numpy()[head][0]) for c in ("terms", "held"))
    if not alone and sides[0] == sides[-1]:  # the other block of groups is empty
        return _pairs(rows, names[:0], names[:0], np.zeros((0, 0), np.int64), False)
    found = _distances(counts, total.to_numpy()[head][order].astype(np.int64), terms, held - len(counts), here, there)
    return _pairs(rows, names[:here], names[there:], found, alone)


def _pairs(rows: pa.Table, ours: np.ndarray, others: np.ndarray, found: np.ndarray, alone: bool) -> pa.Table:
    a, b = np.nonzero(~np.eye(len(ours), dtype=bool)) if alone else np.indices(found.shape).reshape(2, -1)
    here, there, value = ours[a], others[b], found[a, b]
    if not alone:
        here, there, value = np.concatenate([here, there]), np.concatenate([there, here]), np.tile(value, 2)
    lang = pa.array([rows.column("lang")[0].as_py()] * len(value), pa.string())
    return pa.table([lang, pa.array(here, pa.string()), pa.array(there, pa.string()), pa.array(value, pa.int64())], names=["lang", "source", "item", "value"])


def pair_distances(groups: DataFrame, counts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a language.

    `groups`: lang, source, total, terms; `counts`: lang, source, count and the term's rarity and slice; `kept`: the terms.
    """
    parts = F.ceil(F.count("*") / GROUPS).alias("parts")
    side = F.pmod(F.xxhash64("source"), "parts").alias("side")
    split = groups.groupBy("lang").agg(parts)
    # a language without terms has one block, of no terms
    blocks = kept.groupBy("lang", "rarity", "slice").agg(F.count("*").alias("held"))
    blocks = groups.select("lang").distinct().join(blocks, "lang", "left").na.fill({"rarity": -1, "slice": 0, "held": 0})
    heads = groups.join(split, "lang").join(blocks, "lang").withColumns({"term": F.lit(None).cast("string"), "count": F.lit(None).cast("long")})
    entries = counts.join(split, "lang").withColumns({c: F.lit(None).cast("long") for c in ("total", "terms", "held")})
    columns = ["lang", "rarity", "slice", "parts", side, "source", "term", "count", "total", "terms", "held"]
    heads, entries = heads.select(*columns), entries.select(*columns)
    rows = heads.unionByName(entries).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")}).drop("other", "parts")
    found = rows.groupBy("lang", "rarity", "slice", "low", "high").applyInArrow(_priced, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _share(count: str, total: str) -> Column:
    return F.expr(f"1 + (cast({count} + {PRIOR} AS decimal(20, 0)) * {UNIT}) div ({total} + {PRIOR} * terms)")


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources, and the terms a source overuses most."""
    counts = stage(term_counts(docs), "counts")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= least).select("lang", "term", "lang_count", F.col("lang_count").alias("total"))
    kept = stage(_blocks(kept).drop("total"), "kept")
    counts_kept = stage(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total"))
    totals = counts_kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stage(groups.na.fill(0, ["total", "terms", "lang_total"]), "groups")

    pairs = pair_distances(groups, counts_kept, kept).withColumn("part", F.lit("pair"))
    shares = counts_kept.join(groups, ["lang", "source"]).withColumns({"p": _share("count", "total"), "q": _share("lang_count", "lang_total")})
    over = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), F.lit("term").alias("part"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    over = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(over.select(*columns))


def op13_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE_SQL = {
    "op13_level_products": rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents)
, tokens AS MATERIALIZED (SELECT doc, lang, source, unnest(words) AS term FROM docs)
, kept AS MATERIALIZED (SELECT lang, term, count(*) AS lang_count FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= {LEAST})
, langs AS (SELECT lang, count(*) AS terms, sum(lang_count)::BIGINT AS lang_total FROM kept GROUP BY lang)
, groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs)
, found AS (SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY lang, source, term)
, counts AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, k.lang_count, coalesce(f.n, 0) AS n FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term)
, shares AS MATERIALIZED (
  SELECT c.lang, c.source, term, n, 1 + ({UNIT} * (n + {PRIOR})) // (sum(n) OVER (PARTITION BY c.lang, c.source) + {PRIOR} * terms)::BIGINT AS p,
    1 + ({UNIT} * (lang_count + {PRIOR})) // (lang_total + {PRIOR} * terms) AS q
  FROM counts c JOIN langs l ON c.lang = l.lang)
, distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source)
, every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM every)
WHERE part = 'pair' OR rank <= {TOP}"""
}
