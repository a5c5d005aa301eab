"""Removal of byte strings that occur more than once in a corpus, by suffix arrays.

A byte goes if it lies in a string of `length` bytes that starts at another place too, in the same or another document.

* Every window of `length` bytes has an anchor: the 64-byte string in it with the smallest hash, the last if several.
  Windows that follow each other with one anchor form a segment, so each window lies in exactly one segment, and equal
  windows have equal anchors. A segment that occurs twice is repeated as a whole; an anchor with one distinct segment
  needs no more work. Only the rest, one copy of each segment, is gathered into shards by anchor.
* A shard's suffixes are sorted by Larsson-Sadakane refinement (ranks double in depth; only groups that are not yet
  sorted are sorted again), Kasai's method gives the common prefixes of neighbours, and runs of neighbours with
  `length` bytes in common are equal windows.
* An anchor with more than `SHARD_SEGMENTS` segments is spread over several shards. Each then lists its distinct
  windows in order, and the lists are merged: every list looks its windows up in the others by binary search.

Passages of so many words are found the same way (`words` of `strip_repeats`): each word stands as `CODE` bytes of its
hash, so a string of `words` such codes is a run of as many words, whatever its length in bytes, its white space and the
case of A-Z. Whole words of such a run go.

Null text is empty. Rows are told apart by doc_id and text, so repeated ids, null ids and repeated rows are all judged.
Removal can leave bytes that are no valid UTF-8; `strip_repeats` drops such broken characters, the digests do not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GOLD, giving_back, map_batches, may_be_in, mixed, seeded, span_hashes, stage, steps, table, utf8, word_spans

LENGTH, GRAM, HOT = 400, 64, 1000
CODE = 4
SHARD_BYTES, SHARD_SEGMENTS, MERGED_ROWS, BLOCK_BYTES = 1 << 19, 1000, 500_000, 1 << 18
_BYTES = seeded(5, 256)
_LOW = np.uint64((1 << 24) - 1)


def _doubled(h: np.ndarray, span: int) -> np.ndarray:
    """Hashes of strings twice as long, from those of `span` bytes at every place."""
    if len(h) <= span:
        return h[:0]
    return mixed(h[:-span] * GOLD + h[span:])


def window_hashes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the `GRAM`-byte and the `length`-byte strings at every place where one fits."""
    with np.errstate(over="ignore"):
        h, span, whole, done, grams = _BYTES[data], 1, None, 0, None
        while span <= length:
            if span == GRAM:
                grams = h
            if length & span:
                fits = len(data) - done - span + 1
                part = h[done : done + max(0, fits)]
                whole = part.copy() if whole is None else mixed(whole[: len(part)] * GOLD + part)
                done += span
            h, span = _doubled(h, span), span * 2
    return grams, whole


def whole_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, offsets


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of the rows at `offsets` as `CODE` bytes each, and the rows' offsets in these."""
    low = int(offsets[0])
    starts, ends = word_spans(data, offsets)
    codes = (span_hashes(data, low, starts, ends) >> np.uint64(64 - 8 * CODE)).astype(np.uint32)
    return codes.view(np.uint8), CODE * np.searchsorted(starts, offsets - low)


def _minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours."""
    span = 1
    while span * 2 <= width:
        keys, span = np.minimum(keys[:-span], keys[span:]), span * 2
    return np.minimum(keys[: len(keys) - (width - span)], keys[width - span :])


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Segments of the rows at `offsets`: row, place in it, number of windows, anchor and fingerprint."""
    parts = []
    for low in range(int(offsets[0]), int(offsets[-1]) - length + 1, BLOCK_BYTES):
        text = data[low : min(low + BLOCK_BYTES + length - 1, int(offsets[-1]))]
        grams, whole = window_hashes(text, length)
        n = min(len(whole), BLOCK_BYTES)
        places = np.arange(len(grams), dtype=np.uint64)
        at = (_LOW - (_minima((grams & ~_LOW) | (_LOW - places), length - GRAM + 1)[:n] & _LOW)).astype(np.int64)
        first = int(np.searchsorted(offsets, low, side="right")) - 1
        ends = offsets[first + 1 : int(np.searchsorted(offsets, low + n, side="left")) + 1]
        row = np.searchsorted(ends, low + np.arange(n), side="right")
        fits = ends[row] - low - np.arange(n) >= length
        begins = fits.copy()
        begins[1:] &= ~fits[:-1] | (at[1:] != at[:-1])
        begin = np.flatnonzero(begins)
        if not len(begin):
            continue
        stops = fits.copy()
        stops[:-1] &= ~fits[1:] | begins[1:]
        last = np.flatnonzero(stops)
        with np.errstate(over="ignore"):
            print_ = mixed(whole[begin] * GOLD + mixed(whole[last]) + (last - begin).astype(np.uint64))
        parts.append((row[begin] + first, begin + low - offsets[row[begin] + first], last - begin + 1, grams[at[begin]], print_))
    if not parts:
        parts = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2]
    return dict(zip(("row", "start", "windows", "anchor", "print"), (np.concatenate(x) for x in zip(*parts, strict=True)), strict=True))


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of `text` in order, and the 8 bytes at every place as a number."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(8):
        keys |= padded[k : k + n] << np.uint64(56 - 8 * k)
    order = np.argsort(keys)
    fresh = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])
    starts = np.flatnonzero(fresh)
    rank = np.empty(n + 1, np.int64)
    rank[order] = starts[np.cumsum(fresh) - 1]
    rank[n] = -1
    sizes = np.diff(np.append(starts, n))
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    span = 8
    while len(slots):
        some = order[slots]
        own = rank[some]
        over = some + span - n  # of suffixes that end before, the shorter one comes first
        after = np.where(over < 0, rank[np.minimum(some + span, n)], -1 - over)
        again = np.argsort(own * (4 * n + 16) + after + 2 * n + 8)
        some, own, after = some[again], own[again], after[again]
        order[slots] = some
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(some)))
        rank[some] = slots[starts[np.cumsum(fresh) - 1]]
        slots = slots[np.repeat(sizes > 1, sizes)]
        span *= 2
    return order, keys


def common_prefixes(order: np.ndarray, keys: np.ndarray, most: int) -> np.ndarray:
    """Kasai: for each place of `order` but the first, the bytes it shares with the one before, up to `most`.

    Places of the text are visited in order, since a suffix shares at most one byte less than the suffix before it;
    many stretches of the text are walked side by side.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n + 1, np.int64)
    stretch = 256
    lanes = np.arange(0, n, stretch)
    h = np.zeros(len(lanes), np.int64)
    held = np.concatenate([keys, np.zeros(most + 8, np.uint64)])
    for step in range(min(stretch, n)):
        i = lanes + step
        live = i < n
        lanes, i, h = (lanes, i, h) if live.all() else (lanes[live], i[live], h[live])
        j = before[i]
        h = np.where(j >= 0, np.maximum(h - 1, 0), 0)
        going = np.flatnonzero((j >= 0) & (h < most))
        while len(going):
            apart = held[i[going] + h[going]] ^ held[j[going] + h[going]]
            same = apart == 0
            equal = np.full(len(going), 8)
            if not same.all():
                equal[~same] = sum((apart[~same] >> np.uint64(s) == 0).astype(np.int64) for s in (56, 48, 40, 32, 24, 16, 8))
            h[going] += equal
            going = going[same & (h[going] < most)]
        h = np.where(j >= 0, np.minimum(h, n - np.maximum(i, j)), 0)  # not beyond the end of the text
        shared[i] = h
    return np.minimum(shared[order], most)


def _shard_classes(bodies: list[bytes], windows: np.ndarray, length: int):
    """Windows of a shard in classes of equal strings: (class, body, place in the body) of each, in suffix order."""
    text = np.frombuffer(b"".join(bodies), np.uint8)
    order, keys = suffix_array(text)
    prefixes = common_prefixes(order, keys, length)
    prefixes[0] = 0
    starts = np.cumsum([0, *(len(b) for b in bodies)])[:-1]
    body = np.searchsorted(starts, order, side="right") - 1
    place = order - starts[body]
    kind = np.cumsum(prefixes < length)
    valid = place < windows[body]
    return kind[valid], body[valid], place[valid], text, order[valid]


_OPEN = "shard string, anchor long, spread boolean, copies long, doc_id long, mark long, start long, windows long, body binary"
_PARTS = ["shard", "anchor", "spread", "copies", "start", "windows"]
_FOUND = "doc_id long, mark long, low long, high long, part int, names array<long>, docs array<long>, marks array<long>, lows array<long>"


def _solve_shard(length: int, parts: int):
    """Spans of a shard; for spread anchors also its distinct windows: a sorted list for each of `parts` ranges of names.

    A window that the shard holds once comes with its place, the others with place -1, as they are known to repeat.
    """

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["anchor", "doc_id", "mark", "start"]).reset_index(drop=True)
        kind, body, place, text, at = _shard_classes(list(rows["body"]), rows["windows"].to_numpy(), length)
        _, kind, count = np.unique(kind, return_inverse=True, return_counts=True)
        alone = rows["copies"].to_numpy()[body] == 1
        hit = (count[kind] > 1) & alone
        out = [_spans(rows, body[hit], place[hit], length).astype("Int64")]
        if rows["spread"].any():
            wide = np.flatnonzero(rows["spread"].to_numpy()[body])
            wide = wide[np.unique(kind[wide], return_index=True)[1]]  # one of each class
            names = window_hashes(text, length)[1][at[wide]]
            order = np.argsort(names)
            wide, names = wide[order], names[order]
            single = (count[kind[wide]] == 1) & alone[wide]
            lows = np.where(single, rows["start"].to_numpy()[body[wide]] + place[wide], -1)
            docs, marks = (rows[c].to_numpy()[body[wide]] for c in ("doc_id", "mark"))
            ranges = [int(-(-(p << 64) // parts)) for p in range(1, parts)]
            cuts = np.concatenate([[0], np.searchsorted(names, np.array(ranges, np.uint64)), [len(names)]]).astype(int)
            columns = {"names": names.view(np.int64), "docs": docs, "marks": marks, "lows": lows}
            lists = [{"part": p} | {c: v[x:y].tolist() for c, v in columns.items()} for p, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
            out.append(pd.DataFrame(lists))
        found = pd.concat(out).reindex(columns=[c.split()[0] for c in _FOUND.split(", ")])
        for c in ("names", "docs", "marks", "lows"):
            found[c] = found[c].astype(object).where(found[c].notna(), None)
        return found.astype({c: "Int64" for c in ("doc_id", "mark", "low", "high", "part")})

    return solve


def _spans(rows: pd.DataFrame, body: np.ndarray, place: np.ndarray, length: int) -> pd.DataFrame:
    """Windows that follow each other in one body, as one span each."""
    order = np.lexsort((place, body))
    body, place = body[order], place[order]
    cut = np.flatnonzero((np.diff(body) != 0) | (np.diff(place) != 1)) if len(body) else np.zeros(0, np.int64)
    first = np.concatenate([[0], cut + 1])[: len(body)].astype(np.int64)
    last = np.concatenate([cut, [len(body) - 1]])[: len(first)].astype(np.int64)
    out = rows.iloc[body[first]][["doc_id", "mark"]].reset_index(drop=True)
    start = rows["start"].to_numpy()[body[first]]
    return out.assign(low=start + place[first], high=start + place[last] + length)


def _merge_lists(length: int):
    """Windows of one list that another list of the same range holds too, by binary search."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [np.array(x, np.int64).view(np.uint64) for x in rows["names"]]
        everywhere = np.sort(np.concatenate(lists))
        out = []
        for names, docs, marks, lows in zip(lists, rows["docs"], rows["marks"], rows["lows"], strict=True):
            held = np.searchsorted(everywhere, names, side="right") - np.searchsorted(everywhere, names, side="left")
            hit = np.flatnonzero((held > 1) & (np.array(lows) >= 0))
            own = pd.DataFrame({"doc_id": pd.Series(docs, dtype="Int64"), "mark": marks, "start": lows}).iloc[hit].reset_index(drop=True)
            key = own.groupby(["doc_id", "mark"], dropna=False).ngroup().to_numpy()
            own["key"] = key
            own = own.drop_duplicates(["key", "start"]).sort_values(["key", "start"]).reset_index(drop=True)
            fresh = np.concatenate([[True], (np.diff(own["key"]) != 0) | (np.diff(own["start"]) > length)])[: len(own)]
            run = np.cumsum(fresh)
            spans = own.groupby(run).agg(doc_id=("doc_id", "first"), mark=("mark", "first"), low=("start", "min"), high=("start", "max"))
            out.append(spans.assign(high=spans["high"] + length))
        return pd.concat(out)

    return merge


def _marked(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text, F.length(text)).alias("mark"), text.alias("text"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, read: Callable = whole_bytes) -> DataFrame:
    """(doc_id, mark, low, high): byte spans that repeat; they may overlap. `mark` is a hash of the text.

    `read` turns texts into the bytes that are compared and counted.
    """
    spark, docs = docs.sparkSession, _marked(docs)

    def cut(batch):
        data, offsets = utf8(batch.column("text"))
        for low, high in steps(offsets):
            found = segments(*read(data, offsets[low : high + 1]), length)
            rows = found.pop("row")
            held = batch.slice(low, high - low)
            yield found | {c: held.column(c).take(rows) for c in ("doc_id", "mark")}

    cuts = stage(map_batches(docs, cut, "anchor long, print long, doc_id long, mark long, start long, windows long"), "segments")
    place = F.struct("doc_id", "mark", "start", "windows")
    kinds = stage(cuts.groupBy("anchor", "print").agg(F.count("*").alias("copies"), F.min(place).alias("place")), "kinds")
    # a segment that makes up more than one in HOT of all is looked up where it is; there are fewer than HOT of these
    key, often = ["anchor", "print"], F.col("copies") * HOT > cuts.count()
    hot = F.broadcast(kinds.where(often & (F.col("copies") > 1)).select(*key))
    cold = kinds.where(~often & (F.col("copies") > 1)).select(*key)
    whole = cuts.join(hot, key, "left_semi").unionByName(cuts.join(hot, key, "left_anti").join(cold, key, "left_semi"))
    whole = whole.select("doc_id", "mark", F.col("start").alias("low"), (F.col("start") + F.col("windows") - 1 + length).alias("high"))

    many = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    rest = stage(kinds.join(many, "anchor").select("anchor", "print", "copies", "kinds", "place.*"), "open")
    total = rest.agg(F.sum(F.col("windows") + length - 1)).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1
    spread = F.col("kinds") > SHARD_SEGMENTS
    part = F.concat_ws("/", "anchor", F.pmod("print", F.ceil(F.col("kinds") / SHARD_SEGMENTS)))
    named = rest.withColumn("spread", spread).withColumn("shard", F.when(spread, part).otherwise(F.pmod("anchor", F.lit(shards)).cast("string")))

    own = named.groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("m")).agg(F.collect_list(F.struct(*_PARTS)).alias("parts"))
    own = stage(own, "parts")
    keys = [F.col("doc_id").eqNullSafe(F.col("d")), F.col("mark") == F.col("m")]
    texts = docs.where(may_be_in(own.select("m"))("mark"))
    inputs = texts.join(own, keys).select("doc_id", "mark", "text", "parts")

    def body(batch):
        data, offsets = read(*utf8(batch.column("text")))
        lists, values = batch.column("parts"), batch.column("parts").flatten()
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        parts = {c: values.field(c) for c in _PARTS}
        start, windows = parts["start"].to_numpy(), parts["windows"].to_numpy()
        for low in range(0, len(row), 4096):
            some = slice(low, low + 4096)
            ends = zip((offsets[row[some]] + start[some]).tolist(), windows[some].tolist(), strict=True)
            made = {c: v.slice(low, 4096) for c, v in parts.items()} | {c: batch.column(c).take(pa.array(row[some])) for c in ("doc_id", "mark")}
            yield made | {"body": [data[a : a + w + length - 1].tobytes() for a, w in ends]}

    parts = -(-(rest.where(spread).agg(F.sum("windows")).first()[0] or 0) // MERGED_ROWS) or 1
    found = stage(map_batches(inputs, body, _OPEN).groupBy("shard").applyInPandas(giving_back(_solve_shard(length, parts)), _FOUND), "found")
    merged = found.where("part IS NOT NULL").groupBy("part").applyInPandas(giving_back(_merge_lists(length)), "doc_id long, mark long, low long, high long")
    return whole.unionByName(found.where("part IS NULL").select("doc_id", "mark", "low", "high")).unionByName(merged)


def united(spans: list, size: int) -> np.ndarray:
    """Spans as disjoint rows (low, high) in order; touching spans become one."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    spans = np.array(spans, np.int64).reshape(-1, 2)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def _with_spans(docs: DataFrame, length: int, words: int = 0) -> DataFrame:
    """`docs` with the spans of each row in `__spans`, if `words` are given those of its word codes in `__passages`.

    Texts without any stay out of the shuffle.
    """
    mine = docs.withColumn("__mark", F.xxhash64(F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))))
    found = {"__spans": repeated_spans(docs, length)}
    if words:
        found["__passages"] = repeated_spans(docs, words * CODE, word_codes)
    every = reduce(DataFrame.unionByName, (s.withColumn("kind", F.lit(c)) for c, s in found.items()))
    spans = every.groupBy("doc_id", "mark").agg(*(F.collect_set(F.when(F.col("kind") == c, F.array("low", "high"))).alias(c) for c in found))
    spans = stage(spans.withColumnsRenamed({"doc_id": "__doc", "mark": "__m"}), "spans")
    passes = may_be_in(spans.select("__m"))("__mark")
    keys = [mine["doc_id"].cast("long").eqNullSafe(spans["__doc"]), mine["__mark"] == spans["__m"]]
    none = mine.where(~passes).withColumns({c: F.lit(None).cast("array<array<bigint>>") for c in found})
    some = mine.where(passes).join(spans, keys, "left").select(*mine.columns, *found)
    return none.unionByName(some).drop("__mark")


def _word_runs(data: np.ndarray, ends: np.ndarray, passages: list, words: int) -> list:
    """Spans of word codes as byte spans of the row between `ends`, from the first word's start to the last one's end."""
    starts, stops = word_spans(data, ends)
    runs = united(passages, CODE * len(starts))
    first, last = -(-runs[:, 0] // CODE), runs[:, 1] // CODE
    whole = last - first >= words
    return list(zip(starts[first[whole]].tolist(), stops[last[whole] - 1].tolist(), strict=True))


def _kept(batch, words: int = 0):
    data, offsets = utf8(batch.column("text"))
    lists = batch.column("__spans").to_pylist()
    passages = batch.column("__passages").to_pylist() if words else [None] * len(lists)
    for low, high, spans, runs in zip(offsets[:-1], offsets[1:], lists, passages, strict=True):
        if runs:
            spans = [*(spans or []), *_word_runs(data, np.array([low, high]), runs, words)]
        gone = united(spans or [], high - low)
        bounds = np.concatenate([[0], gone.ravel(), [high - low]]).reshape(-1, 2)
        yield data[low:high], gone, b"".join(data[low + a : low + b].tobytes() for a, b in bounds)


def strip_repeats(docs: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """`docs` without the repeated bytes of `text`; the other columns stay as they are.

    With `words`, runs of that many words go too if they occur again, however few bytes they have.
    """
    fields = docs.schema

    def step(batch):
        kept = [k.decode("utf-8", "ignore") for _, _, k in _kept(batch, words)]
        kept = [k if t.is_valid else None for k, t in zip(kept, batch.column("text"), strict=True)]
        return {f.name: kept if f.name == "text" else batch.column(f.name) for f in fields}

    return map_batches(_with_spans(docs, length, words), step, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the remaining bytes of each row."""

    def step(batch):
        rows = [(len(t), int((g[:, 1] - g[:, 0]).sum()), len(g), hashlib.sha256(k).hexdigest()) for t, g, k in _kept(batch)]
        made = zip(*rows, strict=True)
        return {"doc_id": batch.column("doc_id")} | dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), made, strict=True))

    docs = docs.select("doc_id", "text")
    return map_batches(_with_spans(docs, length), step, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


#: Windows as hexadecimal text, told apart by their MD5; slow beyond small tables.
ORACLE_SQL = {
    "op1_suffix_dedup": f"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS row_key, doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS digits FROM documents)
, windows AS MATERIALIZED (
  SELECT row_key, place, md5_number(substr(digits, 2 * place + 1, {2 * LENGTH})) AS body FROM (
    SELECT row_key, digits, unnest(range(n - {LENGTH - 1})) AS place FROM texts WHERE n >= {LENGTH}))
, again AS (SELECT body FROM windows GROUP BY body HAVING count(*) > 1)
, hits AS MATERIALIZED (SELECT row_key, place FROM windows JOIN again USING (body))
, marked AS (SELECT row_key, place, CASE WHEN place <= lag(place) OVER (PARTITION BY row_key ORDER BY place) + {LENGTH} THEN 0 ELSE 1 END AS fresh FROM hits)
, runs AS (SELECT row_key, place, sum(fresh) OVER (PARTITION BY row_key ORDER BY place) AS run FROM marked)
, spans AS MATERIALIZED (SELECT row_key, min(place) AS low, max(place) + {LENGTH} AS high FROM runs GROUP BY row_key, run)
, edges AS (
  SELECT row_key, low, high FROM spans UNION ALL SELECT row_key, n, n FROM texts)
, pieces AS (
  SELECT e.row_key, low, substr(digits, 2 * coalesce(lag(high) OVER (PARTITION BY e.row_key ORDER BY low, high), 0) + 1,
    2 * (low - coalesce(lag(high) OVER (PARTITION BY e.row_key ORDER BY low, high), 0))) AS piece, high
  FROM edges e JOIN texts t ON e.row_key = t.row_key)
, kept AS (SELECT row_key, sha256(unhex(string_agg(piece, '' ORDER BY low, high))) AS kept_sha256 FROM pieces GROUP BY row_key)
, gone AS (SELECT row_key, sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY row_key)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, kept_sha256
FROM texts JOIN kept USING (row_key) LEFT JOIN gone USING (row_key)"""
}
