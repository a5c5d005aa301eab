"""A Brown class-based bigram model, learnt from part of a corpus and used to score all of it.

Tokens are the lower-cased words of a text and one end. Classes are found by exchange: a word moves to the class that
raises the likelihood of the class bigrams most.

* The `CLUSTERED` most frequent training words are exchanged in turn, on the driver, until a sweep moves none (`SWEEPS` at most;
  `Model.unsettled` says how many the last one moved). The number of classes
  grows with the square root of the vocabulary, from `CLASSES` to `MOST_CLASSES`.
* Then all words are exchanged at once, in executors: how often each word stands beside each class of the clustered ones is
  counted over the corpus, and each word moves by its gain against the class bigrams so far (`HEAD` can limit this to the most
  frequent words; it does not by default).
* Words that no class suits are one class, with those that training has not seen, and the end is one.

A text's probability is the product of class transitions, P(class | class before), and word emissions, P(word | class),
from the end before its first word. Transitions are smoothed by adding `ALPHA`. A word's emission is its share of its
class; in the class of the others `ALPHA` is added to each word's count and to one more word, which stands for all words
that training has not seen.

Counts and classes of all words are a stored table. Those of at most `NEAR` frequent words go to every task, the others are
joined: a text is first a byte a token, its class or a mark, and the marks are filled in after the join. What comes to the
driver is bounded by `CLUSTERED` squared, by `NEAR` and by the number of different counts. Words are told apart by 64-bit
hashes. Null text is empty and has the end alone. Rows without an id are training rows; repeated rows all count.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, stage, steps, table, utf8, words_of

CLUSTERED, CLASSES, MOST_CLASSES, HEAD, NEAR, ALPHA, SWEEPS = 1024, 48, 96, None, 1 << 18, 0.5, 20
_FAR = 255  # in place of a class, for a word whose class is yet to be joined
_BESIDE = np.dtype([("slot", "<u2"), ("n", "<u4")])


def _held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1


def _places(sorted_words: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The index of each word, or -1."""
    if not len(sorted_words):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(sorted_words, words), len(sorted_words) - 1)
    return np.where(sorted_words[at] == words, at, -1)


def _word_counts(docs: DataFrame) -> DataFrame:
    def step(batch):
        data, offsets = utf8(batch.column("text"))
        for low, high in steps(offsets, 8 << 20):
            words, counts = np.unique(words_of(data, offsets, low, high)[0], return_counts=True)
            yield {"word": words, "n": counts}

    return map_batches(docs.select("text"), step, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _with_ends(ids: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some rows with an end after each, and the places of the ends."""
    ends = first[1:] + np.arange(len(first) - 1)
    out = np.empty(len(ids) + len(ends), np.int64)
    hole = np.zeros(len(out), bool)
    hole[ends] = True
    out[hole], out[~hole] = end, ids
    return out, ends


def _bigrams(docs: DataFrame, clustered: np.ndarray) -> DataFrame:
    """Counts of neighbours as ids: the clustered words, then one id for all others, then the end."""
    other, end = len(clustered), len(clustered) + 1

    def step(batch):
        data, offsets = utf8(batch.column("text"))
        for low, high in steps(offsets, 8 << 20):
            words, first = words_of(data, offsets, low, high)
            ids = _places(clustered, words)
            ids, _ = _with_ends(np.where(ids < 0, other, ids), first, end)
            before = np.concatenate([[end], ids[:-1]])
            pairs, counts = np.unique(before * (end + 1) + ids, return_counts=True)
            yield {"pair": pairs, "n": counts}

    return map_batches(docs.select("text"), step, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _log_sum(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _binaries(held: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Stretches of `held` from offset to offset, one a row."""
    ends = offsets * held.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(held.tobytes())])


def _beside(docs: DataFrame, clustered: np.ndarray, kind: np.ndarray, classes: int) -> DataFrame:
    """word, and beside: packed slots and counts: how often classes stand after it, before it, and it beside itself.

    Slots: the `classes` classes after the word, then before it, then the word itself. Words that are not `clustered` have
    the class of the others.
    """
    other, end = classes - 2, classes - 1
    wide = 2 * classes + 1

    def step(batch):
        data, offsets = utf8(batch.column("text"))
        for low, high in steps(offsets, 8 << 20):
            words, first = words_of(data, offsets, low, high)
            if not len(words):
                continue
            found, ids = np.unique(words, return_inverse=True)
            place = _places(clustered, found)
            own = np.append(np.where(place >= 0, kind[place], other), end)
            ids, _ = _with_ends(ids, first, len(found))
            of, known = own[ids], np.flatnonzero(ids < len(found))
            before, after = np.where(known > 0, known - 1, 0), known + 1  # a text's last token is an end
            left = np.where(known > 0, of[before], end)
            twin_after, twin_before = ids[after] == ids[known], (known > 0) & (ids[before] == ids[known])
            slots = [np.where(twin_after, 2 * classes, of[after]), classes + left]
            keys = np.concatenate([ids[known] * wide + slots[0], (ids[known] * wide + slots[1])[~twin_before]])
            pairs, counts = np.unique(keys, return_counts=True)
            packed = np.empty(len(pairs), _BESIDE)
            packed["slot"], packed["n"] = pairs % wide, counts
            yield {"word": found, "beside": _binaries(packed, np.searchsorted(pairs // wide, np.arange(len(found) + 1)))}

    return map_batches(docs.select("text"), step, "word long, beside binary").groupBy("word").agg(F.collect_list("beside").alias("beside"))


def _gains(beside: np.ndarray, old: np.ndarray, pairs: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """What each class wins, by word, from the `beside` counts of other classes than the word's own.

    `pairs[s]` counts class s beside each class, `apart` the word's own class beside each, without the word.
    """
    out = np.zeros(beside.shape)
    some = beside.copy()
    some[np.arange(len(old)), old] = 0
    row, slot = np.nonzero(some)
    if not len(row):
        return out
    n = some[row, slot]
    won = _log_sum(pairs[slot] + n[:, None]) - _log_sum(pairs)[slot]
    without = apart[row, slot]
    won[np.arange(len(row)), old[row]] = _log_sum(without + n) - _log_sum(without)
    first = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
    out[row[first]] = np.add.reduceat(won, first)
    return out


def best_classes(after: np.ndarray, before: np.ndarray, own: np.ndarray, old: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class (all but the last, which is the end's) that each word gains most by, one row a word; ties stay or go low.

    `after` and `before` count classes beside a word, without itself, `own` it beside itself; `pairs` has them all.
    Only classes beside a word change its gains, so a word costs as many steps as it has different neighbours.
    """
    row = np.arange(len(old))
    # the old class beside each class, as first and as second, without the word
    firsts, seconds = pairs[old] - after, pairs.T[old] - before
    firsts[row, old] -= before[row, old] + own
    seconds[row, old] -= after[row, old] + own
    corner = np.diagonal(pairs)[None].repeat(len(old), 0)
    corner[row, old] = firsts[row, old]
    gain = _gains(after, old, pairs.T, firsts) + _gains(before, old, pairs, seconds)
    gain += _log_sum(seconds + after[row, old][:, None]) - _log_sum(seconds)
    gain += _log_sum(firsts + before[row, old][:, None]) - _log_sum(firsts)
    at = np.nonzero((own[:, None] > 0) | ((after > 0) & (before > 0)))
    held, a, b = corner[at], after[at], before[at]
    gain[at] += _log_sum(held + a + b + own[at[0]]) - _log_sum(held + a) - _log_sum(held + b) + _log_sum(held)
    # wherever the word goes, its neighbours count as neighbours
    for mass, n in ((pairs.sum(1), after.sum(1) + own), (pairs.sum(0), before.sum(1) + own)):
        mass = mass[None].repeat(len(old), 0)
        mass[row, old] -= n
        gain -= _log_sum(mass + n[:, None]) - _log_sum(mass)
    best = gain[:, :-1].argmax(1)
    return np.where(gain[row, best] > gain[row, old] + 1e-9, best, old)


def exchange_at_once(docs: DataFrame, clustered: np.ndarray, kind: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """word, n and kind of all words of `docs` after each moved by its gain against `pairs`; `kind`: of the clustered words."""
    classes = len(pairs)
    wide = 2 * classes + 1

    def step(batch):
        lists = batch.column("beside")
        data, offsets = utf8(lists.flatten())
        packed = data[offsets[0] : offsets[-1]].view(_BESIDE)
        ends = (offsets[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])] - offsets[0]) // _BESIDE.itemsize
        words = batch.column("word").to_numpy()
        place = _places(clustered, words.view(np.uint64))
        old = np.where(place >= 0, kind[place], classes - 2)
        for low in range(0, len(words), 512):
            cut = ends[low : low + 513]
            n = len(cut) - 1
            some = packed[cut[0] : cut[-1]]
            key = np.repeat(np.arange(n), np.diff(cut)) * wide + some["slot"]
            held = np.bincount(key, some["n"], n * wide).reshape(n, wide)
            after, before, own = held[:, :classes], held[:, classes : 2 * classes], held[:, -1]
            best = best_classes(after, before, own, old[low : low + n], pairs)
            yield {"word": words[low : low + n], "n": (after.sum(1) + own).astype(np.int64), "kind": best}

    return map_batches(_beside(docs, clustered, kind, classes), step, "word long, n long, kind int")


def _class_pairs(rows: DataFrame, classes: int) -> np.ndarray:
    """How often each class follows each in `sequences`."""

    def step(batch):
        data, offsets = utf8(batch.column("kinds"))
        of = data[offsets[0] : offsets[-1]].astype(np.int64)
        counts = np.bincount(np.concatenate([[classes - 1], of[:-1]]) * classes + of, minlength=classes * classes)
        pairs = np.flatnonzero(counts)
        return {"pair": pairs, "n": counts[pairs]}

    found = map_batches(rows.select("kinds"), step, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(classes * classes)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(classes, classes)


def exchange(bigrams: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    return exchanged(bigrams, classes, sweeps)[0]


def exchanged(bigrams: np.ndarray, classes: int, sweeps: int) -> tuple[np.ndarray, int]:
    """Classes of the words of a square matrix of bigram counts, and the moves of the last sweep; the last two words keep the
    last two classes.

    The likelihood of class bigrams is, but for a constant, the sum of n log n over class pairs less that over classes,
    once as first and once as second.
    """
    n = len(bigrams)
    frequency = bigrams.sum(axis=0)
    kind = np.empty(n, np.int64)
    kind[:-2][np.argsort(-frequency[:-2], kind="stable")] = np.arange(n - 2) % classes
    kind[-2:] = classes, classes + 1
    member = np.eye(classes + 2)[kind]
    pairs = member.T @ bigrams @ member

    log_sum, moved = _log_sum, 0
    for _ in range(sweeps):
        moved = 0
        for w in np.argsort(-frequency[:-2], kind="stable"):
            after, before, own = bigrams[w] @ member, bigrams[:, w] @ member, bigrams[w, w]
            old = kind[w]
            after[old] -= own
            before[old] -= own
            pairs[old] -= after
            pairs[:, old] -= before
            pairs[old, old] -= own
            firsts, seconds = pairs.sum(axis=1) + before, pairs.sum(axis=0) + after
            gain = (log_sum(pairs + after) - log_sum(pairs)).sum(axis=1) + (log_sum(pairs + before[:, None]) - log_sum(pairs)).sum(axis=0)
            corner = np.diag(pairs)
            gain += log_sum(corner + after + before + own) - log_sum(corner + after) - log_sum(corner + before) + log_sum(corner)
            gain -= log_sum(firsts + after.sum() + own) - log_sum(firsts) + log_sum(seconds + before.sum() + own) - log_sum(seconds)
            new = int(gain[:classes].argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            pairs[new] += after
            pairs[:, new] += before
            pairs[new, new] += own
            if new != old:
                moved += 1
                kind[w] = new
                member[w, old], member[w, new] = 0, 1
        if not moved:
            break
    return kind, moved


class Model:
    """Log-probabilities (base 10) by word and class; near words in the order of their hashes."""

    def __init__(self, head, head_counts, kind, mass, others: int, ends: int, vocabulary: int, unsettled: int = 0):
        """`head` in rising order, with counts and classes; `mass`: words by class, of which the last two are those of the
        others (`others` different words) and of the end."""
        self.head, self.head_counts, self.kind, self.mass, self.unsettled = head, head_counts, kind, mass, unsettled
        self.other, self.end = len(mass) - 2, len(mass) - 1
        self.tokens, self.ends = int(mass.sum()) + ends, ends
        self.base_total = np.log10(self.tokens + ALPHA * (vocabulary + (ends > 0) + 1))
        self.rest_total = np.log10(mass[self.other] + ALPHA * (others + 1))
        self.emission = self.emitted(head_counts, kind)
        self.transition = None

    def emitted(self, counts: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Of words by their counts and classes."""
        share = np.log10(np.maximum(counts, 1) / np.maximum(self.mass[kind], 1))
        return np.where(kind == self.other, np.log10(counts + ALPHA) - self.rest_total, share)

    def with_pairs(self, pairs: np.ndarray) -> Model:
        self.transition = np.log10((pairs + ALPHA) / (pairs + ALPHA).sum(axis=1, keepdims=True))
        return self

    def near(self, words: np.ndarray, first: np.ndarray) -> dict:
        """Columns of each row: classes of its tokens, what is known of its near words, and its far words."""
        rows = len(first) - 1
        row = np.repeat(np.arange(rows), np.diff(first))
        place = _places(self.head, words)
        near = place >= 0
        counts = np.where(near, self.head_counts[place] if len(self.head) else 0, 0)
        of = np.where(near, self.kind[place] if len(self.head) else 0, _FAR)
        emitted = np.where(near, self.emission[place] if len(self.head) else 0, 0)
        end = np.log10(self.ends + ALPHA)
        base = np.bincount(row, np.where(near, np.log10(counts + ALPHA), 0), rows) + end - (np.diff(first) + 1) * self.base_total
        kinds, _ = _with_ends(of, first, self.end)
        far = np.flatnonzero(~near)
        word, at = words[far].view(np.int64), row[far]
        order = np.lexsort((word, at))
        word, at = word[order], at[order]
        fresh = np.ones(len(far), bool)
        fresh[1:] = (word[1:] != word[:-1]) | (at[1:] != at[:-1])
        starts = np.searchsorted(at[fresh], np.arange(rows + 1))
        number = np.empty(len(far), np.int64)
        number[order] = np.cumsum(fresh) - 1 - starts[at]
        return {
            "n_tokens": np.diff(first) + 1,
            "n_known": np.bincount(row, near, rows).astype(np.int64) + (self.ends > 0),
            "base": base,
            "emitted": np.bincount(row, emitted, rows),
            "kinds": _binaries(kinds.astype(np.uint8), first + np.arange(rows + 1)),
            "far": pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(word[fresh])),
            "far_at": pa.ListArray.from_arrays(pa.array(np.searchsorted(row[far], np.arange(rows + 1)), pa.int32()), pa.array(number, pa.int32())),
        }


def _learn_words(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of `docs` (text) but for its transitions, and word, n, kind and exchanged of all its words."""
    counts = stage(_word_counts(docs), "words")
    kinds = counts.count()
    top = counts.orderBy(F.desc("n"), "word").limit(CLUSTERED).toArrow()
    clustered = np.sort(top["word"].to_numpy().view(np.uint64))
    found = _bigrams(docs, clustered).toArrow()
    n = len(clustered) + 2
    bigrams = np.zeros(n * n)
    bigrams[found["pair"].to_numpy()] = found["n"].to_numpy()
    bigrams = bigrams.reshape(n, n)
    classes = max(1, min(MOST_CLASSES, max(CLASSES, isqrt(kinds) // 8), n - 2))
    core, unsettled = exchanged(bigrams, classes, SWEEPS)
    member = np.eye(classes + 2)[core]
    moved = exchange_at_once(docs, clustered, core, member.T @ bigrams @ member).withColumn("exchanged", F.lit(True))
    if HEAD is not None:
        most = counts.orderBy(F.desc("n"), "word").limit(HEAD).select("word", F.lit(True).alias("most"))
        moved = moved.join(most, "word", "left").withColumn("exchanged", F.col("most").isNotNull()).drop("most")
        moved = moved.withColumn("kind", F.when(F.col("exchanged"), F.col("kind")).otherwise(classes))
    words = stage(moved, "classes")
    held = words.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toArrow()
    mass, others = (np.zeros(classes + 2, np.int64) for _ in range(2))
    mass[held["kind"].to_numpy()], others[held["kind"].to_numpy()] = held["n"].to_numpy(), held["words"].to_numpy()
    top = words.where(F.col("exchanged") & (F.col("n") >= _least_near(words))).toArrow()
    order = np.argsort(top["word"].to_numpy().view(np.uint64))
    head, head_counts, kind = (top[c].to_numpy()[order] for c in ("word", "n", "kind"))
    return Model(head.view(np.uint64), head_counts, kind.astype(np.int64), mass, int(others[classes]), docs.count(), kinds, unsettled), words


def _least_near(words: DataFrame) -> int:
    """The smallest count that at most `NEAR` exchanged words reach.

    It comes from a count of counts: sorting for the first `NEAR` would send as many rows from every task to the driver.
    """
    found = words.where("exchanged").groupBy("n").agg(F.count("*").alias("words")).toArrow()
    order = np.argsort(-found["n"].to_numpy())
    counts, reached = found["n"].to_numpy()[order], np.cumsum(found["words"].to_numpy()[order])
    fits = int(np.searchsorted(reached, NEAR, side="right"))
    return int(counts[fits - 1]) if fits else int(counts.max(initial=0)) + 1


def sequences(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base, emitted and kinds of each row of `docs` (doc_id, text).

    kinds: a byte for the class of each token; base and emitted: sums of log10 of the words' shares of all and of their class.
    """

    def step(batch):
        data, offsets = utf8(batch.column("text"))
        for low, high in steps(offsets):
            found, first = words_of(data, offsets, low, high)
            held = batch.slice(low, high - low)
            yield {c: held.column(c) for c in ("doc_id", "held_out")} | model.near(found, first)

    held = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, emitted double, kinds binary"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _held_out().alias("held_out"), "text")
    near = map_batches(rows, step, f"{held}, far array<long>, far_at array<int>")
    near = stage(near.withColumn("row", F.monotonically_increasing_id()), "near")
    far = near.select("row", F.posexplode("far").alias("at", "word")).join(words.select("word", "n", "kind"), "word")
    far = far.groupBy("row").agg(F.collect_list(F.struct("at", "n", "kind")).alias("joined"))
    both = near.withColumn("words", F.size("far")).drop("far").join(far, "row", "left")

    def fill(batch):
        lists, ats = batch.column("joined"), batch.column("far_at")
        lengths = lists.value_lengths().fill_null(0).to_numpy()
        begin = np.concatenate([[0], np.cumsum(batch.column("words").to_numpy())])
        joined = lists.flatten()
        to = np.repeat(begin[:-1], lengths) + joined.field("at").to_numpy()
        counts, kind = np.zeros(begin[-1], np.int64), np.full(begin[-1], model.other)
        counts[to], kind[to] = joined.field("n").to_numpy(), joined.field("kind").to_numpy()
        row = np.repeat(np.arange(len(ats)), ats.value_lengths().to_numpy())
        at = begin[row] + ats.flatten().to_numpy()
        data, offsets = utf8(batch.column("kinds"))
        of = data[offsets[0] : offsets[-1]].copy()
        of[of == _FAR] = kind[at]
        made = {c: batch.column(c) for c in ("doc_id", "held_out", "n_tokens")}
        for c, more in (("n_known", counts > 0), ("base", np.log10(counts + ALPHA)), ("emitted", model.emitted(counts, kind))):
            was = batch.column(c).to_numpy()
            made[c] = was + np.bincount(row, more[at], len(was)).astype(was.dtype)
        return made | {"kinds": _binaries(of, offsets - offsets[0])}

    return stage(map_batches(both, fill, held), "sequences")


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    def step(batch):
        data, offsets = utf8(batch.column("kinds"))
        of = data[offsets[0] : offsets[-1]]
        steps_ = model.transition[np.concatenate([[model.end], of[:-1]]), of]
        score = batch.column("emitted").to_numpy() + np.add.reduceat(steps_, offsets[:-1] - offsets[0])
        made = {c: batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")}
        return made | {"train_tokens": np.full(len(score), model.tokens), "base_score": batch.column("base"), "score": score}

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return map_batches(rows, step, schema)


def learn(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of `docs` (doc_id, text), and count and class of all its words."""
    model, words = _learn_words(docs)
    return model.with_pairs(_class_pairs(sequences(docs, model, words), model.end + 1)), words


def score(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of `docs` (doc_id, text)."""
    return _scored(sequences(docs, model, words), model)


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, words = _learn_words(docs.where(~_held_out()))
    rows = sequences(docs, model, words)  # `learn` and `score` in one reading of the texts
    return _scored(rows, model.with_pairs(_class_pairs(rows.where("NOT held_out"), model.end + 1)))
