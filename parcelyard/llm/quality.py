"""A quality classifier from weak labels.

Heuristic labellers vote good (1), bad (2) or nothing (0) on every document; their votes overlap. How often each pattern
of votes occurs in the corpus is counted; expectation-maximisation over the patterns estimates how each labeller
votes on good and on bad documents, and the probability that a pattern's documents are good. A labeller that votes bad is
held to be wrong on `WRONG` of the good documents at most. The posterior labels a sample of `SAMPLE` documents (those with
the smallest hashes) for a linear scorer over hashed votes, words and word beginnings of several lengths in characters,
which count as often as they occur, and which then scores every document.
Documents of `KEEP` or more stay.

Given labels (doc_id, quality, toxic) are one more labeller, right with probability `TRUST`, and then the sample is one of
`SAMPLE` labelled documents: only quality 1 without toxic 1 counts as good there. Rows with a null in them don't vote.
Of each language's toxic, otherwise bad and good labels about `LEAST` or all are in it, however rare they are.

Null text is empty; empty texts get the votes of an empty text. Rows without an id are scored like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GOLD, give_back, hashes_of, map_batches, mixed, span_hashes, stage, steps, table, utf8, word_spans, words_of

SAMPLE, LEAST, BUCKETS, KEEP, ROUNDS, EPOCHS, PRIOR_GOOD, WRONG, TRUST, RATE = 8192, 512, 1 << 18, 0.5, 100, 300, 0.85, 0.002, 0.99, 0.3
#: Characters of word beginnings, and the length that a row's words share (votes have 1 each).
BEGINS, LENGTH = (3, 5, 7), 4.0

# Common words of the corpus's four languages, and insults.
STOP_WORDS = """
the of and to in is that it for was on are as with his they at be this have from or had by not but what all were we when your
der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei
de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec
el los del las por con para su al lo como pero sus ya este si porque esta entre cuando muy sin sobre ser
""".split()
INSULTS = """
idiot idiots stupid moron morons scum loser losers clown worthless disgusting pathetic trash garbage imbecile dumb filthy vermin
""".split()

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_NOT_LINE = np.zeros(256, bool)
_NOT_LINE[10] = True
_STOPS, _INSULTS = np.sort(hashes_of(STOP_WORDS)), np.sort(hashes_of(INSULTS))

LABELLERS = ("symbols", "bars", "stop_words", "word_length", "insults", "repeated_lines", "repeated_words", "capitals", "length", "letters")


def _within(sorted_words: np.ndarray, words: np.ndarray) -> np.ndarray:
    return sorted_words[np.minimum(np.searchsorted(sorted_words, words), len(sorted_words) - 1)] == words


def votes(data: np.ndarray, offsets: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Votes (rows by labellers), hashes of words and (lengths by words) of their beginnings, and the number of words before each row."""
    part, rows = offsets[low : high + 1], high - low
    text, at = data[part[0] : part[-1]], part - part[0]

    def per_row(mask: np.ndarray, bounds: np.ndarray = at) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds]).astype(float)

    starts, ends = word_spans(data, part, ~_ALNUM)
    words, first = span_hashes(data, int(part[0]), starts, ends), np.searchsorted(starts, at)
    characters = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
    nth = np.searchsorted(characters, starts)
    begins = np.stack([span_hashes(data, int(part[0]), starts, np.minimum(ends, characters[np.minimum(nth + n, len(characters) - 1)])) for n in BEGINS])
    n_bytes, n_words = np.diff(part).astype(float), np.diff(first).astype(float)
    some, many = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    letters = per_row(_ALNUM[text])
    symbols, bars = per_row(_SYMBOL[text]) / some, per_row(text == ord("|")) / many
    stops, insults = per_row(_within(_STOPS, words), first) / many, per_row(_within(_INSULTS, words), first)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][np.diff(first) > 0]] = False
    echoes, capitals = per_row(again, first) / many, per_row((text >= 65) & (text <= 90)) / np.maximum(letters, 1)
    lines, line_first = words_of(data, offsets, low, high, _NOT_LINE)
    repeated = np.array([1 - len(np.unique(lines[a:b])) / max(1, b - a) for a, b in zip(line_first[:-1], line_first[1:], strict=True)])
    mean, share = letters / many, letters / some

    out = np.zeros((rows, len(LABELLERS)), np.int64)
    for k, (good, bad) in enumerate((
        (symbols < 0.01, symbols > 0.05),
        (np.zeros(rows, bool), bars > 0.1),
        (stops > 0.1, (stops < 0.02) & (n_words >= 20)),
        ((mean > 2.5) & (mean < 9), (mean < 2) | (mean > 14)),
        (insults == 0, (insults >= 2) | ((insults == 1) & (n_words < 30))),
        (repeated < 0.1, repeated > 0.5),
        (echoes < 0.05, (echoes > 0.3) & (n_words >= 10)),
        (capitals < 0.15, (capitals > 0.3) & (n_words >= 10)),
        (n_words >= 20, n_words < 3),
        (share > 0.7, share < 0.55),
    )):
        out[good, k], out[bad, k] = 1, 2
    return out, words, begins, first


def _pattern(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: the probability that each pattern's documents are good, and P(vote | labeller, class).

    Rounds start from the share of bad votes among those cast; one bad vote weighs as much as all good ones.
    """
    good = np.where((patterns == 2).any(axis=1), 0.1, 0.95)
    one_hot = np.eye(3)[patterns]  # pattern, labeller, vote
    for _ in range(rounds):
        weight = np.stack([good, 1 - good]) * counts
        chance = np.einsum("cp,plv->clv", weight, one_hot) + np.array([1.0, 1.0, 1.0])
        chance /= chance.sum(axis=2, keepdims=True)
        chance[0, :, 2] = np.minimum(chance[0, :, 2], WRONG)
        prior = (weight.sum(axis=1) + 20 * np.array([PRIOR_GOOD, 1 - PRIOR_GOOD])) / (counts.sum() + 20)
        score = np.log(prior)[:, None] + np.einsum("clv,plv->cp", np.log(chance), one_hot)
        good = 1 / (1 + np.exp(np.clip(score[1] - score[0], -500, 500)))
    return good, chance


def _features(v: np.ndarray, words: np.ndarray, begins: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Hashed features of each row: one for each vote, then its words and word beginnings, as often as they occur."""
    fixed = np.arange(v.shape[1]) * 3 + v
    hashed = [3 * v.shape[1] + (x % np.uint64(BUCKETS)).astype(np.int64) for x in (words, *mixed(begins ^ GOLD))]
    return [np.concatenate([f, *(h[a:b] for h in hashed)]) for f, a, b in zip(fixed, first[:-1], first[1:], strict=True)]


def _values(features: list[np.ndarray], votes_: int) -> np.ndarray:
    """Weights of features: 1 for votes, and words share a length of `LENGTH`."""
    return np.concatenate([np.concatenate([np.ones(votes_), np.full(len(f) - votes_, LENGTH * (len(f) - votes_) ** -0.5 if len(f) > votes_ else 0.0)]) for f in features])


def _counted(features: np.ndarray, votes_: int) -> tuple[np.ndarray, np.ndarray]:
    """A row's votes and then its distinct other features, and how often each occurs."""
    kinds, times = np.unique(features[votes_:], return_counts=True)
    return np.concatenate([features[:votes_], kinds]), np.concatenate([np.ones(votes_, np.int64), times])


def train(columns: np.ndarray, times: np.ndarray, bounds: np.ndarray, good: np.ndarray, votes_: int, epochs: int = EPOCHS) -> np.ndarray:
    """Logistic regression on soft labels by full-batch gradient steps with momentum and decay; the last weight is the bias.

    Row k has the features `columns[bounds[k]:bounds[k + 1]]`, its votes first, each as often as `times` says. Steps add up
    over blocks of rows, so that only the features themselves are held for all of them.
    """
    weight = np.zeros(3 * votes_ + BUCKETS + 1)
    speed = np.zeros_like(weight)
    blocks = []
    for low in range(0, len(good), 512):
        starts, sizes = bounds[low : low + 513][:-1], np.diff(bounds[low : low + 513]) - votes_
        voted = columns[starts[:, None] + np.arange(votes_)]
        own = slice(bounds[low], bounds[min(low + 512, len(good))])
        other = (np.arange(own.stop - own.start) - np.repeat(starts - own.start, sizes + votes_)) >= votes_
        own, often = columns[own][other], times[own][other]
        some = np.flatnonzero(sizes)
        first = (np.cumsum(sizes) - sizes)[some]
        scale = LENGTH * np.add.reduceat(often, first) ** -0.5 if len(own) else np.zeros(0)
        blocks.append((good[low : low + 512], voted, own, often, some, first, sizes[some], scale))
    for _ in range(epochs):
        slope = np.zeros_like(weight)
        for target, voted, own, often, some, first, sizes, scale in blocks:
            z = weight[voted].sum(axis=1) + weight[-1]
            if len(own):
                z[some] += scale * np.add.reduceat(weight[own] * often, first)
            off = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - target
            slope += np.bincount(voted.ravel(), np.repeat(off, votes_), len(weight))
            slope += np.bincount(own, np.repeat(off[some] * scale, sizes) * often, len(weight))
            slope[-1] += off.sum()
        speed = 0.9 * speed - RATE * (slope / len(good) + 1e-6 * weight)
        weight += speed
    return weight


def _targets(posteriors: np.ndarray, given: list[bool | None]) -> np.ndarray:
    """Soft labels from the posterior of a row's votes and its given label, if any."""
    odds = posteriors.clip(1e-9, 1 - 1e-9)
    odds = odds / (1 - odds) * np.array([{True: TRUST / (1 - TRUST), False: (1 - TRUST) / TRUST}.get(x, 1.0) for x in given])
    labels = odds / (1 + odds)
    bad = np.array([x is False for x in given], bool)  # a document that a label calls bad is bad, however well it looks
    return np.where(bad, np.minimum(labels, 1 - TRUST), labels)


def _trained(rows: DataFrame, posterior: dict[int, float]) -> np.ndarray | None:
    """Weights from the sample's rows (pattern, features, times, given), learned in one task: the sample is bounded.

    None for an empty sample. Only the weights come to the driver.
    """

    def learn(sample: pa.Table) -> pa.Table:
        lists = sample.column("features").combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        columns, times = (sample.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("features", "times"))
        labels = _targets(np.array([posterior[p] for p in sample.column("pattern").to_pylist()]), sample.column("given").to_pylist())
        weight = train(columns, times, bounds, labels, len(LABELLERS))
        give_back()
        return pa.table({"weight": pa.array(weight, pa.float64())})

    learned = rows.groupBy().applyInArrow(learn, "weight double").toArrow()
    return learned["weight"].to_numpy() if len(learned) else None


def _drawn(given: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and given of `SAMPLE` labels (doc_id, given, toxic); kinds (language, given, toxic) too rare to have `LEAST` rows weigh more."""
    if "lang" in docs.columns:
        given = given.join(docs.groupBy("doc_id").agg(F.min("lang").alias("lang")), "doc_id")
    else:
        given = given.join(docs.select("doc_id").distinct(), "doc_id").withColumn("lang", F.lit(None).cast("string"))
    kind = ["lang", "given", "toxic"]
    kinds = given.groupBy(*kind).agg(F.count("*").alias("n"))
    rows = kinds.agg(F.sum("n")).first()[0] or 0
    weight = F.greatest(F.lit(1.0), F.lit(LEAST * rows / SAMPLE) / F.col("n"))
    weights = kinds.select(*[F.col(c).alias(f"__{c}") for c in kind], weight.alias("__weight"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in kind]
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / F.col("__weight")
    return given.join(weights, same).orderBy(place, "doc_id").limit(SAMPLE).select("doc_id", "given")


def fit(docs: DataFrame, given: DataFrame | None = None) -> tuple[np.ndarray, dict[int, float], np.ndarray]:
    """Weights of the scorer, the posterior by vote pattern, and P(vote | labeller, class), from rows (doc_id, text)."""

    def count(batch):
        data, offsets = utf8(batch.column("text"))
        for low, high in steps(offsets):
            patterns, n = np.unique(_pattern(votes(data, offsets, low, high)[0]), return_counts=True)
            yield {"pattern": patterns, "n": n}

    found = map_batches(docs.select("text"), count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas().sort_values("pattern")
    codes = found["pattern"].to_numpy(np.int64)
    patterns = codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    good, chance = estimate(patterns, found["n"].to_numpy(float))
    posterior = dict(zip(codes.tolist(), good.tolist(), strict=True))

    def cut(batch):
        data, offsets = utf8(batch.column("text"))
        for low, high in steps(offsets):
            v, *rest = votes(data, offsets, low, high)
            features, times = zip(*(_counted(f, v.shape[1]) for f in _features(v, *rest)), strict=True)
            yield {"pattern": _pattern(v), "features": features, "times": times, "given": batch.column("given").slice(low, high - low)}

    if given is None:
        docs = docs.withColumn("given", F.lit(None).cast("boolean"))
    else:
        good_label = (F.min("quality") == 1) & (F.max("toxic") == 0)
        given = given.groupBy("doc_id").agg(good_label.alias("given"), F.max("toxic").alias("toxic")).where("given IS NOT NULL")
        docs = docs.join(_drawn(given, docs), "doc_id")
    order = F.xxhash64(F.coalesce("text", F.lit("")))
    sample = docs.select("text", "given", order.alias("h"), "doc_id").orderBy("h", "doc_id").limit(SAMPLE).select("text", "given")
    # the limit leaves one partition; features are made in many
    spread = sample.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = stage(map_batches(spread, cut, "pattern long, features array<int>, times array<int>, given boolean"), "sample")
    weight = _trained(rows, posterior)
    return np.zeros(3 * len(LABELLERS) + BUCKETS + 1) if weight is None else weight, posterior, chance


def classify(docs: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """`docs` with __votes, __posterior, __score and __keep."""
    weight, posterior, _ = fit(docs.select("doc_id", "text", *[c for c in ("lang",) if c in docs.columns]), given)

    @F.arrow_udf("votes string, posterior double, score double")
    def judge(text: pa.Array) -> pa.Array:
        data, offsets = utf8(text)
        named, chances, scores = [], [], []
        for low, high in steps(offsets):
            v, *rest = votes(data, offsets, low, high)
            features = _features(v, *rest)
            row = np.repeat(np.arange(len(v)), [len(f) for f in features])
            z = np.bincount(row, _values(features, v.shape[1]) * weight[np.concatenate(features)], len(v)) + weight[-1]
            scores.extend(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            named.extend("".join(map(str, r)) for r in v)
            chances.extend(posterior[p] for p in _pattern(v).tolist())
        made = [pa.array(named, pa.string()), pa.array(chances, pa.float64()), pa.array(scores, pa.float64())]
        give_back()
        return pa.StructArray.from_arrays(made, names=["votes", "posterior", "score"])

    judged = docs.withColumn("__judged", judge("text"))
    parts = {f"__{c}": F.col(f"__judged.{c}") for c in ("votes", "posterior", "score")}
    return judged.withColumns(parts).drop("__judged").withColumn("__keep", F.col("__score") >= KEEP)


def good_documents(docs: DataFrame, given: DataFrame | None = None) -> DataFrame:
    return classify(docs, given).where("__keep").select(*docs.columns)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", F.col("__score").alias("score"), F.col("__keep").alias("keep"), F.col("__posterior").alias("posterior"), F.col("__votes").alias("votes"))
