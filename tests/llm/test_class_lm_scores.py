"""Scores of the class model against plain counting, and exchange moves against trying every class."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from parcelyard.llm import class_lm
from parcelyard.llm.common import hashes_of

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows():
    """Sentences of determiner, noun and verb, with rare words, repeats, empties and nulls."""
    pick = random.Random(2)
    kinds = [["the", "a", "this"], ["cat", "dog", "bird", "fish"], ["sees", "hears", "likes"]]
    out = []
    for k in range(120):
        text = " ".join(pick.choice(kinds[i % 3]) if pick.random() < 0.9 else f"rare{pick.randint(0, 40)}" for i in range(pick.randint(0, 30)))
        out.append((k, text.upper() if k % 7 == 0 else text))
    return out + [(None, "the cat"), (500, None), (501, ""), (3, out[3][1]), (3, out[3][1])]


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()), None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def test_scores_equal_plain_counting(spark, rows, monkeypatch):
    for name, value in (("CLUSTERED", 8), ("CLASSES", 4), ("HEAD", 25)):
        monkeypatch.setattr(class_lm, name, value)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model, counts = class_lm.learn(docs.where(~class_lm._held_out()))
    got = {(r["doc_id"], r["n_tokens"]): r for r in class_lm.score(docs, model, counts).collect()}

    training = [tokens(t) for k, t in rows if not held_out(k)]
    seen = Counter(w for t in training for w in t)
    place = {int(h): int(c) for h, c in zip(model.head, model.kind)}
    words = [w for w in seen if w is not None]
    kind = {w: place.get(int(h), model.other) for w, h in zip(words, hashes_of(words))} | {None: model.end}
    assert len(place) == 25 and len({c for c in place.values() if c != model.other}) == 4
    pairs, mass = Counter(), Counter()
    for t in training:
        for a, b in zip([None, *t[:-1]], t):
            pairs[kind[a], kind[b]] += 1
            mass[kind[b]] += 1
    others = [w for w in words if kind[w] == model.other]
    classes, alpha = model.end + 1, class_lm.ALPHA
    following = {a: sum(pairs[a, b] + alpha for b in range(classes)) for a in range(classes)}
    rest = mass[model.other] + alpha * (len(others) + 1)

    def emitted(w):
        if w is None:
            return 0.0
        c = kind.get(w, model.other)
        return math.log10((seen[w] + alpha) / rest if c == model.other else seen[w] / mass[c])

    for k, text in rows:
        want, before = 0.0, model.end
        for w in tokens(text):
            c = kind.get(w, model.other)
            want += math.log10((pairs[before, c] + alpha) / following[before]) + emitted(w)
            before = c
        assert got[k, len(tokens(text))]["score"] == pytest.approx(want)
    # all words of a class and its transitions share a mass of one
    assert (10**model.transition).sum(axis=1) == pytest.approx(np.ones(classes))
    for c in set(place.values()) - {model.other}:
        assert sum(10 ** emitted(w) for w in words if kind[w] == c) == pytest.approx(1)


def test_classes_beat_single_words_on_held_out_texts(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    model, counts = class_lm.learn(docs.where(~class_lm._held_out()))
    held = class_lm.score(docs, model, counts).where("held_out").toPandas()
    assert held["score"].sum() > 0.9 * held["base_score"].sum()


def likelihood(kind, bigrams):
    pairs = np.zeros((kind.max() + 1,) * 2)
    np.add.at(pairs, (kind[:, None], kind[None, :]), bigrams)
    log = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return log(pairs) - log(pairs.sum(0)) - log(pairs.sum(1))


def test_moves_at_once_are_the_best_of_trying_every_class():
    pick = np.random.default_rng(5)
    n, classes = 30, 6
    bigrams = pick.poisson(3, (n, n)).astype(float) * (pick.random((n, n)) < 0.5)
    kind = np.concatenate([pick.integers(0, classes - 1, n - 1), [classes - 1]])
    member = np.eye(classes)[kind]
    pairs = member.T @ bigrams @ member
    own = np.diag(bigrams).copy()
    alone = bigrams - np.diag(own)
    got = class_lm.best_classes((alone @ member)[:-1], (alone.T @ member)[:-1], own[:-1], kind[:-1], pairs)
    for w in range(n - 1):
        tried = []
        for c in range(classes - 1):
            other = kind.copy()
            other[w] = c
            tried.append(likelihood(np.append(other, classes - 1), np.pad(bigrams, (0, 1))))
        assert tried[got[w]] == pytest.approx(max(tried)), w


def test_exchange_says_what_is_unsettled():
    counts = np.zeros((10, 10))
    counts[:4, 4:8] = counts[4:8, :4] = 50 + np.arange(16).reshape(4, 4) % 3
    assert class_lm.exchanged(counts, 2, 20)[1] == 0


def test_words_that_are_not_held_in_memory_have_classes_too(spark, rows, monkeypatch):
    for name, value in (("CLUSTERED", 8), ("CLASSES", 4), ("NEAR", 6)):
        monkeypatch.setattr(class_lm, name, value)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model, words = class_lm.learn(docs.where(~class_lm._held_out()))
    got = {(r["doc_id"], r["n_tokens"]): r for r in class_lm.score(docs, model, words).collect()}

    training = [tokens(t) for k, t in rows if not held_out(k)]
    seen = Counter(w for t in training for w in t if w)
    table = {r["word"] % (1 << 64): (r["n"], r["kind"]) for r in words.collect()}
    names = list(seen)
    kind = {w: table[int(h)][1] for w, h in zip(names, hashes_of(names))}
    assert {w: table[int(h)][0] for w, h in zip(names, hashes_of(names))} == seen and len(table) == len(seen)
    assert 0 < len(model.head) <= 6
    rare = [w for w in names if w.startswith("rare")]
    assert len(rare) > 30 and len({kind[w] for w in rare}) > 2

    pairs, mass = Counter(), Counter()
    of = lambda w: model.end if w is None else kind.get(w, model.other)
    for t in training:
        for a, b in zip([None, *t[:-1]], t):
            pairs[of(a), of(b)] += 1
            mass[of(b)] += 1
    alpha, classes = class_lm.ALPHA, model.end + 1
    following = {a: sum(pairs[a, b] + alpha for b in range(classes)) for a in range(classes)}
    rest = mass[model.other] + alpha * (sum(k == model.other for k in kind.values()) + 1)
    for k, text in rows:
        want, before = 0.0, model.end
        for w in tokens(text):
            c = of(w)
            want += math.log10((pairs[before, c] + alpha) / following[before])
            want += 0 if w is None else math.log10((seen[w] + alpha) / rest if c == model.other else seen[w] / mass[c])
            before = c
        assert got[k, len(tokens(text))]["score"] == pytest.approx(want)


def test_nothing_is_sorted_for_the_words_in_memory(spark, monkeypatch):
    words = spark.createDataFrame([(k, n, 0, True) for k, n in enumerate([9, 7, 7, 3, 3, 3, 1, 1])], "word long, n long, kind int, exchanged boolean")
    for near, least in ((1, 9), (2, 9), (3, 7), (5, 7), (6, 3), (8, 1), (100, 1)):
        monkeypatch.setattr(class_lm, "NEAR", near)
        assert class_lm._least_near(words) == least
    monkeypatch.setattr(class_lm, "NEAR", 0)
    assert class_lm._least_near(words) == 10
