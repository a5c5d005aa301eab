"""Repeated passages of over 50 words that are shorter than the byte strings of `suffix_dedup`."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from parcelyard.llm import suffix_dedup


def without_repeats(texts, length, words):
    """Plain version: bytes of repeated strings and of repeated runs of words go."""
    data = [(t or "").encode() for t in texts]
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)] for t in data]
    held = [[t[a:b].lower() for a, b in s] for t, s in zip(data, spans, strict=True)]
    strings = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    runs = Counter(tuple(w[i : i + words]) for w in held for i in range(len(w) - words + 1))
    for t, s, w in zip(data, spans, held, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if strings[t[i : i + length]] > 1:
                gone[i : i + length] = True
        for i in range(len(w) - words + 1):
            if runs[tuple(w[i : i + words])] > 1:
                gone[s[i][0] : s[i + words - 1][1]] = True
        yield bytes(b for b, g in zip(t, gone, strict=True) if not g).decode("utf-8", "ignore")


def made_words(pick, n):
    return ["".join(pick.choice("abcdéfgh") for _ in range(pick.randint(1, 9))) for _ in range(n)]


def test_passages_of_over_50_words_go_from_the_pipeline(spark):
    pick = random.Random(4)
    long, short = made_words(pick, 51), made_words(pick, 50)
    assert len(" ".join(long).encode()) < suffix_dedup.LENGTH
    rest = [made_words(pick, 90) for _ in range(5)]
    texts = [" ".join([*r[:30], *p, *r[30:]]) for r, p in zip(rest, [long, long, short, short, []], strict=True)]
    texts[1] = texts[1].replace(" ", "\n", 50)
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.cut_repeats(spark, docs, None).collect()}
    assert [got[k]["text"].split() for k in (0, 1)] == rest[:2]
    assert [got[k]["text"] for k in (2, 3, 4)] == texts[2:]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


@pytest.mark.parametrize("most", [1000, 2])
def test_passages_against_a_plain_version(spark, most, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", most)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1 << 10)
    pick = random.Random(8)
    source = made_words(pick, 300)
    texts = [None, "", " \n", "one", "the " * 45, "x " * 19, "é" * 90, "ü" * 95 + " " + "é" * 95]
    for _ in range(40):
        own = made_words(pick, pick.randint(0, 60))
        for _ in range(pick.randint(0, 3)):
            low, at = pick.randint(0, 290), pick.randint(0, len(own))
            own[at:at] = source[low : low + pick.choice([18, 19, 20, 21, 22, 30, 45])]
        texts.append("".join(w.upper() * (pick.random() < 0.1) or w for w in [x + pick.choice([" ", "  ", "\t", "\n"]) for x in own]))
    texts += [texts[9], texts[10] + texts[11]]
    texts = [t and re.sub("É", "é", t) for t in texts]  # only A-Z are alike in either case
    rows = [(k if k != 12 else None, t, 1) for k, t in enumerate(texts)] + [(9, texts[9], 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind int").repartition(3)
    cut = suffix_dedup.strip_repeats(docs, 180, 20)
    assert cut.schema == docs.schema
    want = Counter((k, None if t is None else w, n) for (k, t, n), w in zip(rows, without_repeats([t for _, t, _ in rows], 180, 20), strict=True))
    assert Counter(tuple(r) for r in cut.collect()) == want
    assert suffix_dedup.strip_repeats(docs.limit(0), 180, 20).count() == 0
