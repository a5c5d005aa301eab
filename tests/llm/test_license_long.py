"""License detection in texts with very many places."""

import random

from parcelyard.llm import license_scan

SCHEMA = "doc_id long, text string, words string, row string"
PHRASES = [
    "mit license", "the mit x11 license", "gnu general public license version 2 or any later version", "general public license",
    "apache license version 2 0", "apache license", "creative commons attribution 4 0 international", "all rights reserved", "gpl 3 0 only", "plain words here",
]


def scanned(docs):
    out = {}
    for r in license_scan.scan(docs).collect():
        found = sorted((d["label"], d["priority"], d["low"], d["high"]) for d in r["detections"])
        out[r["doc_id"]] = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"], found)
    return out


def test_rows_with_many_detections_are_judged_alike(spark, monkeypatch):
    pick = random.Random(8)
    rows = [(k, " ".join(pick.choice(PHRASES) for _ in range(pick.choice([0, 1, 5, 30]))), "w", "r") for k in range(40)] + [(99, None, "w", "r")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    few = scanned(docs)
    monkeypatch.setattr(license_scan, "MANY", 1)
    assert scanned(docs) == few
    assert any(len(r[-1]) > 20 for r in few.values())


def test_a_text_of_repeated_phrases(spark):
    n = 20_000
    docs = spark.createDataFrame([(1, "MIT license. " * n + "Apache License, Version 2.0", "w", "r"), (1, "mit license", "w", "r")], SCHEMA)
    long, short = sorted(license_scan.scan(docs).collect(), key=lambda r: -r["n_words"])
    assert (long["n_words"], long["n_base"], long["first_word"], long["last_word"]) == (2 * n + 5, n + 1, 0, 2 * n)
    assert long["labels"] == "apache,apache-2.0,mit" and short["labels"] == "mit"
    places = sorted(d["low"] for d in long["detections"] if d["label"] == "mit")
    assert places == list(range(0, 2 * n, 2))
