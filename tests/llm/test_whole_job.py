"""Each operator on rows that an earlier version left out."""

import random
import re

import corpus_pipeline
from parcelyard.llm import license_scan, quality, voronoi_knn


def test_license_scan_against_the_rules_without_keywords(spark):
    texts = [
        "Creative Commons Attribution 4.0 International", "released under the WTFPL", "BSD 3-Clause", "CeCILL v2.1", "OpenRAIL-M 1.0",
        "proprietary and confidential", "may not be copied without permission", "New BSD", "modified BSD code", "Simplified BSD", "MPLv2.0 or EPLv1.0",
        "EUPL1.2", "general public licensev3", "PHP license3.01", "cecill2", "GPLv2 or later", "the unlicense, x11 license", "mit dem Hund", "",
    ]
    rules = [(a, p, re.compile(e, re.ASCII)) for a, p, _, e, _ in license_scan.rules()]
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, t in enumerate(texts):
        line = " " + " ".join(re.findall(r"[a-z0-9]+", t.lower())) + " "
        found = [(a, p, m.start(), m.end()) for a, p, e in rules for m in e.finditer(line)]
        stay = {x[0] for x in found if not any(y[2] <= x[2] and y[3] >= x[3] and (y[1] > x[1] or (y[1] == x[1] and y[3] - y[2] > x[3] - x[2])) for y in found)}
        stay |= {label for phrase, label in license_scan.BASE if f" {phrase} " in line}
        assert got[k] == ",".join(sorted(stay)), t
        assert bool(stay) == (k < 17), t


def test_a_repeated_row_keeps_its_text_once(spark):
    pick = random.Random(3)
    texts = [" ".join("".join(pick.choice("abcdefgh") for _ in range(6)) for _ in range(120)) for _ in range(5)]
    near = texts[0].replace(" ", " x ", 1)
    rows = [(5, texts[0]), (5, texts[0]), (9, near), (None, texts[1]), (7, texts[1]), (None, texts[2]), (None, texts[2]), (8, texts[3]), (8, texts[4])]
    kept = spark.createDataFrame([(k, t, len(t)) for k, t in rows], "doc_id long, text string, n_chars int")
    for _, step in corpus_pipeline.STAGES[1:3]:
        kept = step(spark, kept, None)
    assert kept.columns == ["doc_id", "text", "n_chars"]
    got = [tuple(r) for r in kept.collect()]
    assert all((n or 0) == len(t or "") for _, t, n in got)
    want = [(5, texts[0]), (7, texts[1]), (8, texts[3]), (8, texts[4]), (None, texts[2])]
    assert sorted(((k, t) for k, t, _ in got if t), key=str) == sorted(want, key=str)
    assert sum(k is None for k, _, _ in got) == 3


def test_quality_learns_toxic_words_of_any_language(spark, monkeypatch):
    pick = random.Random(7)
    ends = [a + b + c for a in "éaiou" for b in "nrtls" for c in ("e", "ait", "oir", "é")]

    def text(toxic):
        made = [pick.choice(["le", "de", "la", "pour", "dans"]) if pick.random() < 0.4 else pick.choice("bcdfg") + "é" + pick.choice(ends) + pick.choice(ends) for _ in range(200)]
        return " ".join([*made, *(("bénax" if toxic else "bénol") + pick.choice(ends) + pick.choice(ends) for _ in range(6))])

    toxic = [k % 20 == 0 for k in range(1200)]
    rows = spark.createDataFrame([(k, text(t), "fr") for k, t in enumerate(toxic)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, int(t)) for k, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["__keep"] for r in quality.classify(rows, labels).collect()}
    assert sum(kept[k] for k, t in enumerate(toxic) if t) <= 6 and sum(not kept[k] for k, t in enumerate(toxic) if not t) <= 6
    monkeypatch.setattr(quality, "SAMPLE", 240)
    monkeypatch.setattr(quality, "LEAST", 48)
    drawn = quality._drawn(labels.select("doc_id", (labels["toxic"] == 0).alias("given"), "toxic"), rows).collect()
    assert len(drawn) == 240 and 30 <= sum(not r["given"] for r in drawn) <= 60


def test_voronoi_knn_with_a_queried_id_that_is_repeated(spark):
    pick = random.Random(11)
    rows = [(20, [5.0, 5.0, 5.0 + k / 64]) for k in range(6)] + [(k, [pick.uniform(-2, 2) for _ in range(3)]) for k in range(101, 140)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = voronoi_knn.top_inner_products(data.where("vec_id = 20").limit(1), data, k=3).orderBy("rank").collect()
    q, *_ = [[int(64 * x // 1) for x in v] for k, v in rows if k == 20]
    scored = sorted((-sum(a * int(64 * b // 1) for a, b in zip(q, v)), k) for k, v in rows if k != 20)
    assert [(r["vec_id"], r["score"]) for r in got] == [(k, -s) for s, k in scored[:3]]
