"""Each operator against brute force on small rows with nulls, ties, copies and clashing column names."""

import gc
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from parcelyard.llm import best_fit, class_lm, license_scan, mixing, ngram_join, projection_forest, quality, suffix_dedup, url_filter, voronoi_knn


def words(text):
    return (text or "").encode().lower().split()


def shingle_sets(pairs):
    out = {}
    for k, t in pairs:
        w = words(t)
        out[k] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def test_ngram_join(docs, empty, texts):
    got = Counter(tuple(r) for r in ngram_join.join_components(docs).collect())
    sets = shingle_sets(enumerate(texts))
    component = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                    component[a] = component[b] = min(component[a], component[b])
    want = Counter((k, len(s), component[k]) for k, s in sets.items())
    want[(1, len(sets[1]), component[1])] += 1
    want[(None, len(sets[0]), None)] += 1
    assert got == want
    assert ngram_join.join_components(empty).count() == 0


def brute_repeats(rows, length):
    seen = Counter(t[i : i + length] for t in rows for i in range(len(t) - length + 1))
    for t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        yield len(t), int(gone.sum()), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("most", [1000, 2])
def test_suffix_dedup(docs, empty, texts, most, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", most)
    rows = [*enumerate(texts), (None, texts[0]), (1, texts[1])]
    want = Counter((k, *x) for (k, _), x in zip(rows, brute_repeats([(t or "").encode() for _, t in rows], 400), strict=True))
    assert Counter(tuple(r) for r in suffix_dedup.repeat_digests(docs).collect()) == want
    stripped = suffix_dedup.strip_repeats(docs)
    assert stripped.schema == docs.schema and stripped.count() == docs.count()
    assert suffix_dedup.repeat_digests(empty).count() == 0


def test_suffix_array_and_common_prefixes():
    text = np.frombuffer(b"banana bandana banana\0\0" * 3, np.uint8)
    order, keys = suffix_dedup.suffix_array(text)
    raw = text.tobytes()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    got = suffix_dedup.common_prefixes(order, keys, 400)
    for a, b, n in zip(order[:-1], order[1:], got[1:], strict=True):
        x, y = raw[a:], raw[b:]
        assert n == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_best_fit(docs, empty, texts):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = Counter()
    for k, t in [*enumerate(texts), (None, texts[0]), (1, texts[1])]:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 2048):
            want[(k, at // 2048, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()))] += 1
    got = best_fit.pack_documents(docs).toPandas()
    assert Counter((None if math.isnan(r[0]) else int(r[0]), *map(int, r[1:5])) for r in got.itertuples(index=False)) == want
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id")["length"].cumsum() - got["length"] == got["offset"]).all()
    assert got["sequence_id"].nunique() == -(-got["length"].sum() // 2048)
    assert best_fit.pack_documents(empty).count() == 0


def test_best_fit_ids_of_odd_words(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    plain, pick = Tokenizer.from_file(path), random.Random(4)
    signs = "abcdstrev'\"AZ019.,;:!?|$<>- \t\n\x0b\x00\x1f\x85\xa0\u3000éÉßİſŉe\u0327\u0301ﬁ中\u0958٣²한\u1112\u1161Σς😀\u200dǅ"
    odd = ["".join(pick.choices(signs, k=pick.randrange(50))) for _ in range(800)]
    odd += ["Hello <|startoftext|>World<|endoftext|> don't İ. q\u0302.", "x<|endoftext|>y A", "a<| <|b é<|", "</w> b</W>", " lead  trail "]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    want = {k: [*plain.encode(t, add_special_tokens=False).ids, 0] for k, t in enumerate(odd)}
    assert {r["doc_id"]: r["ids"] for r in best_fit.pieces(docs, path, with_ids=True).collect()} == want


def test_best_fit_remembers_words_in_little_room():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    pick, before = random.Random(6), pa.total_allocated_bytes()
    text = " ".join("".join(pick.choices("abcdefgh", k=8)) for _ in range(30_000))
    encoder = best_fit.WordEncoder(str(public_tokenizers.path("word_bpe_49k.json")))
    words = pa.array(list(dict.fromkeys(text.split())))
    tracemalloc.start()
    encoder.lookup(words)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(encoder.words) == len(words)
    assert held + pa.total_allocated_bytes() - before - words.nbytes < 100 * 30_000  # 32 bytes a word; 178 as Python objects


def test_best_fit_leaves_nothing_in_idle_workers(spark, docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    assert best_fit.pieces(docs.repartition(8), str(public_tokenizers.path("word_bpe_49k.json"))).count()

    def held(batches):
        for batch in batches:
            kinds = [type(x).__name__ for x in gc.get_objects()]
            yield pa.RecordBatch.from_pydict({"n": [kinds.count("WordEncoder")] * batch.num_rows})

    assert {r["n"] for r in spark.range(0, 64, 1, 16).mapInArrow(held, "n long").collect()} == {0}


def test_best_fit_takes_the_tightest_room():
    assert best_fit.best_fit([7, 6, 4, 3, 2], 10) == ([0, 1, 1, 0, 2], [0, 0, 6, 7, 0])


def test_mixing(docs, empty, texts):
    got = mixing.mix(docs).toPandas()
    assert len(got) == len(texts) + 2
    sizes = got.groupby("source", dropna=False)["__size"].sum()
    assert (got["__copies"] <= 3).all() and set(got["__size"]) == {len(words(t)) for t in texts}
    total, weights = sizes.sum(), {"a": 5.0, "b": 2.0}
    targets = got.groupby("source", dropna=False)["__target"].first()
    assert targets.sum() == pytest.approx(total)
    for source, target in targets.items():
        assert target <= 3 * sizes[source] + 1e-6
        if source in weights and target < 3 * sizes[source]:
            assert target > 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_water_filling(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 50), ("c", 49)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx({"a": 3.0, "b": 97 * 2 / 3, "c": 97 / 3})


def test_quality(docs, empty, spark, texts):
    judged = quality.classify(docs)
    assert judged.count() == len(texts) + 2 and judged.where("__score IS NULL").count() == 0
    junk = ["buy | now | here | more | links | all | day"] * 3 + ["x%%% y$$$ z### " * 30] * 3 + ["word " * 60] * 3
    good = [f"the cat of {k} sat on the mat and it was in the house with all of the {k} dogs that were there for a while" for k in range(40)]
    rows = spark.createDataFrame(list(enumerate(junk + good)), "doc_id long, text string")
    kept = {r["doc_id"]: r["__keep"] for r in quality.classify(rows).collect()}
    assert [kept[k] for k in range(9)] == [False] * 9 and all(kept[k] for k in range(9, 49))
    assert quality.classify(empty).count() == 0


def test_class_lm(docs, empty, texts):
    rows = [*enumerate(texts), (None, texts[0]), (1, texts[1])]
    held = {k: zlib.crc32(str("" if k is None else k).encode()) % 5 == 1 for k, _ in rows}
    counts = Counter()
    for k, t in rows:
        if not held[k]:
            counts.update([*words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    small = docs.select("doc_id", "text")
    model, table = class_lm.learn(small.where(~class_lm._held_out()))
    got = class_lm.score(small, model, table).collect()
    for r in got:
        k = r["doc_id"]
        tokens = [*words(dict(rows)[k]), None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[k], len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    mass = 10**model.transition
    assert mass.sum(axis=1) == pytest.approx(np.ones(len(mass)))
    assert len(got) == len(rows) and class_lm.learn(empty.select("doc_id", "text"))[1].count() == 0


def test_exchange_finds_the_classes():
    counts = np.zeros((10, 10))
    counts[:4, 4:8] = counts[4:8, :4] = 50 + np.arange(16).reshape(4, 4) % 3
    kind = class_lm.exchange(counts, 2, 20)
    assert len(set(kind[:4])) == 1 and len(set(kind[4:8])) == 1 and kind[0] != kind[4]


def test_url_filter(spark):
    urls = {
        "http://A.Example.org/es/x?y": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://notexample.org/en/12": ("notexample.org", "/en/12", "org/", "allow"),
        "https://x.com/de/#a": ("x.com", "/de/", "com/de/", "block"),
        "https://x.com?/de/": ("x.com", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
    }
    rows = [(k, u, "h", "r") for k, u in enumerate([*urls, None])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    want = [*urls.values(), ("", "", None, "allow")]
    assert [tuple(r)[1:] for r in url_filter.judge(pages).orderBy("page_id").collect()] == want
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_filter_in_several_tries(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a.example.org/es/")], "page_id long, url string")
    monkeypatch.setattr(url_filter, "MOST_RULES", 2)
    assert url_filter.judge(pages).first()["rule"] == "example.org/es/"


def test_license_scan(docs, empty, texts):
    rules = [(a, p, k, re.compile(e, re.ASCII), s) for a, p, k, e, s in license_scan.rules()]
    assert len(rules) > 200
    for r in license_scan.scan(docs).where("doc_id IS NOT NULL").collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[r["doc_id"]] or "").lower())
        places = [i for phrase, _ in license_scan.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        line = " " + " ".join(w) + " "
        found = [(a, p, line[: m.start()].count(" ") - 1, m[0].count(" ")) for a, p, k, e, _ in rules if k in line for m in e.finditer(line)]
        found = [(a, p, low, low + n) for a, p, low, n in found]
        stay = {x[0] for x in found if not any(y[2] <= x[2] and y[3] >= x[3] and (y[1] > x[1] or (y[1] == x[1] and y[3] - y[2] > x[3] - x[2])) for y in found)}
        base = {label for phrase, label in license_scan.BASE if f" {phrase} " in line}
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(places), min(places, default=None), max(places, default=None))
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(base | stay))
        assert 0 <= r["score"] <= 1
    assert license_scan.scan(empty).count() == 0


VECTORS = [
    (0, [1.0, 0.0, 0.5], 1), (1, [1.0, 0.0, 0.5], 1), (2, [2.0, 0.01, 1.0], 1), (3, [0.0, 1.0, 0.0], 1), (4, [1.0, 0.0, 0.5], 2),
    (5, None, 1), (6, [float("nan"), 1.0, 0.0], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 0.0], 1), (9, [1.0, 0.0, 0.5], None),
    (10, [], 1), (None, [1.0, 0.0, 0.5], 1), (11, [3.0], 1), (20, [1.0, 0.1, 0.5], 1), (40, [-1.0, 0.0, 0.2], 3),
]


def test_projection_forest(spark):
    rows = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: tuple(r)[1:] for r in projection_forest.near_duplicates(rows).collect()}
    linked = {0: 3, 1: 3, 2: 3, 20: 3}
    for k in [v[0] for v in VECTORS]:
        assert got[k] == ((linked.get(k, 0), 0, k == 0) if k in linked else (0, k, None if k is None else True))
    assert projection_forest.near_duplicates(rows.limit(0)).count() == 0


def test_voronoi_knn(spark, monkeypatch):
    random = np.random.default_rng(2)
    rows = [(int(k), [float(x) for x in v], 0) for k, v in enumerate(random.standard_normal((150, 6)), 100)] + VECTORS
    whole = {k: [math.floor(64 * x) for x in v] for k, v, _ in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(voronoi_knn, "BLOCK", 40)
    monkeypatch.setattr(voronoi_knn, "CHUNK", 3)
    got = defaultdict(list)
    for r in voronoi_knn.top_inner_products(data.where("vec_id % 20 = 0"), data).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    for q in (k for k in whole if k % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), k) for k, v in whole.items() if k != q)
        assert got[q] == [(n, k, -s) for n, (s, k) in enumerate(scored[:20], 1)]
    assert voronoi_knn.top_inner_products(data.limit(0), data.limit(0)).count() == 0
