"""Vector codes, k-d shards and the divergence audit against plain versions."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelyard.llm import ball_codes, kd_shards, level_products, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df, cursor = queries.QUERIES[name](spark, FOLDER), con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(cursor.fetchall())


# ---- vector codes ----


def plain_codes(rows, parts, entries, rounds):
    """Codes by comparing with every entry."""
    whole = [(k, [max(-(1 << 24), min(1 << 24, math.floor(1024 * x))) for x in v], label) for k, v, label in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in whole), default=0) // parts)
    cut = [[(v + [0] * (parts * width))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for c in cut:
            for p in range(parts):
                members[p, nearest(p, c[p])[1]].append(c[p])
        for (p, e), held in members.items():
            books[p][e] = [sum(x) // len(held) for x in zip(*held)]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    return books, [(k, label, [e for _, e in f], [d for d, _ in f]) for (k, _, label), f in zip(whole, found)]


def vectors(seed, n, width, spread=1.0):
    pick = np.random.default_rng(seed)
    centres = pick.standard_normal((6, width))
    return [(int(k), [float(x) for x in spread * (centres[k % 6] + 0.05 * pick.standard_normal(width))], [None, 1, 2][k % 3]) for k in pick.permutation(n)]


EDGES = [
    (500, None, 1), (501, [float("nan")] * 8, 1), (502, [1.0, None], 1), (503, [float("inf")], 1), (504, [], 2), (505, [0.5], 2),
    (None, [0.1] * 8, None), (3, [0.25] * 8, 1), (3, [0.25] * 8, 1), (506, [-1e30, 1e30] * 4, None), (507, [2.0] * 9, 2),
]


@pytest.mark.parametrize("rows", [vectors(1, 120, 8), vectors(2, 90, 8, 3000.0) + EDGES, [(1, [0.5] * 4, 1)] * 9 + [(0, [0.25] * 4, 1)]])
def test_codes_equal_comparing_with_every_entry(spark, rows):
    data = spark.createDataFrame([(*r, "x", 7) for r in rows], "vec_id long, embedding array<double>, label int, part string, codes int")
    books, coded = ball_codes.fit_and_encode(data.repartition(3), 4, 10, 3)
    want_books, want = plain_codes(rows, 4, 10, 3)
    assert [b.tolist() for b in books] == want_books
    got = [(r["vec_id"], r["label"], r["codes"], r["distances"]) for r in coded.collect()]
    assert Counter(map(str, got)) == Counter(map(str, want))


def test_codes_of_nothing(spark):
    data = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<double>, label int")
    for rows in (data, data.limit(0)):
        assert ball_codes.fit_and_encode(rows)[1].count() == 0


def test_stable_cores_need_no_comparison(monkeypatch):
    """Parts well inside their ball are done without a distance to any rival, and ties go to the lower entry."""
    book = ball_codes.Codebook(np.array([[0, 0], [1000, 0], [0, 1000], [0, 0]]))
    asked = []
    plain = ball_codes.Codebook._distances
    monkeypatch.setattr(ball_codes.Codebook, "_distances", lambda self, parts, rivals: asked.append(len(rivals)) or plain(self, parts, rivals))
    codes, best = book.nearest(np.array([[990, 5], [5, 990]]), np.array([1, 2]))
    assert codes.tolist() == [1, 2] and not asked
    codes, best = book.nearest(np.array([[1, 1], [500, 0], [501, 0]]), np.array([3, 1, 0]))
    assert codes.tolist() == [0, 0, 1] and best.tolist() == [2, 250000, 249001]
    alone = ball_codes.Codebook(np.zeros((1, 0), np.int64))
    assert alone.nearest(np.zeros((2, 0), np.int64), np.zeros(2, np.int64))[0].tolist() == [0, 0]


def test_guesses_do_not_matter():
    pick = np.random.default_rng(4)
    for scale in (40, 1 << 24):
        entries, parts = pick.integers(-scale, scale, (60, 3)), pick.integers(-scale, scale, (500, 3))
        distance = ((parts[:, None] - entries[None]) ** 2).sum(2)
        book = ball_codes.Codebook(entries)
        for guess in (np.zeros(500, np.int64), pick.integers(0, 60, 500), distance.argmin(1)):
            codes, best = book.nearest(parts, guess)
            assert (codes == distance.argmin(1)).all() and (best == distance.min(1)).all()


def test_hex_and_digest(spark):
    row = spark.createDataFrame([([0, 15, 255, 16],)], "codes array<int>").select(ball_codes.hex_code("codes")).first()[0]
    assert row == "000fff10"
    assert ball_codes.codebook_digest([np.array([[1, -2]]), np.array([[3, 4]])]) == hashlib.sha256(b"1,-2,3,4").hexdigest()


# ---- k-d shards ----


def plain_shards(rows, shards):
    """Rows (doc_id, size, crc, coordinates) to (shard, slot), by sorting each node whole."""
    whole = [max(c) - min(c) for c in zip(*[r[3] for r in rows])] if rows else []
    out = []

    def order(r):
        return (r[0] is not None, r[0] or 0, r[2], r[1])

    def split(held, first, k):
        if k == 1 or not held:
            out.extend((*r[:3], first, slot) for slot, r in enumerate(sorted(held, key=order)))
            return
        widths = [(max(c) - min(c)) / w if w else 0.0 for c, w in zip(zip(*[r[3] for r in held]), whole)]
        dim, half = widths.index(max(widths)), k // 2
        held = sorted(held, key=lambda r: (r[3][dim], order(r)))
        total, left, right, before = sum(r[1] for r in held), [], [], 0
        for r in held:
            (left if (2 * before + r[1]) * k <= 2 * total * half else right).append(r)
            before += r[1]
        over = sum(r[1] for r in left) * k - total * half
        giver, taker = (left, right) if over > 0 else (right, left)
        fitting = [r for r in giver if r[1] * k < 2 * abs(over)]
        if fitting:
            moved = min(fitting, key=lambda r: (abs(r[1] * k - abs(over)), order(r)))
            giver.remove(moved)
            taker.append(moved)
        split(left, first, half)
        split(right, first + half, k - half)

    split(rows, 0, shards)
    return Counter(out)


def kd_rows(docs):
    def number(text):
        return -1 if text is None else int.from_bytes(text.encode()[:7].ljust(7, b"\0"), "big")

    made = []
    for doc_id, text, lang, source, n_chars in docs:
        data = (text or "").encode()
        made.append((doc_id, len(data) + 1, zlib.crc32(data), (number(lang), number(source), -1 if n_chars is None else n_chars, -1 if doc_id is None else doc_id)))
    return made


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shard_docs(seed, n, hot):
    """Documents of one hot source and language, one hot repeated row, nulls, and a text larger than a shard."""
    pick = random.Random(seed)
    rows = [(k, "é" * pick.randint(0, 60), *(("en", "web") if pick.random() < hot else (pick.choice(["de", None, ""]), pick.choice(["a", "b", None]))), k % 9) for k in range(n)]
    return rows + [(7, "same", "en", "web", 4)] * (n // 3) + [(None, None, None, None, None), (None, "x" * 3000, "en", "web", 1)]


@pytest.mark.parametrize("shards", [16, 5, 1])
def test_shards_equal_the_plain_tree(spark, shards):
    rows = shard_docs(3, 150, 0.5)
    docs = spark.createDataFrame([(*r, "node", 1.5) for r in rows], DOCS + ", node string, size double").repartition(5)
    placed = kd_shards.place(kd_shards.metadata(docs), shards).collect()
    got = Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in placed)
    assert got == plain_shards(kd_rows(rows), shards)


def test_leaves_are_even_and_slots_gapless(spark):
    rows = shard_docs(5, 900, 0.9)[:-1]
    placed = kd_shards.place(kd_shards.metadata(spark.createDataFrame(rows, DOCS))).toPandas()
    sizes = placed.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 0.02 * sizes.mean()
    for _, slots in placed.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_target_bytes_and_files(spark, tmp_path):
    rows = shard_docs(8, 100, 0.3)
    docs = spark.createDataFrame([(*r, 9) for r in rows], DOCS + ", __slot int")
    path = str(tmp_path / "shards")
    kd_shards.write_shards(docs, path, shards=None, target_bytes=2000)
    back = spark.read.parquet(path)
    assert back.select("__shard").distinct().count() == -(-sum(len((r[1] or "").encode()) + 1 for r in rows) // 2000)
    assert Counter(map(tuple, back.select("doc_id", "text", "lang", "source", "n_chars").collect())) == Counter(rows)
    assert kd_shards.place(kd_shards.metadata(docs.limit(0))).count() == 0


# ---- divergence audit ----


def plain_audit(rows, least, top):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))) for lang, source, text in rows]
    held, counts, groups = Counter(), Counter(), {(a, b) for a, b, _ in words}
    for lang, source, found in words:
        held.update((lang, w) for w in set(found))
        counts.update((lang, source, w) for w in found)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [w for (a, w), n in held.items() if a == lang and n >= least]
        sources = sorted(s for a, s in groups if a == lang)
        numbers = {s: [counts[lang, s, w] for w in kept] for s in sources}
        share = {s: [1 + 10**9 * (c + 5) // (sum(n) + 5 * len(kept)) for c in n] for s, n in numbers.items()}
        all_of = [sum(n[k] for n in numbers.values()) for k in range(len(kept))]
        lang_share = [1 + 10**9 * (c + 5) // (sum(all_of) + 5 * len(kept)) for c in all_of]
        for s in sources:
            pairs = [(sum(abs(p - q) for p, q in zip(share[s], share[o])), o) for o in sources if o != s]
            terms = [(p - q, w) for w, c, p, q in zip(kept, numbers[s], share[s], lang_share) if c and p > q]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1) if part == "pair" or rank <= top}
    return out


def audit_rows(seed):
    pick = random.Random(seed)
    words = ["Apple", "pear", "Über", "naïve", "ÉTÉ", "a", "zoo", "x1y", "été"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for k in range(160):
        lang = pick.choice(["en", "en", "de", None])
        source = "hot" if pick.random() < 0.4 else pick.choice(["a", "b", "ä", "", None, "z9"])
        rows.append((lang, source, " ".join(pick.choices(words, [1 / (i + 1) for i in range(len(words))], k=pick.randint(0, 40)))))
    return rows + [("xx", "only", "rare words"), ("xx", "other", None), ("en", "silent", "12 34 -"), ("en", "hot", "word," * 3000), rows[0], rows[0]]


def test_audit_equals_the_plain_version(spark, monkeypatch):
    rows = audit_rows(6)
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "lang string, source string, text string, term string, count int").repartition(3)
    want = plain_audit(rows, 12, 6)
    assert {tuple(r) for r in level_products.audit(docs, 12, 6).collect()} == want
    # many blocks of terms and groups, short stretches, many hand-overs, texts cut in pieces
    for name, value in (("TERMS", 3), ("GROUPS", 2), ("COLUMNS", 12), ("HELD", 20), ("STEP", 16)):
        monkeypatch.setattr(level_products, name, value)
    got = level_products.audit(docs, 12, 6).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([("en", "a", None), ("en", None, "")], "lang string, source string, text string")
    assert {tuple(r) for r in level_products.audit(docs).collect()} == {("en", "a", "pair", "", 0, 1), ("en", "", "pair", "a", 0, 1)}
    assert level_products.audit(docs.limit(0)).count() == 0


def test_shares_are_exact():
    for count, total, terms in ((0, 0, 1), (9 * 10**12, 9 * 10**12, 1), (7, 10**13, 10**7), (123456789, 987654321, 54321)):
        assert level_products._shares(np.array([count]), total, terms)[0] == 1 + 10**9 * (count + 5) // (total + 5 * terms)
