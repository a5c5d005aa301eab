"""License detection by ordered signature rules, as DataFrame functions only.

Texts are lower-cased (A-Z) and cut into words; rules are regular expressions over the words joined by single spaces.
A rule is tried where its own keyword occurs, which each of its matches contains; there is no other filter. Every match is a detection
(label, priority, first and last word). A detection goes if another one of higher priority contains its words, or a
longer one of the same priority; earlier rules have higher priority. What stays gives the labels.

Base phrases are counted apart, and their labels always stay. Null and empty texts have no words and no labels. The work is
row by row: rows without an id and repeated rows are scanned like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, table

#: Detections that a row may have to be compared in place.
MANY = 64

#: (phrase, label) whose places are counted.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Versioned licenses: label, keyword, name, versions. A version may follow the name without a space. Each version gives rules for "or later", "only" and plain mention.
_VERSIONED = (
    ("agpl", " affero ", r"(?:gnu )?affero general public license", ("1 0", "3 0")),
    ("agpl", " agpl", r"(?:gnu )?agpl", ("1 0", "3 0")),
    ("lgpl", " lesser ", r"(?:gnu )?lesser general public license", ("2 1", "3 0")),
    ("lgpl", " library ", r"(?:gnu )?library general public license", ("2 0",)),
    ("lgpl", " lgpl", r"(?:gnu )?lgpl", ("2 0", "2 1", "3 0")),
    ("gpl", " general public license", r"(?:gnu )?general public license", ("1 0", "2 0", "3 0")),
    ("gpl", " gpl", r"(?:gnu )?gpl", ("1 0", "2 0", "3 0")),
    ("gfdl", " free documentation ", r"(?:gnu )?free documentation license", ("1 1", "1 2", "1 3")),
    ("gfdl", " gfdl", r"(?:gnu )?gfdl", ("1 1", "1 2", "1 3")),
    ("apache", " apache ", r"apache (?:software )?license", ("1 0", "1 1", "2 0")),
    ("mpl", " mozilla ", r"mozilla public license", ("1 0", "1 1", "2 0")),
    ("mpl", " mpl", r"mpl", ("1 0", "1 1", "2 0")),
    ("epl", " eclipse ", r"eclipse public license", ("1 0", "2 0")),
    ("epl", " epl", r"epl", ("1 0", "2 0")),
    ("eupl", " european union ", r"european union public licen[cs]e", ("1 0", "1 1", "1 2")),
    ("eupl", " eupl", r"eupl", ("1 0", "1 1", "1 2")),
    ("cddl", " common development ", r"common development and distribution license", ("1 0", "1 1")),
    ("cpl", " common public ", r"common public license", ("1 0",)),
    ("osl", " open software ", r"open software license", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", " academic free ", r"academic free license", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("artistic", " artistic ", r"artistic license", ("1 0", "2 0")),
    ("bsl", " boost ", r"boost software license", ("1 0",)),
    ("busl", " business source ", r"business source license", ("1 1",)),
    ("sspl", " server side ", r"server side public license", ("1 0",)),
    ("ofl", " sil open ", r"sil open font license", ("1 0", "1 1")),
    ("odbl", " open database ", r"open database license", ("1 0",)),
    ("psf", " python software ", r"python software foundation license", ("2 0",)),
    ("php", " php license", r"php license", ("3 0", "3 01")),
    ("zpl", " zope ", r"zope public license", ("1 1", "2 0", "2 1")),
    ("ecl", " educational community ", r"educational community license", ("1 0", "2 0")),
    ("lppl", " latex project ", r"latex project public license", ("1 0", "1 1", "1 2", "1 3")),
    ("cecill", " cecill", r"cecill(?: free software licen[cs]e)?", ("1 0", "1 1", "2 0", "2 1")),
    ("openrail", " openrail", r"openrail(?: m)?(?: license)?", ("1 0",)),
)

# Creative Commons: kinds and versions.
_CC_KINDS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
_CC_NAMES = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative|ative work)?s?"}
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Rules of one kind each: label, keyword, expression, score.
_TEXTS = (
    ("mit", " free of charge ", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 1.0),
    ("isc", " permission to use ", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("bsd-4-clause", " advertising materials ", r"redistribution and use in source and binary forms.{0,600} all advertising materials mentioning features or use of this software", 1.0),
    ("bsd-3-clause", " endorse or promote ", r"redistribution and use in source and binary forms.{0,900} may be used to endorse or promote products", 1.0),
    ("bsd-2-clause", " binary forms ", r"redistribution and use in source and binary forms with or without modification are permitted", 0.9),
    ("zlib", " express or implied ", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", 1.0),
    ("unlicense", " unencumbered ", r"this is free and unencumbered software released into the public domain", 1.0),
    ("wtfpl", " want to public ", r"do what the f\w+ you want to public license", 1.0),
    ("gpl", " free software foundation ", r"terms of the gnu general public license as published by the free software foundation", 0.9),
    ("lgpl", " free software foundation ", r"terms of the gnu lesser general public license as published by the free software foundation", 0.9),
    ("apache-2.0", " apache ", r"you may obtain a copy of the license at (?:https? )?www apache org licenses license 2 0", 1.0),
    ("mpl-2.0", " mozilla ", r"this source code form is subject to the terms of the mozilla public license v 2 0", 1.0),
    ("cc0-1.0", " cc0 ", r"cc0(?: 1 0)?(?: universal)?", 0.9),
    ("cc0-1.0", " public domain dedication ", r"creative commons (?:cc0 )?public domain dedication", 0.9),
    ("bsd-3-clause", " bsd ", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: license)?", 0.9),
    ("bsd-2-clause", " bsd ", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: license)?", 0.9),
    ("bsd", " bsd ", r"bsd(?: style)? license", 0.7),
    ("mit", " mit ", r"(?:the )?mit(?: x11)? license", 0.9),
    ("mit", " expat ", r"expat license", 0.8),
    ("x11", " x11 ", r"x11 license", 0.8),
    ("isc", " isc ", r"isc license", 0.9),
    ("zlib", " zlib ", r"zlib(?: libpng)? license", 0.9),
    ("unlicense", " unlicense ", r"(?:the )?unlicense", 0.8),
    ("wtfpl", " wtfpl ", r"wtfpl", 0.8),
    ("ms-pl", " microsoft public ", r"microsoft public license", 0.9),
    ("ms-rl", " microsoft reciprocal ", r"microsoft reciprocal license", 0.9),
    ("agpl", " affero ", r"(?:gnu )?affero general public license", 0.6),
    ("lgpl", " lesser ", r"(?:gnu )?lesser general public license", 0.6),
    ("gfdl", " free documentation ", r"(?:gnu )?free documentation license", 0.6),
    ("gpl", " general public license ", r"(?:gnu )?general public license", 0.6),
    ("apache", " apache ", r"apache (?:software )?license", 0.6),
    ("mpl", " mozilla ", r"mozilla public license", 0.6),
    ("epl", " eclipse ", r"eclipse public license", 0.6),
    ("cc", " creative commons ", r"creative commons(?: \w+){0,4} license", 0.5),
    ("public-domain", " public domain ", r"(?:in|into|to) the public domain", 0.5),
    ("proprietary", " all rights reserved ", r"all rights reserved", 0.3),
    ("proprietary", " proprietary ", r"proprietary (?:and confidential|license|software)", 0.4),
    ("proprietary", " without permission ", r"(?:may not|not) be (?:copied|reproduced|distributed)(?: \w+){0,8} without permission", 0.4),
)


def rules() -> list[tuple[str, int, str, str, float]]:
    """All rules as (label, priority, keyword, expression, score), in order of priority."""
    found = []
    for label, keyword, name, versions in _VERSIONED:
        for version in versions:
            number, _, minor = version.partition(" ")
            said = rf"{name}(?: version| v)? ?(?:v ?)?{number}" + (rf"(?: {minor})?" if minor == "0" else rf" {minor}")
            short = f"{label}-{version.replace(' ', '.')}"
            found.append((f"{short}-or-later", keyword, rf"{said}(?: of the license)? or (?:at your option )?(?:any )?(?:later|newer|greater)(?: version)?", 1.0))
            found.append((f"{short}-only", keyword, rf"{said} only", 1.0))
            found.append((short, keyword, rf"{said}(?: of the license)?", 0.9))
    for kind in _CC_KINDS:
        named = " ".join(_CC_NAMES[k] for k in kind.split())
        for version in _CC_VERSIONS:
            short = f"cc-{kind.replace(' ', '-')}-{version.replace(' ', '.')}"
            found.append((short, " cc by", rf"cc {kind}(?: version)? {version}", 1.0))
            found.append((short, " creative commons ", rf"creative commons {named}(?: \w+)?(?: license)?(?: version)? {version}", 1.0))
    whole = [t for t in _TEXTS if t[3] == 1.0]
    ordered = whole + found + [t for t in _TEXTS if t[3] < 1.0]
    return [(label, -k, keyword, rf"(?<= )(?:{said})(?= )", score) for k, (label, keyword, said, score) in enumerate(ordered)]


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _base(words: Column, n_words: Column) -> dict[str, Column]:
    """Number, first and last place and labels of the base phrases in the words between spaces."""
    count, firsts, lasts, labels = F.lit(0), [], [], []
    for phrase, label in BASE:
        parts = F.split(words, rf"(?<= ){phrase}(?= )", -1)
        there = F.contains(words, F.lit(f" {phrase} "))
        count = count + F.when(there, F.size(parts) - 1).otherwise(0)
        firsts.append(F.when(there, _spaces(F.element_at(parts, 1)) - 1))
        lasts.append(F.when(there, n_words - _spaces(F.element_at(parts, -1)) + 1 - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    return {"n_base": count, "first_word": F.least(*firsts), "last_word": F.greatest(*lasts), "base": F.array_compact(F.array(*labels))}


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once, however often it is used: a lambda's argument is, while an expression
    inside a lambda is worked out again for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _with_sums_before(numbers: Column, use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """`use(f)` with f(k) the sum of the first k numbers. The numbers are cut into as many stretches as a stretch is long, so
    that n sums take about n to the power 1.5 steps (a slice reads all of the array that it is taken from)."""

    def total(held: Column) -> Column:
        return F.aggregate(held, F.lit(0), lambda a, b: a + b)

    def cut(held: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(held) + 1)).cast("int")
        return _once(step, lambda n: _once(F.struct(n.alias("step"), F.transform(F.sequence(F.lit(0), n), lambda b: F.slice(held, b * n + 1, n)).alias("parts")), summed))

    def summed(held: Column) -> Column:
        return _once(F.transform(held["parts"], total), lambda each: _once(F.transform(each, lambda _, k: total(F.slice(each, F.lit(1), k))), lambda before: done(held, before)))

    def done(held: Column, before: Column) -> Column:
        def sum_before(k: Column) -> Column:
            part = F.floor(k / held["step"]).cast("int")
            return F.get(before, part) + total(F.slice(F.get(held["parts"], part), F.lit(1), k % held["step"]))

        return use(sum_before)

    return _once(numbers, cut)


def _detections(words: Column) -> Column:
    """All matches of all rules whose keyword occurs, as (label, priority, score, low, high) with places in words."""
    by_keyword: dict[str, list[Column]] = {}
    for a, p, k, e, s in rules():
        by_keyword.setdefault(k, []).append(F.struct(F.lit(a).alias("label"), F.lit(p).alias("priority"), F.lit(e).alias("said"), F.lit(s).alias("score")))
    listed = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*own).alias("rules")) for k, own in by_keyword.items()])

    def places(rule: Column) -> Column:
        between = F.transform(F.split(words, rule["said"], -1), _spaces)
        matched = F.transform(F.regexp_extract_all(words, rule["said"], F.lit(0)), _spaces)

        def detections(parts: Column) -> Column:
            def detection(size: Column, k: Column, before: Column) -> Column:
                low = before + F.get(parts["between"], k) - 1
                return F.struct(rule["label"].alias("label"), rule["priority"].alias("priority"), rule["score"].alias("score"), low.alias("low"), (low + size).alias("high"))

            steps = F.zip_with(F.slice(parts["between"], F.lit(1), F.size(parts["matched"])), parts["matched"], lambda a, b: a + b)
            return _with_sums_before(steps, lambda sums: F.transform(parts["matched"], lambda size, k: detection(size, k, sums(k))))

        return _once(F.struct(between.alias("between"), matched.alias("matched")), detections)

    # the keyword is looked for once for all of its rules
    tried = F.flatten(F.transform(F.filter(listed, lambda g: F.contains(words, g["keyword"])), lambda g: g["rules"]))
    return F.flatten(F.transform(tried, places))


def _beats(y, x) -> Column:
    """Whether detection y contains x and ranks before it; of one rank the longer one does."""
    longer = (y["high"] - y["low"]) > (x["high"] - x["low"])
    return (y["low"] <= x["low"]) & (y["high"] >= x["high"]) & ((y["priority"] > x["priority"]) | ((y["priority"] == x["priority"]) & longer))


def _standing(found: Column) -> Column:
    """Detections that no better one contains, for a row with few."""
    return F.filter(found, lambda x: ~F.exists(found, lambda y: _beats(y, x)))


def _standing_of_many(found: DataFrame) -> DataFrame:
    """The same for rows (row, found) with any number: row, label, score and detection of each that stands.

    No detection of a row is longer than its longest, so what can contain one starts in the same stretch of that many
    words or in the one before. Only detections of those stretches meet, by an equi-join.
    """
    longest = F.aggregate("found", F.lit(1), lambda a, x: F.greatest(a, x["high"] - x["low"]))
    # in a step of its own: next to the explode it would be worked out for every detection
    each = found.select("row", "found", longest.alias("reach")).select("row", "reach", F.explode("found").alias("x"))
    each = each.withColumn("stretch", F.floor(F.col("x.low") / F.col("reach")))
    near = each.select(F.col("row").alias("of"), F.explode(F.array("stretch", F.col("stretch") + 1)).alias("at"), F.col("x").alias("y"))
    beaten = (each["row"] == near["of"]) & (each["stretch"] == near["at"]) & _beats(near["y"], each["x"])
    return each.join(near, beaten, "left_anti").select("row", F.col("x.label").alias("label"), F.col("x.score").alias("score"), F.col("x").alias("detection"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the base columns, labels, score and the standing detections of each row (doc_id, text).

    Rows with more than `MANY` detections are told apart from the others once these are stored, and compared by stretches
    of words, so the work of a long text grows little faster than the text.
    """
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    lowered = F.translate(F.coalesce("text", F.lit("")), upper, lower)
    joined = F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat(F.lit(" "), F.trim(joined), F.lit(" ")).alias("words"))
    rows = rows.withColumn("n_words", F.when(F.col("words") == "  ", 0).otherwise(_spaces(F.col("words")) - 1).cast("long"))
    rows = rows.select("doc_id", "n_words", "words", *[c.alias(n) for n, c in _base(F.col("words"), F.col("n_words")).items()])
    rows = rows.withColumn("found", _detections(F.col("words"))).drop("words").withColumn("row", F.monotonically_increasing_id())
    rows = stage(rows, "detections")

    few = rows.where(F.size("found") <= MANY).withColumn("found", _standing(F.col("found")))
    few = few.withColumns({"own": F.transform("found", lambda x: x["label"]), "best": F.aggregate("found", F.lit(0.0), lambda a, x: F.greatest(a, x["score"]))})
    many = rows.where(F.size("found") > MANY)
    stand = _standing_of_many(many.select("row", "found")).groupBy("row")
    stand = stand.agg(F.collect_set("label").alias("own"), F.max("score").alias("best"), F.collect_list("detection").alias("found"))
    rows = few.unionByName(many.drop("found").join(stand, "row"))
    return rows.select(
        "doc_id",
        "n_words",
        F.col("n_base").cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", "own"))), ",").alias("labels"),
        F.greatest("best", F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
        F.col("found").alias("detections"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("detections")
