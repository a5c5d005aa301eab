import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, words string"


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, a shared passage, nulls, empties and one very long text."""
    pick = random.Random(5)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "tu") for b in ("ren", "sol", "dax") for c in ("a", "e", "o", "is")]

    def prose(n):
        return " ".join(pick.choice(words) + pick.choice(["", "", ",", "."]) for _ in range(n))

    base, passage = prose(200), prose(90)
    near = base.split()
    near[20] = near[150] = "changed"
    made = [base, base, " ".join(near), prose(40) + " " + passage + " " + prose(30), prose(60) + "\n" + passage, None, "", "one", "a b c", "A  B\tc"]
    made += [prose(300), prose(9000), "Released under the MIT License. See the Apache License, Version 2.0 and the mit license.", "é ü ñ " * 300]
    return made


@pytest.fixture
def docs(spark, texts):
    rows = [(k, t, "en", [None, "b", "a"][k % 3], len(t or ""), 1, "x") for k, t in enumerate(texts)]
    rows += [(None, texts[0], None, None, None, None, None), rows[1]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
