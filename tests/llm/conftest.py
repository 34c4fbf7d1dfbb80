import random

import pytest

pytest.importorskip("cartwright.llm")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd: random.Random, n: int) -> str:
    """Invented sentences of n words."""
    syllables = ["an", "ther", "in", "ou", "re", "st", "ed", "ing", "ha", "wh", "or", "ble"]
    words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n)]
    out, start = [], True
    for word in words:
        out.append(word.capitalize() if start else word)
        start = rnd.random() < 0.1
        if start:
            out[-1] += "."
    return " ".join(out)


#: nulls, empty and odd texts, repeated rows and ids, a long text
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "one two three four five"),
    (6, "one two three four five"), (None, "a text without an id that has nine words"),
    (7, "ÄÖÜ ß 中文   \u0001\u0002 é"), (8, "x" * 5000), (9, "word " * 3000),
    (9, "word " * 3000), (-1, "negative id"), (1 << 62, "large id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(d, t, None, None, None) for d, t in ODD], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, texts):
    """Documents with ids from 0."""
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
