import random

import pytest

ALPHABET = "the of and to in ing ed on er at es or re st en an ti nd th ha".split()


@pytest.fixture
def words():
    """A function that makes texts of invented words, the same for a seed."""

    def make(seed: int, n: int, size: int = 3) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, size))) for _ in range(n))

    return make


@pytest.fixture
def table(spark):
    """A function that makes a DataFrame of documents; a further column has the name of an internal one."""

    def make(rows, schema="doc_id long, text string, lang string, source string, cls string, n string"):
        width = schema.count(",") + 1
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)

    return make


HOSTILE = [
    (1, None, None, None, "x", "y"),
    (2, "", "en", None, "x", "y"),
    (2, "", "en", None, "x", "y"),
    (None, "some words without an id at all", None, "", "x", "y"),
    (3, " \n\t \x0b\x0c\r ", "en", "a", None, None),
    (4, "word", None, "a", None, None),
    (-5, "é" * 3000 + " ß́ \U0001f600 " + "x" * 70000, "de", "a", None, None),
    (6, "a b c d e f g h " * 4000, "en", "b", None, None),
    (7, "mail me at a.b@c.example or +1 (212) 555-0101, 10.0.0.1", "en", "b", None, None),
]


@pytest.fixture
def hostile(table):
    return table(HOSTILE)
