import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node long, llm_row int"


def sentence(rng, n):
    return " ".join(rng.choice("abcdefgh") * 2 + rng.choice("nopqrst") + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, copies, near copies, repeated rows."""
    rng = random.Random(5)
    base = sentence(rng, 120).split()
    near = list(base)
    near[60] = "changed"
    far = list(base)
    for i in range(0, 120, 6):
        far[i] = "other"
    texts = [
        None, "", "   \n\t ", "one two", "one two", " ".join(base), " ".join(base),
        " ".join(near), " ".join(far), sentence(rng, 60), sentence(rng, 3000),
        "x" * 5000, "the the " * 200, "line of words here\n" * 50, "Ünï cödé ß \x1c\x85 a\u2028b",
    ]
    rows = [(i, t, "en", None, None, "k", 1, 2) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, "no id " + sentence(rng, 70), None, "s", 3, None, None, None)]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
