import random

import pytest

from tallyline.llm.store import package_for_workers

WORDS = "the of and stone river light carry window garden paper silver morning letter bridge number quiet".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, id long, digest string, taken long, kept string, version int"
)


@pytest.fixture(autouse=True)
def workers(spark):
    package_for_workers(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source); the other columns clash with names used inside the operators."""

    def make(rows):
        rows = [(*r, *(None,) * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(i, t, k, s, len(t) if t else None, "x", 7, "y", 1, "z", 3) for i, t, k, s in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random text of n words."""
    draw = random.Random(5)
    return lambda n: " ".join(draw.choice(WORDS) + draw.choice(("", "", "er", "ing", "ly")) + str(draw.randint(0, 9)) * draw.randint(0, 1) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls in every column, empty and very long texts, texts without words, repeated rows, one id twice, ids null."""
    long = prose(30_000)
    return [
        (None, None), (None, None, None, None), (1, None, "en", "a"), (2, "", "en", "a"), (2, "", "en", "a"), (3, " ., !\n", "de", None),
        (4, long, "en", "a"), (5, long + " end", "en", "b"), (None, "word one two three four five", "en", None),
        (None, "word one two three four five", "en", None), (6, "short", None, "b"), (6, "another text under the same id", "en", "b"),
        (7, "Éaé \U0001f600 ßx", "fr", "é"), (8, "tie", "en", "c"), (8, "tie", "en", "c"),
    ]
