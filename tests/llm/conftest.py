"""Small documents for the corpus operators. Session and scale come from the tests above."""

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame of documents from ``(doc_id, text)`` or ``(doc_id, text, source)``."""

    def make(rows):
        full = [(i, t, "en", (more[0] if more else "src0"), len(t or "")) for i, t, *more in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


def prose(seed, words=80):
    random.seed(seed)
    parts = ["the", "of", "th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es"]
    return " ".join("".join(random.choices(parts, k=random.randint(1, 4))) for _ in range(words)) + "."


@pytest.fixture(scope="session")
def text_of():
    return prose
