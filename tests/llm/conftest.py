import random

import pytest

from siteweave.llm.common import prepare


@pytest.fixture(scope="session")
def llm(spark):
    """A session with the settings of the operators; texts travel in small batches."""
    prepare(spark)
    return spark


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(llm):
    """Documents from texts, or from (id, text) or (id, text, source) rows."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            row = (i, row) if not isinstance(row, tuple) else row
            id_, text, source = (*row, "s")[:3]
            full.append((id_, text, "en", source, len(text or "")))
        return llm.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def prose():
    """prose(seed, n): n words that hardly repeat."""

    def make(seed, n, pool=4000):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(pool)}" for _ in range(n))

    return make
