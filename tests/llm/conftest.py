import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, schema=DOCS):
        """rows: (doc_id, text[, lang[, source]])."""
        full = [(r + (None,) * 4)[:4] + (len(r[1] or ""),) for r in rows]
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]

    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choices(vocab, k=n))
    return make
