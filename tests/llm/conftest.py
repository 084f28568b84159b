import random

import pytest
from llm_data import make_docs, words


@pytest.fixture(scope="session")
def odd_rows():
    """NULL, empty and blank texts, NULL and repeated ids, equal and near texts, a very long text."""
    r = random.Random(5)
    base = words(r, 120)
    near = base.split()
    near[60] = "changed"
    passage = words(r, 40)
    return [
        (1, None),
        (2, ""),
        (3, "  \n\t "),
        (4, base),
        (5, base),
        (6, base.upper()),
        (7, " ".join(near)),
        (8, "short text"),
        (9, "Short  text"),
        (10, words(r, 60) + " " + passage + " " + words(r, 30)),
        (11, passage + " " + words(r, 50)),
        (12, words(r, 30_000, 10**9)),
        (13, "aé中😀" * 30),
        (14, "x" + "aé中😀" * 30),
        (15, "a" * 300),
        (16, "a" * 120),
        (4, base),
        (8, "another text under the same id"),
        (None, base),
        (None, words(r, 20)),
    ]


@pytest.fixture()
def odd_docs(spark, odd_rows):
    return make_docs(spark, odd_rows)


@pytest.fixture()
def no_docs(spark):
    return make_docs(spark, [(1, "a")]).limit(0)
