import random

import pytest


@pytest.fixture(scope="session")
def texts(spark):
    """Rows ``doc_id, text`` with copies, near copies, runs, blanks, nulls and a long text."""
    rng = random.Random(7)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a" * 5000), (4, "ab" * 400 + "x" * 300), (5, "the cat " * 200), (6, "é" * 150), (7, "A b"),
            (8, "a B"), (9, "q" * 199), (10, "q" * 200), (11, "q" * 200), (12, " ".join(rng.choice("abc") for _ in range(20000)))]
    words = [f"w{i}" for i in range(2000)]
    bases = [[rng.choice(words) for _ in range(n)] for n in (30, 120, 400)]
    for i in range(13, 80):
        words_of = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 1 + len(words_of) // 15)):
            words_of[rng.randrange(len(words_of))] = rng.choice(words)
        rows.append((i, " ".join(words_of)))
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(texts, "doc_id bigint, text string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
