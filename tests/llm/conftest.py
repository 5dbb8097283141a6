import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, print string, score double"
WORDS = [a + b for a in "ba ke li mo nu pa re si to vu".split() for b in "n r s t x z".split()]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def corpus_rows():
    """Texts with copies, near copies, shared lines and passages, and odd rows; columns that clash."""
    rng = random.Random(5)
    shared = [sentence(rng, 30) for _ in range(3)]
    line = "This line stands in many documents: " + sentence(rng, 6)
    texts = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(5, 60)) for _ in range(3)]
        if i % 4 == 0:
            parts.insert(1, shared[i % 3])
        if i % 5 == 0:
            parts.append("  " + (line.upper() if i % 2 else line) + "\t")
        texts.append("\n".join(parts))
    texts += [texts[3]] * 3
    texts += [texts[7].replace(" ", " x ", 1), texts[8] + " end"]
    texts += [None, "", " \n\t", "é", "word " * 60, ". . .", sentence(rng, 6000) + "\n" + shared[0]]
    rows = [(i, t, ("en", "fr", None)[i % 3], (None, "b", "a", "c")[i % 4], 0, "x", 1.0) for i, t in enumerate(texts)]
    rows += [rows[3], (None, texts[4], "en", "a", 0, None, None), (None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def corpus(spark, corpus_rows):
    return spark.createDataFrame(corpus_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
