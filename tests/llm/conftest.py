import random

import pytest

LONG = "lorem ipsum dolor sit amet " * 6000


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and very long texts, repeated rows, equal texts, and extra columns with clashing names."""
    rows = [(1, "the quick brown fox jumps over the lazy dog and runs far away from here"), (2, None), (3, ""), (4, LONG), (5, "the quick brown fox jumps over the lazy dog and runs far away from here"), (6, "?!"), (6, "?!"), (None, "no id at all"), (7, "É ß 漢 😀 the Straße is long and the way is far"), (8, " \n\t "), (9, "one"), (10, None)]
    names = ["_k1", "_text", "_row", "_h", "sigs", "score", "starts", "node", "n", "ids", "class_id", "_s_upper", "value", "place"]
    return spark.createDataFrame([(*r, *[None if i % 2 else f"x{i}" for i in range(len(names))]) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def prose():
    """A function that makes a text of n words, always the same for the same seed."""

    def make(seed, n, words=400):
        r = random.Random(seed)
        return " ".join(r.choice(["the", "of", "and", "is"]) if r.random() < 0.3 else f"w{r.randrange(words)}" for _ in range(n))

    return make
