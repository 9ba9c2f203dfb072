import random
import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text, lower=False):
    text = (text or "").translate(LOWER) if lower else (text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w]


@pytest.fixture(scope="session")
def corpus():
    """``(doc_id, text)``: prose, exact and near copies, junk, odd and empty texts."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("aeinorst", k=rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n)).capitalize() + "."

    docs = [prose(rng.randint(1, 160)) for _ in range(60)]
    for base in list(docs[:25]):
        words = base.split()
        for _ in range(rng.randint(0, 3)):  # near copies: some words replaced
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy))
    docs += [docs[3], docs[3].upper(), docs[4] + "  \n"]
    docs += ["\n".join([prose(12)] * 3 + [prose(8), ""]), "a | b | c\nd | e", "été 日本語 🙂 x\t\v\fy"]
    docs += ["", None, "  \n\t ", "one two", "One  TWO", "z" * 40_000, "ha " * 5_000]
    return list(enumerate(docs))


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with a further column, in several partitions."""
    rows = [(k, t, f"tag{k}") for k, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, tag string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, tag string")
