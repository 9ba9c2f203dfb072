import random
import re
from math import floor, log

import numpy as np
import pytest

from starloom.llm import treap_search as t

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(t.TERM, (text or "").translate(FOLD))


def brute(docs, items, k=10):
    """Every document scored for every item by the formula."""
    split = [(d, terms(x)) for d, x in docs]
    n_docs, length = sum(1 for _, w in split if w), sum(len(w) for _, w in split)
    df = {}
    for _, w in split:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for i, words in asked.items():
        scores = []
        for d, w in split:
            score = 0
            for x in words & set(w):
                weight = floor(1000 * log((2 * n_docs + 2) / (2 * df[x] + 1)))
                tf, m = w.count(x), 10 + (90 * len(w) * n_docs) // length
                score += weight * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(i, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def texts(corpus):
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "naïve", "日本", "x1", "42", "delta-v", "o'k"] + [f"w{k}" for k in range(60)]
    docs = [(500 + k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for k in range(150)]
    docs += [(900 + k, "alpha beta gamma") for k in range(40)]  # ties
    docs += [(None, "alpha beta gamma"), (None, "w1 w2"), (900, "alpha beta gamma"), (None, None), (7000, "w3 " * 9000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for k in range(25)]
    items += [(100, "ALPHA Beta"), (101, "nowhere"), (102, ""), (103, None), (None, "w1 x1"), (100, "alpha beta"), (100, "w7")]
    return list(corpus) + docs, items


def frames(spark, texts):
    docs = spark.createDataFrame([(*d, 1, "x") for d in texts[0]], "doc_id long, text string, score int, rank string")
    return docs, spark.createDataFrame([(*i, 1) for i in texts[1]], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("block, group", [(1 << 12, 1 << 16), (16, 1 << 16), (7, 20)])
def test_best_documents_as_by_definition(spark, texts, block, group, monkeypatch):
    monkeypatch.setattr(t, "BLOCK", block)
    docs, items = frames(spark, texts)
    got = t.search(docs.repartition(4), items, group_terms=group)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(*texts)


def test_few_and_many_wanted(spark, texts):
    docs, items = frames(spark, texts)
    for k in (1, 300):
        assert sorted((tuple(r) for r in t.search(docs, items, k=k).collect()), key=str) == brute(*texts, k)


def test_nothing_to_search(spark, texts):
    docs, items = frames(spark, texts)
    assert t.search(docs.limit(0), items).count() == 0
    assert t.search(docs, items.limit(0)).count() == 0
    assert t.search(docs, items.where("item_id = 101")).count() == 0


def test_a_treap_holds_its_grid():
    rng = np.random.default_rng(2)
    grid = rng.integers(1, 1000, (32, 32)) * (rng.random((32, 32)) < 0.1)
    rows, columns = np.nonzero(grid)
    treap = t.Treap(rows, columns, grid[rows, columns], 5)
    for row in range(32):
        for column in range(32):
            node = np.zeros(1, np.int64)
            for depth in range(5):
                half = 1 << (4 - depth)
                part = grid[row // (2 * half) * 2 * half :, column // (2 * half) * 2 * half :][: 2 * half, : 2 * half]
                assert node[0] < 0 or treap.best[node[0]] == part.max()
                node = treap.children(node, np.array([row // half % 2]), column // half % 2)
            assert (0 if node[0] < 0 else treap.best[node[0]]) == grid[row, column]


def test_most_cells_are_not_visited(monkeypatch):
    """A walk for one best document looks at few columns of many."""
    rng = np.random.default_rng(3)
    rows = np.repeat(np.arange(64), 200)
    columns = rng.integers(0, 4096, len(rows))
    cells = np.unique(rows * 4096 + columns)
    rows, columns = cells // 4096, cells % 4096
    treap = t.Treap(rows, columns, rng.pareto(1, len(cells)).astype(np.int64) + 1, 12)
    seen = []
    plain = treap.children
    monkeypatch.setattr(treap, "children", lambda n, *a: (seen.append(len(n)), plain(n, *a))[1])
    top = t.descend(treap, np.arange(4), np.ones(4, np.int64), list(range(4096)), [], 1, beam=1)
    assert len(top) == 1 and sum(seen) < 400
