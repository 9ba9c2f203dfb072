import itertools

import numpy as np
import pytest

from starloom.llm import near_dedup
from starloom.llm.components import components
from tests.llm.conftest import split_words


def brute(rows):
    sets = {}
    for k, t in rows:
        w = split_words(t, lower=True)
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
        sets[k] = frozenset(runs)
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_components_as_brute_force_finds_them(docs, corpus):
    out = near_dedup.near_duplicates(docs)
    assert found(out) == brute(corpus)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_copies_that_are_all_a_little_too_far_from_the_first(spark):
    """Links between members none of which is the bucket's centre."""
    base = [f"w{i}" for i in range(80)]
    rows = []
    for k in range(60):
        copy = list(base)
        for j in range(3):
            copy[(7 * (k // 2) + 23 * j) % 80] = f"x{k // 2}.{j}"  # pairs of equal edits
        if k % 2:
            copy[-1] = f"y{k}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert 2 <= len({c for _, c in want.values()}) < 60
    assert found(near_dedup.near_duplicates(df)) == want


def test_a_large_component_is_not_paired_off_for_an_outsider(spark, monkeypatch):
    """Many near copies in one component, and texts a little too far from all but a few."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(400):
        copy = list(base)
        copy[k % 200] = f"x{k}"  # two such copies share over 94 of 100 shingles
        rows.append((k, " ".join(copy)))
    for k in range(400, 404):  # outsiders: five and six edits
        copy = list(base)
        for j in range(5 + k % 2):
            copy[(31 * j + k) % 200] = f"y{k}.{j}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    met, searched = [], near_dedup._meetings
    monkeypatch.setattr(near_dedup, "_meetings", lambda prefix: met.append(prefix) or searched(prefix))
    want = brute(rows)
    assert found(near_dedup.near_duplicates(df)) == want
    assert len({c for _, c in want.values()}) > 1
    (prefix,) = met
    pairs = searched(prefix)
    of = {
        (r.s, r.component, r.n): r["count"]
        for r in prefix.groupBy("s", "component", "n").count().collect()
    }
    joined = sum(of[r.s, r.c_a, r.n_a] * of[r.s, r.c_b, r.n_b] for r in pairs.collect())
    every = sum(r["count"] ** 2 for r in prefix.groupBy("s").count().collect())
    assert joined <= every / 10


def test_meetings_of_outsiders_stand_for_pairs_that_may_be_linked(spark):
    rng = np.random.default_rng(3)
    held = [
        (node, node // 7 if node < 70 else node, int(n), int(place), int(s))
        for node in range(200)
        for n in [rng.integers(40, 60)]
        for place, s in enumerate(rng.permutation(30)[:9], 1)
    ]
    prefix = spark.createDataFrame(held, "node long, component long, n int, place int, s long")
    got = {tuple(r) for r in near_dedup._meetings(prefix).collect()}
    want = set()
    for _, c, n, at, s in held:
        for _, d, m, to, t in held:
            need = -(-85 * (n + m) // 185)
            if s == t and (n < m and c != d or n == m and c < d) and 100 * n >= 85 * m:
                if at <= n - need + 1 and to <= m - need + 1:
                    want.add((s, c, n, d, m))
    assert got == want and got


def test_rows_without_id_repeated_rows_and_no_rows(spark, no_docs):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = near_dedup.near_duplicates(df)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, 2, 1, True)] * 2 + [(2, 2, 1, False), (3, 0, 3, True), (None, 2, None, True)], key=str
    )
    assert sorted(str(r.doc_id) for r in near_dedup.keep_one(df).collect()) == ["1", "1", "3", "None"]
    assert near_dedup.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 5, 40, 2000])
def test_signatures_agree_as_often_as_sets_are_similar(n):
    rng = np.random.default_rng(n)
    rates = []
    for _ in range(30):
        pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        a, b = np.unique(pool[: 2 * n - n // 3]), np.unique(pool[n // 3 :])
        rates.append((near_dedup.signature(a) == near_dedup.signature(b)).mean())
    jaccard = (2 * n - 2 * (n // 3)) / (2 * n)
    assert abs(np.mean(rates) - jaccard) < 0.08


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 110)] + [(7, 7), (None, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 110)}
    assert components(df.where("a < 0")).count() == 0
