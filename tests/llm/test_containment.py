import random
import re

import pytest

from starloom.llm import decontaminate, licenses


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {("=", *w)} if w else set()


def brute(docs, items):
    out = set()
    for d, text in docs:
        have = shingles(text)
        for i, item in items:
            q = shingles(item)
            if q and 100 * len(have & q) >= 80 * len(q):
                out.add((d, i, len(have & q), len(q)))
    return out


@pytest.fixture(scope="module")
def items(corpus):
    """Passages of documents, whole and with edits, short ones, repeats, empties."""
    texts = [t for _, t in corpus if t and 60 < len(t.split()) < 200]
    out = [" ".join(t.split()[k : k + n]) for k, (t, n) in enumerate(zip(texts, (5, 6, 8, 9, 12, 15, 25, 40) * 9, strict=False))]
    out += [re.sub(r"^\S+", "changed", x) for x in out] + [x + " and more words" for x in out]
    out += [x.replace(" ", ", ").upper() for x in out[:5]] + ["one two", "ha ha ha ha ha ha ha ha ha ha", "", None, "!?"]
    return list(enumerate(out))


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_leaks_as_brute_force_finds_them(spark, docs, corpus, items, limit):
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    got = decontaminate.leaks(docs, benchmark, broadcast_bytes=limit)
    assert {tuple(r) for r in got.collect()} == brute(corpus, items)
    assert got.count() == len(brute(corpus, items)) > 40


def test_documents_with_leaks_go(spark, docs, corpus, items, no_docs):
    benchmark = spark.createDataFrame(items[:9], "item_id long, text string")
    gone = {d for d, *_ in brute(corpus, items[:9])}
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in corpus} - gone
    nothing = benchmark.where("item_id < 0")
    assert decontaminate.leaks(docs, nothing).count() == 0
    assert decontaminate.leaks(no_docs, benchmark).count() == 0


def test_licences_in_documents(spark, corpus):
    templates = list(licenses.TEMPLATES)
    texts = [(f"{a} " * (k % 3) + t + f" {b}", k) for k, (_, t) in enumerate(templates) for a, b in [("lorem", "ipsum")]]
    texts += [("no licence here at all", 100), (None, 101), ("", 102)]
    long = templates[2][1].split()
    long[10] = "EDITED"
    texts += [(" ".join(long), 103), (" ".join(long[:12]), 104)]
    df = spark.createDataFrame(texts, "text string, doc_id long")
    got = {(r.doc_id, r.license) for r in licenses.license_hits(df, licenses.template_table(spark)).collect()}
    want = {(d, name) for d, _, t in [(k, 0, t) for t, k in texts] for name, x in templates if brute([(d, t)], [(0, x)])}
    assert got == want and (103, "MIT") in got and (104, "MIT") not in got


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_scattered_items_are_found(spark, limit):
    """Exactly four fifths of an item's shingles, each alone somewhere in a text."""
    rng = random.Random(11)
    items, docs = [], []
    for size in (1, 2, 4, 5, 6, 8, 10, 12, 15, 20, 40, 60):
        for k in range(6):
            w = [f"w{size}x{k}x{i}" for i in range(size + 4)]
            number = len(items)
            items.append((number, " ".join(w)))
            runs = [w[i : i + 5] for i in range(size)]
            rng.shuffle(runs)
            for share in (-(-size * 4 // 5), -(-size * 4 // 5) - 1):
                parts = [" ".join(run) for run in runs[:share]]
                filler = [" ".join(f"f{rng.random()}" for _ in range(rng.randint(1, 9))) for _ in parts]
                docs.append((len(docs), " ".join(x for pair in zip(parts, filler, strict=True) for x in pair)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontaminate.leaks(df, benchmark, broadcast_bytes=limit).collect()}
    assert got == brute(docs, items) and len(got) == len(items)
