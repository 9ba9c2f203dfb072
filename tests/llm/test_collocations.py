import random
import re
from collections import Counter

import numpy as np
import pytest

from starloom.llm import collocations as c


def brute(rows, least=10, top=2000):
    """Everything by definition, on Python strings and integers."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            totals[lang] += len(w)
            for n in (1, 2, 3):
                counts.update((lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    found = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= least}
    out = []
    for (lang, p), a in found.items():
        if any(
            g == lang and len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(2))
            for (g, q), b in found.items()
        ):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, totals[lang], score))
    ranked = set()
    for lang in totals:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked |= {(r[0], k, *r[1:]) for k, r in enumerate(own[:top], 1)}
    return ranked


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["new", "York", "ção", "x", "the", "of", "日本", "a" * 300, "it's", "UP", "É"]
    out = []
    for k in range(160):
        text = ""
        for _ in range(rng.choice((0, 3, 40, 90))):
            text += rng.choice(words) + rng.choice((" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"))
        out.append((text, rng.choice(("en", "en", "de", None, "und", ""))))
    out += [("new york city " * 30, "en"), ("new york. city " * 9, "en")] * 2
    return out + [(None, "en"), ("", None), (" ,.\n", "xx"), ("one two", "once")]


@pytest.mark.parametrize("bits", [64, 9])
def test_all_phrases_as_by_definition(spark, rows, bits):
    """With fingerprints of nine bits nearly all phrases collide; nothing changes."""
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "text string, lang string, phrase int, words string")
    got = c.collocations(df.repartition(5), bits=bits)
    want = brute(rows)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want) > 100


def test_top_and_least(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string")
    got = {tuple(r) for r in c.collocations(df, least=4, top=7).collect()}
    assert got == brute(rows, 4, 7)


def test_no_rows(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert c.collocations(none).count() == 0
    assert c.collocations(spark.createDataFrame([(None, None)], none.schema)).count() == 0


def test_filled_filter_loses_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(c, "FILTER_WORDS", 2)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert {tuple(r) for r in c.collocations(df).collect()} == brute(rows)


def test_ranges_and_flushes(rows, monkeypatch):
    """Few n-grams at a time, many ranges: the sums are those of one go."""
    import pyarrow as pa

    monkeypatch.setattr(c, "TASK_GRAMS", 50)
    batch = pa.RecordBatch.from_pydict({"text": [r[0] or "" for r in rows], "lang": [r[1] or "" for r in rows]})
    sums = Counter()
    for part in c._sketch(iter([batch]), 13, 64):
        for k, data in zip(part["range"].to_pylist(), part["grams"].to_pylist(), strict=True):
            prints, counts = c.unpack(data)
            assert (np.diff(prints.astype(object)) > 0).all()
            assert {int(p) * 13 >> 64 for p in prints} <= {k - 1, k}
            sums.update(dict(zip(prints.tolist(), counts.tolist(), strict=True)))
    whole = Counter()
    for _, g in c._parts([batch], 64):
        for n in (1, 2, 3):
            whole.update(g.prints(n, g.places(n)).tolist())
    assert sums == whole


def test_packed_counts():
    prints = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 1000, np.uint64))
    counts = np.arange(1000) ** 3 + 1
    a, b = c.unpack(c.pack(prints, counts))
    assert (a == prints).all() and (b == counts).all()


def test_words_behind_equal_hashes(monkeypatch):
    """Different words under one hash get different numbers."""
    monkeypatch.setattr(c, "hash_runs", lambda raw, starts, ends, values: np.zeros(len(starts), np.uint64))
    raw = np.frombuffer(b"ab cd abc ab cd abc x", np.uint8)
    g = c.Grams(raw, np.array([0, len(raw)]), np.zeros(1, int), np.zeros(1, np.uint64))
    number, first = g.numbers()
    words = [raw[a:b].tobytes() for a, b in zip(g.starts, g.ends, strict=True)]
    assert [words[first[n]] for n in number] == words and len(set(number.tolist())) == 4


def test_scores_past_64_bits(spark):
    """Products of counts of 14 digits are exact."""
    big = 99_999_999_999_989
    df = spark.createDataFrame([(big, big + 7, big + 10)], "a long, l long, r long")
    got = df.select(c._cut("l", "r").alias("s")).first().s
    assert got == 1000000 * big * big // ((big + 7) * (big + 10))


def _peak(run):
    """What ``run`` returns, and the bytes of numpy and Python that it held at most."""
    import tracemalloc

    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_task_holds_its_fingerprints_once(monkeypatch):
    """Neither a full task nor the merge of a range holds several copies; rows come in small batches."""
    import pyarrow as pa

    monkeypatch.setattr(c, "PART_BYTES", 1 << 16)
    monkeypatch.setattr(c, "TASK_GRAMS", 1_000_000)
    monkeypatch.setattr(c, "MERGE_GRAMS", 50_000, raising=False)
    monkeypatch.setattr(c, "ROW_BYTES", 1 << 20, raising=False)
    number = np.random.default_rng(5).integers(0, 200_000, (900, 800))
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(map(str, r)) for r in number], "lang": ["en"] * 900})
    c._powers(1 << 16)
    c._sketch(iter([batch.slice(0, 1)]), 40, 64).__next__()

    largest, peak = _peak(lambda: max(b.nbytes for b in c._sketch(iter([batch]), 40, 64)))
    assert peak < 2 * 8 * c.TASK_GRAMS + (6 << 20) and largest < 2 << 20

    packed = [d for b in c._sketch(iter([batch]), 1, 64) for d in b["grams"].to_pylist()]
    grams = [c.unpack(d) for d in packed]
    want = Counter()
    for prints, counts in grams:
        want.update(dict(zip(prints.tolist(), counts.tolist(), strict=True)))
    rows = pa.RecordBatch.from_pydict({"range": [0] * len(packed), "grams": packed})
    got, peak = _peak(lambda: [p for b in c._frequent(iter([rows]), 4) for p in b["print"].to_pylist()])
    assert sorted(x % (1 << 64) for x in got) == sorted(k for k, n in want.items() if n >= 4) and len(got) > 1000
    assert peak < 28 * sum(len(p) for p, _ in grams)


@pytest.mark.parametrize("size", [1, 7, 1 << 18])
def test_words_compared_in_stretches(monkeypatch, size):
    """However many words are compared at once, those that differ are found."""
    monkeypatch.setattr(c, "WORD_BYTES", size)
    monkeypatch.setattr(c, "hash_runs", lambda raw, starts, ends, values: np.ones(len(starts), np.uint64))
    raw = np.frombuffer(b"ab cd abc ab cd abc x " + b"y" * 40, np.uint8)
    g = c.Grams(raw, np.array([0, len(raw)]), np.zeros(1, int), np.zeros(1, np.uint64))
    number, first = g.numbers()
    words = [raw[a:b].tobytes() for a, b in zip(g.starts, g.ends, strict=True)]
    assert [words[first[n]] for n in number] == words and len(set(number.tolist())) == 5
