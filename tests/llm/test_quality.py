import collections
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import line_crf, quality_rules
from tests.llm.conftest import split_words


def base(text):
    t, w = text or "", split_words(text)
    runs = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if split_words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed)


@pytest.fixture(scope="module")
def labels(spark, corpus):
    return spark.createDataFrame([(k, int(k < 60), 0) for k, _ in corpus if k % 3] * 2, "doc_id long, quality int, toxic int")


def test_base_columns(docs, corpus, labels):
    ratios = quality_rules.fit(docs, labels)
    rows = {r.doc_id: r for r in quality_rules.judge(docs, ratios).collect()}
    for k, t in corpus:
        r = rows[k]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base(t), repr(t)[:80]
        assert r.kept == (not r.base_failed and r.llr >= quality_rules.THRESHOLD)


def test_ratios_are_those_of_counted_ngrams(docs, corpus, labels):
    counts = np.ones((2, quality_rules.BUCKETS))
    trusted = {k for k, _ in corpus if k % 3 and k < 60}
    grams = {}
    for k, t in corpus:
        b = (t or "").encode()
        grams[k] = quality_rules.buckets(np.frombuffer(b, np.uint8))
        assert len(grams[k]) == max(0, len(b) - 3)
        np.add.at(counts[0], grams[k], 1)
        if k in trusted:
            np.add.at(counts[1], grams[k], 1)
    want = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratios = quality_rules.fit(docs, labels)
    assert np.allclose(ratios, want)
    for r in quality_rules.judge(docs, ratios).collect():
        assert np.isclose(r.llr, want[grams[r.doc_id]].mean() if len(grams[r.doc_id]) else 0)


def test_no_trusted_texts_and_no_rows(docs, labels, no_docs):
    none = labels.where("quality = 5")
    ratios = quality_rules.fit(docs, none)
    assert not ratios.any()
    kept = quality_rules.accepted(docs, ratios)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect() if not base(r.text)[-1]}
    assert quality_rules.judge(no_docs, quality_rules.fit(no_docs, labels)).count() == 0


def test_marginals_as_enumeration_gives_them():
    rng = np.random.default_rng(1)
    for _ in range(10):
        first = np.concatenate(([0], np.cumsum(rng.integers(0, 6, 5))))
        good, ties = rng.normal(size=first[-1]), rng.normal(size=(2, 2))
        p, pairs = line_crf.marginals(good, first, ties)
        want, all_pairs = np.zeros(len(good)), np.zeros((2, 2))
        for a, b in itertools.pairwise(first):
            total, ones, own = 0.0, np.zeros(b - a), np.zeros((2, 2))
            for ys in itertools.product((0, 1), repeat=b - a):
                steps = list(itertools.pairwise(ys))
                e = np.exp(sum(good[a + i] for i, y in enumerate(ys) if y) + sum(ties[s] for s in steps))
                total, ones = total + e, ones + e * np.array(ys)
                for s in steps:
                    own[s] += e
            if b > a:
                want[a:b] = ones / total
                all_pairs += own / total
        assert np.allclose(p, want) and np.allclose(pairs, all_pairs)


def test_held_out_documents_are_told_apart(spark):
    """Accuracy on documents whose labels were not learned from."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("aeinorst"), 5))
    rows = []
    for k in range(600):
        lines = [" ".join(word() for _ in range(8)).capitalize() + "." for _ in range(int(rng.integers(1, 6)))]
        bad = k % 4 == 0
        rows.append((k, "\n".join(x.upper().replace(" ", "!! ") if bad else x for x in lines), int(not bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = line_crf.train(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    scored = line_crf.score(df, model)
    assert scored.columns == ["doc_id", "text", "quality", "score"]
    held = scored.where(line_crf.held_out(scored.doc_id)).collect()
    assert len(held) > 80
    assert np.mean([(r.score >= line_crf.PREDICT_AT) == r.quality for r in held]) >= 0.98
    again = line_crf.train(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    assert np.array_equal(model.weights, again.weights)


def test_log_odds_are_those_of_neighbours():
    rng = np.random.default_rng(6)
    for _ in range(10):
        first = np.concatenate(([0], np.cumsum(rng.integers(0, 5, 6))))
        own = rng.normal(size=(first[-1], line_crf.FEATURES))
        weights = rng.normal(size=3 * line_crf.FEATURES + 1)
        want = line_crf.with_neighbours(own, first) @ weights
        assert np.allclose(line_crf.log_odds(own, first, weights), want)


def test_long_texts_are_learned_from_too(spark):
    """Bad texts of these labels are all long: a cut by length would hide them."""
    rows = []
    for k in range(200):
        line = "A plain sentence of some words."
        text = "\n".join([line.upper() + " $$$"] * 3000) if k % 2 else "\n".join([line] * 5)
        rows.append((k, text, 1 - k % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = line_crf.train(df.select("doc_id", "text"), df.select("doc_id", "quality"), sample_lines=20)
    held = line_crf.score(df, model).where(line_crf.held_out(F.col("doc_id"))).collect()
    assert all((r.score >= line_crf.PREDICT_AT) == r.quality for r in held)
    again = line_crf.train(
        df.select("doc_id", "text").union(df.select("doc_id", "text")),
        df.select("doc_id", "quality"),
        sample_lines=20,
    )
    assert np.array_equal(model.weights, again.weights)  # repeated rows bring no more lines


def test_scores_of_odd_texts_and_unlabelled_corpora(docs, corpus, labels, no_docs):
    model = line_crf.train(docs, labels)
    rows = {r.doc_id: r.score for r in line_crf.score(docs, model).collect()}
    assert len(rows) == len(corpus) and all(0 <= s <= 1 for s in rows.values())
    assert all(rows[k] == 0 for k, t in corpus if not split_words(t))
    nothing = line_crf.train(docs, labels.where("quality = 7"))
    assert {round(r.score, 6) for r in line_crf.score(docs, nothing).collect()} == {0.5}
    assert line_crf.score(no_docs, model).count() == 0
