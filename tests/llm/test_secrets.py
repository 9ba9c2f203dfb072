import random
import re

import pytest
from pyspark.sql import functions as F

from starloom.llm import secrets

FRAGMENTS = [
    "password", "PassWord", '"', "'", " ", "  ", ":", "=", "AKIA", "ABCDEFGH12345", "abcdef0123456789" * 2,
    "token", "api_key", "APIKEY", "é🙂", "x", "\n", "secret=", "12345678", "https://a.example.com/x ",
    "K" * 40 + " ", "s3cr3t/+v", "AKIA12345678", "y" * 150,
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    out = ["".join(rng.choices(FRAGMENTS, k=rng.randint(0, 30))) for _ in range(700)]
    return list(enumerate([*out, None, "", "é" * 50_000 + " AKIA" + "Z" * 16]))


def spans(text):
    base = []
    for n, (kind, pattern, group, least) in enumerate(secrets.BASE):
        for m in re.finditer(pattern, text or "", re.A):
            if len(m[group]) >= least:
                base.append((m.start(), n, m.end(), kind))
    weak = []
    for n, (kind, pattern) in enumerate(secrets.CANDIDATES, len(secrets.BASE)):
        weak += [(m.start(), n, m.end(), kind) for m in re.finditer(pattern, text or "")]
    linked = [
        x
        for x in weak
        if any(y[3] in secrets.COMPLEMENTS[x[3]] and abs(x[0] - y[0]) <= secrets.SCOPE for y in base + weak)
    ]
    return sorted(base), sorted(base + linked)


def line(found):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)


def test_report_as_brute_force_finds_it(spark, texts):
    import hashlib

    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in secrets.report(df).collect()}
    linked = 0
    for k, t in texts:
        base, every = spans(t)
        r = rows[k]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == n for x in base) for n in range(3))
        assert r.base_sha256 == hashlib.sha256(line(base).encode()).hexdigest()
        assert r.spans == line(every)
        linked += len(every) - len(base)
    assert linked > 50


def test_masking_keeps_rows_and_columns(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    df = df.withColumn("n_chars", F.length("text").cast("int")).withColumn("base", F.lit("clash"))
    df = df.union(df.limit(1))
    out = secrets.masked(df)
    assert out.dtypes == df.dtypes and out.count() == len(texts) + 1
    rows = {r.doc_id: r for r in out.collect()}
    for k, t in texts:
        want, at = "", 0
        for a, _, b, _ in spans(t)[1]:
            if a >= at:
                want += t[at:a] + secrets.MASK
            at = max(at, b)
        want = None if t is None else want + t[at:]
        assert rows[k].text == want and rows[k].base == "clash"
        assert rows[k].n_chars == (None if t is None else len(want))


def test_no_rows(no_docs):
    assert secrets.report(no_docs).count() == 0
    assert secrets.masked(no_docs).columns == no_docs.columns


def test_many_matches_in_one_text(spark):
    """Thousands of spans, in ascending order, overlapping and over block borders."""
    digest = "0123456789abcdef" * 2
    rng = random.Random(2)
    many = "".join(digest + rng.choice(("\n", " é ", "x", " token=", "-" * 700)) for _ in range(32_000))
    df = spark.createDataFrame([(1, many)], "doc_id long, text string")
    base, every = spans(many)
    got = secrets.report(df).first()
    assert got.n_hex == 32_000 and got.spans == line(every) and len(base) > 32_000
    want, at = [], 0
    for a, _, b, _ in every:
        if a >= at:
            want += [many[at:a], secrets.MASK]
        at = max(at, b)
    assert secrets.masked(df).first().text == "".join(want) + many[at:]
