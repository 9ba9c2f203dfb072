"""Quality rules: hashed n-gram log-likelihood ratios after a few base rules.

Byte n-grams of all texts are hashed into ``BUCKETS`` buckets and counted twice:
over the whole corpus, and over the texts trusted as a target (label quality
1). With add-one smoothing both are multinomials; a text's score is the mean
over its n-grams of ``log(target / corpus)``. It is kept if the score is at
least ``THRESHOLD``: a text made of what the corpus has much of and the target
little of falls far below, one like the target, or unlike either, lies near 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.registry import query, table
from starloom.llm.text import lines, mix, owner, per_text, repeats, slices, utf8, words

BITS = 14
BUCKETS = 1 << BITS
GRAM = 4  # bytes
THRESHOLD = -0.2
SYMBOL = np.zeros(256, np.int8)
SYMBOL[list(b"#*$%&|<>")] = 1


def buckets(raw: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram at each byte that has ``GRAM - 1`` bytes after it."""
    gram = np.zeros(max(0, len(raw) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        gram |= raw[k : k + len(gram)].astype(np.uint64) << np.uint64(8 * k)
    return (mix(gram) >> np.uint64(64 - BITS)).astype(np.int64)


def _within(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` n-grams do not run over the end of a text."""
    good = np.ones(n, bool)
    for k in range(1, GRAM):
        at = offsets - k
        good[at[(at >= 0) & (at < n)]] = False
    return good


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            raw, offsets = utf8(part.column("text"))
            b = buckets(raw)
            good = _within(offsets, len(b))
            trusted = np.repeat(part.column("_trusted").to_numpy(zero_copy_only=False), np.diff(offsets))
            counts[0] += np.bincount(b[good], minlength=BUCKETS)
            counts[1] += np.bincount(b[good & trusted[: len(b)]], minlength=BUCKETS)
    some = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])],
        ["bucket", "corpus", "target"],
    )


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratios per bucket, over all of ``docs`` (``doc_id, text``) and those with
    label quality 1 in ``labels`` (``doc_id, quality``; repeated labels count once).

    Each task sends one row per bucket it met. The driver gets ``BUCKETS``
    numbers, whatever the input. Without a trusted text all ratios are 0.
    """
    trusted = labels.where("quality = 1").select("doc_id").distinct()
    trusted = trusted.withColumn("_yes", F.lit(True)).hint("merge")  # grows with the input
    marked = docs.select("doc_id", "text").join(trusted, "doc_id", "left")
    marked = marked.select("text", F.coalesce("_yes", F.lit(False)).alias("_trusted"))
    sums = (
        marked.mapInArrow(_count, "bucket bigint, corpus bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target"))
        .collect()
    )
    counts = np.ones((2, BUCKETS))
    for bucket, corpus, target in sums:
        counts[:, bucket] += corpus, target
    if counts[1].sum() == BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


COLUMNS = (
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("base_failed", T.BooleanType()),
    ("llr", T.DoubleType()),
    ("kept", T.BooleanType()),
)


def measure(raw: np.ndarray, offsets: np.ndarray, ratios: np.ndarray, threshold: float) -> list[np.ndarray]:
    """The columns of ``COLUMNS`` for the texts."""
    w = words(raw, offsets)
    n_words = np.diff(w.first)
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[w.starts] += 1
    inside[w.ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) if len(raw) else inside[:0]
    chars = per_text(inside * ((raw & 0xC0) != 0x80), offsets)
    rows = lines(raw, offsets, w)
    of = owner(rows.first)
    again = repeats(rows.hashes, of)[1]
    dup_lines = np.bincount(of[again], minlength=len(n_words))
    at, begins = w.places(3)
    twice = at[repeats(w.windows(3)[0], owner(begins))[0]]
    covered = np.zeros(len(w.starts), np.int8)
    for k in range(3):
        covered[twice + k] = 1
    repeat_words = per_text(covered, w.first)
    failed = (n_words < 50) | (100 * repeat_words > 50 * n_words)
    b = buckets(raw)
    value = np.zeros(len(raw))
    value[: len(b)] = ratios[b] * _within(offsets, len(b))
    grams = np.maximum(np.diff(offsets) - GRAM + 1, 0)
    score = per_text(value, offsets) / np.maximum(grams, 1)
    symbols = per_text(SYMBOL[raw], offsets)
    return [n_words, chars, symbols, dup_lines, repeat_words, failed, score, ~failed & (score >= threshold)]


def _judged(
    batches: Iterator[pa.RecordBatch], ratios: np.ndarray, threshold: float, column: str, only: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, column):
            found = measure(*utf8(part.column(column)), ratios, threshold)
            if only:
                yield part.filter(pa.array(found[-1]))
                continue
            new = [pa.array(v) for v in found]
            names = part.schema.names + [n for n, _ in COLUMNS]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names)


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD, column: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COLUMNS`` (earlier columns of these names go).

    NULL and empty texts have no words and fail the base rules. Rows keep their
    other columns and their number; equal texts are judged alike.
    """
    docs = docs.drop(*[n for n, _ in COLUMNS if n in docs.columns])
    schema = [T.StructField(f.name, f.dataType) for f in docs.schema.fields]
    schema += [T.StructField(n, k) for n, k in COLUMNS]
    task = partial(_judged, ratios=ratios, threshold=threshold, column=column, only=False)
    return docs.mapInArrow(task, T.StructType(schema))


def accepted(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD, column: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields])
    task = partial(_judged, ratios=ratios, threshold=threshold, column=column, only=True)
    return docs.mapInArrow(task, schema)


@query("op5_quality_rules")
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return judge(docs, fit(docs, table(spark, sf, "labels"))).drop("text")
