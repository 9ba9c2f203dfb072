"""Quality classifier: a linear-chain conditional random field over lines.

Each line of a text is good (1) or bad (0). Its features are shape statistics of
the line and of the lines before and after it; neighbouring labels are tied by
transition weights. In training every line carries its document's label. A
document's score is the mean, weighted by length in bytes, of its lines'
forward-backward marginals of being good.

The model is fitted by gradient ascent on at most ``SAMPLE`` labelled documents,
those with the smallest hashes of their ids, however long. Of one with more than
``SAMPLE_LINES`` lines the driver gets as many neighbouring ones, from a place
that its id picks; features are those in the whole text. The driver gets
features, not texts. Every document is scored, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.registry import query, table
from starloom.llm.text import SEPARATOR, lines, owner, per_text, repeats, slices, utf8, words

SAMPLE = 6000
SAMPLE_LINES = 128
STEPS = 400
RATE = 0.1
DECAY = 1e-5
PREDICT_AT = 0.3


def _bytes(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int8)
    out[list(chars)] = 1
    return out


_UPPER = _bytes(bytes(range(ord("A"), ord("Z") + 1)))
_DIGIT = _bytes(b"0123456789")
_SYMBOL = _bytes(b"#*$%&|<>@^~_=+/\\{}[]")
_STOP = _bytes(b"!?")
_POINT = _bytes(b".,;:")
_BAR = _bytes(b"|")
_ALNUM = _bytes(b"0123456789" + bytes(c for c in range(65, 123) if chr(c).isalpha()))
_ALNUM[128:] = 1
#: roots of the shares of upper case, digits, symbols, !?, .,;: ; log length; bytes a word;
#: repeated and doubled words; line seen before in the text; few words; words
#: without letters or digits; root of the share of bars
FEATURES = 13


def line_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and byte lengths of all lines with a word, and each text's first line."""
    w = words(raw, offsets)
    rows = lines(raw, offsets, w)
    n = len(rows.starts)
    size = np.maximum(rows.ends - rows.starts, 1).astype(float)
    out = np.zeros((n, FEATURES))
    for k, table_ in enumerate((_UPPER, _DIGIT, _SYMBOL, _STOP, _POINT)):
        total = np.concatenate(([0], np.cumsum(table_[raw], dtype=np.int64)))
        out[:, k] = np.sqrt((total[rows.ends] - total[rows.starts]) / size)
    out[:, 5] = np.log1p(size) / 8
    blank = np.concatenate(([0], np.cumsum(SEPARATOR[raw], dtype=np.int64)))
    out[:, 6] = np.minimum((size - (blank[rows.ends] - blank[rows.starts])) / rows.n_words / 16, 2)
    line_of = np.repeat(np.arange(n), rows.n_words)
    at = np.arange(len(line_of)) - np.repeat(np.cumsum(rows.n_words) - rows.n_words, rows.n_words)
    own = w.hashes[np.repeat(rows.first_word, rows.n_words) + at]
    again = repeats(own, line_of)[1]
    out[:, 7] = np.bincount(line_of[again], minlength=n) / rows.n_words
    double = np.zeros(len(own), bool)
    double[1:] = (own[1:] == own[:-1]) & (line_of[1:] == line_of[:-1])
    out[:, 8] = np.bincount(line_of[double], minlength=n) / rows.n_words
    out[:, 9] = repeats(rows.hashes, owner(rows.first))[1]
    out[:, 10] = rows.n_words < 3
    solid = np.concatenate(([0], np.cumsum(_ALNUM[raw], dtype=np.int64)))
    hollow = np.concatenate(([0], np.cumsum(solid[w.ends] == solid[w.starts])))
    out[:, 11] = (hollow[rows.first_word + rows.n_words] - hollow[rows.first_word]) / rows.n_words
    bars = np.concatenate(([0], np.cumsum(_BAR[raw], dtype=np.int64)))
    out[:, 12] = np.sqrt((bars[rows.ends] - bars[rows.starts]) / size)
    return out, size, rows.first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features with those of the lines around it (0 at a text's ends) and 1."""
    n = len(own)
    out = np.zeros((n, 3 * own.shape[1] + 1))
    k = own.shape[1]
    out[:, :k] = own
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    if n > 1:
        inner = ~begins[1:n]
        out[1:, k : 2 * k] = own[:-1] * inner[:, None]
        out[:-1, 2 * k : 3 * k] = own[1:] * inner[:, None]
    out[:, -1] = 1
    return out


def log_odds(own: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``with_neighbours(own, first) @ weights`` without the wide matrix."""
    n, k = own.shape
    mine, before, after = (own @ weights[:-1].reshape(3, k).T).T
    out = mine + weights[-1]
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    if n > 1:
        inner = ~begins[1:n]
        out[1:] += before[:-1] * inner
        out[:-1] += after[1:] * inner
    return out


def marginals(
    good: np.ndarray, first: np.ndarray, ties: np.ndarray, share: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all texts at once.

    ``good`` is each line's log-odds from its features, ``ties[a, b]`` the weight
    of a line labelled ``a`` before one labelled ``b``. Returns each line's
    marginal of label 1 and the expected number of every transition, each text's
    times its ``share``.
    """
    n_lines = np.diff(first)
    order = np.argsort(-n_lines, kind="stable")
    begin, length = first[:-1][order], n_lines[order]
    emit = np.stack((np.zeros(len(good)), good), axis=1)
    ahead, behind = emit.copy(), np.zeros_like(emit)
    longest = int(length[0]) if len(length) else 0
    live = [int(np.searchsorted(-length, -k, side="left")) for k in range(longest)]  # longer than k
    for k in range(1, longest):
        at = begin[: live[k]] + k
        before = ahead[at - 1]
        step = np.logaddexp(before[:, :1] + ties[0], before[:, 1:] + ties[1])
        ahead[at] = emit[at] + step
    pairs = np.zeros((2, 2))
    share = (np.ones(len(n_lines)) if share is None else share)[order]
    for k in range(longest - 1, 0, -1):
        at = begin[: live[k]] + k
        after = emit[at] + behind[at]
        behind[at - 1] = np.logaddexp(after[:, :1] + ties[:, 0], after[:, 1:] + ties[:, 1])
        joint = ahead[at - 1][:, :, None] + ties[None] + after[:, None, :]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        part = share[: live[k]] / joint.sum(axis=(1, 2))
        pairs += (joint * part[:, None, None]).sum(axis=0)
    odds = np.clip((ahead + behind)[:, 1] - (ahead + behind)[:, 0], -500, 500)
    return 1 / (1 + np.exp(-odds)), pairs


@dataclass
class Model:
    weights: np.ndarray
    ties: np.ndarray
    empty: float

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        own, size, first = line_features(raw, offsets)
        p, _ = marginals(log_odds(own, first, self.weights), first, self.ties)
        weight = per_text(size, first)
        mean = per_text(p * size, first) / np.maximum(weight, 1)
        return np.clip(np.where(weight > 0, mean, self.empty), 0, 1)


def fit_crf(own: np.ndarray, first: np.ndarray, labels: np.ndarray) -> Model:
    """Maximum likelihood with a small penalty, by Adam from zero: the same data
    give the same model. Every document counts once, whatever its lines. Without lines, or without both labels, the score is the
    share of label 1, or a half."""
    share = float(labels.mean()) if len(labels) else 0.5
    x = with_neighbours(own, first)
    weights, ties = np.zeros(x.shape[1]), np.zeros((2, 2))
    if not len(own) or share in (0.0, 1.0):
        bias = np.log((share + 1e-3) / (1 - share + 1e-3))
        weights[-1] = bias
        return Model(weights, ties, share)
    y = np.repeat(labels, np.diff(first)).astype(float)
    n_lines = np.diff(first)
    n = len(n_lines)
    share = 1 / np.maximum(n_lines, 1)
    each = np.repeat(share, n_lines)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (np.maximum(n_lines - 1, 0) * share)[labels == label].sum()
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in (weights, ties)]
    for step in range(1, STEPS + 1):
        p, pairs = marginals(x @ weights, first, ties, share)
        slopes = (x.T @ ((y - p) * each) / n - DECAY * weights, (seen - pairs) / n - 10 * DECAY * ties)
        for value, slope, (m, v) in zip((weights, ties), slopes, moments, strict=True):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope**2 - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(weights, ties, 0.0)


def window(doc_id: int, n_lines: int, most: int) -> int:
    """The first of the ``most`` neighbouring lines that stand for a text of more."""
    return crc32(str(doc_id).encode()) % (n_lines - most + 1) if n_lines > most else 0


def _featured(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            own, _, first = line_features(*utf8(part.column("text")))
            n_lines = np.diff(first)
            ids = part.column("doc_id").to_pylist()
            at = [window(d, int(n), most) for d, n in zip(ids, n_lines, strict=True)]
            size = np.minimum(n_lines, most)
            ends = np.cumsum(size)
            rows = np.arange(int(size.sum())) + np.repeat(first[:-1] + at - (ends - size), size)
            flat = pa.array(own[rows].reshape(-1).astype(np.float32))
            begins = np.concatenate(([0], ends)) * FEATURES
            lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), lists], ["doc_id", "quality", "features"])


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learned from."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES
) -> Model:
    """Fit on ``docs`` (``doc_id, text``) with ``labels`` (``doc_id, quality``) outside
    the held-out fifth. NULL labels, ids and texts are left out; of a doc_id with
    several labels the smallest counts, and of one with several rows the one whose
    features have the smallest hash. So the driver gets at most ``sample`` times
    ``sample_lines`` lines."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(known), "doc_id")  # `sample` rows at most
        .where("text is not null")
        .mapInArrow(
            partial(_featured, most=sample_lines), "doc_id bigint, quality int, features array<float>"
        )
        .groupBy("doc_id")
        .agg(
            F.first("quality").alias("quality"),  # one label per doc_id
            F.min_by("features", F.xxhash64("features")).alias("features"),
        )
        .orderBy("doc_id")
        .toArrow()
    )
    features = rows.column("features").combine_chunks()
    sizes = features.value_lengths().to_numpy(zero_copy_only=False) // FEATURES
    own = features.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, FEATURES)
    first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return fit_crf(own, first, rows.column("quality").to_numpy())


def _scored(batches: Iterator[pa.RecordBatch], model: Model, column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, column):
            scores = model.scores(*utf8(part.column(column)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*part.schema.names, "score"])


def score(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (an earlier column of this name goes), from the text alone.

    NULL, empty and blank texts have no line and get the model's score for these:
    0, as they have no good line. Rows keep their other columns and number.
    """
    docs = docs.drop("score") if "score" in docs.columns else docs
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields])
    schema = T.StructType([*schema, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(partial(_scored, model=model, column=column), schema)


@query("op6_line_crf")
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
