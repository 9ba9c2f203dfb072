"""Words and hashes of whole Arrow text columns, by numpy, inside Spark tasks.

Texts are UTF-8 bytes; a word is a maximal run of bytes other than
``\\x20 \\x09-\\x0D``. Equal words (and shingles) get equal 64-bit hashes in
every task, and different ones different hashes but for a chance of 2**-64.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20  # of text that numpy handles at once, if no single text is longer
BLOCK = 1 << 14  # bytes hashed at once; longer words are hashed one by one

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def once(key: Any, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept for later tasks of the same Python worker."""
    kept = sys.modules.setdefault("_starloom_once", ModuleType("_starloom_once")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(seed))


_BYTE = constants(256, 11) * ~SEPARATOR  # separators add nothing to a word's sum
_LINE_BYTE = constants(256, 13)
_LINE_BYTE[10] = 0
_BASE = int(constants(1, 12)[0]) | 1
_POWER = np.ones(BLOCK, np.uint64)
_POWER[1:] = _BASE
_POWER = np.multiply.accumulate(_POWER)
_INVERSE = np.ones(BLOCK, np.uint64)
_INVERSE[1:] = pow(_BASE, -1, 1 << 64)
_INVERSE = np.multiply.accumulate(_INVERSE)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text each."""
    _, offsets = utf8(batch.column(column))
    begin, n = 0, batch.num_rows
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(n, max(begin + 1, end))
        yield batch.slice(begin, end - begin)
        begin = end


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each text begins in them; null: empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, begins, data = texts.buffers()
    if len(texts) == 0 or begins is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(begins, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of several texts: byte places, hashes, and each text's first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def places(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of ``n`` words within a text, and where each text's runs begin."""
        counts = np.maximum(np.diff(self.first) - n + 1, 0)
        begins = np.concatenate(([0], np.cumsum(counts)))
        return np.arange(begins[-1]) + np.repeat(self.first[:-1] - begins[:-1], counts), begins

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of these runs, and where each text's runs begin."""
        at, begins = self.places(n)
        total = np.zeros(len(at), np.uint64)
        for k, c in enumerate(constants(n, 100 + n)):
            total += self.hashes[at + k] * (c | np.uint64(1))
        return mix(total), begins


def hash_runs(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, values_of: np.ndarray = _BYTE
) -> np.ndarray:
    """Hashes of non-empty byte runs; bytes between them must have the value 0."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        s = starts[i]
        if ends[i] - s > BLOCK:
            digest = blake2b(raw[s : ends[i]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
            i += 1
            continue
        j = int(np.searchsorted(ends, s + BLOCK, side="right"))
        values = values_of[raw[s : ends[j - 1]]]
        values *= _POWER[: len(values)]
        at = starts[i:j] - s
        out[i:j] = np.add.reduceat(values, at) * _INVERSE[at]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * _ODD)


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """All words of the texts; ``lower`` folds A-Z first."""
    if lower:
        raw = LOWER[raw]
    inside = ~SEPARATOR[raw]
    n = len(raw)
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = hash_runs(raw, starts, ends) if n else np.zeros(0, np.uint64)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


@dataclass
class Lines:
    """Lines (between ``\\n``) that have a word: byte places, hashes, and each text's first line."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    first_word: np.ndarray
    n_words: np.ndarray


def lines(raw: np.ndarray, offsets: np.ndarray, w: Words) -> Lines:
    """The texts' lines; ``w`` are their words."""
    breaks = np.flatnonzero(raw == 10)
    starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    starts = starts[starts < len(raw)]
    ends = np.minimum(
        np.append(breaks, len(raw))[np.searchsorted(breaks, starts)],
        offsets[np.searchsorted(offsets, starts, side="right")],
    ) if len(starts) else starts
    some = ends > starts
    starts, ends = starts[some], ends[some]
    hashes = hash_runs(raw, starts, ends, _LINE_BYTE) if len(starts) else np.zeros(0, np.uint64)
    first_word = np.searchsorted(w.starts, starts)
    n_words = np.searchsorted(w.starts, ends) - first_word
    full = n_words > 0
    starts, ends, hashes = starts[full], ends[full], hashes[full]
    return Lines(
        starts, ends, hashes, np.searchsorted(starts, offsets), first_word[full], n_words[full]
    )


def owner(first: np.ndarray) -> np.ndarray:
    """For each word (or line) the number of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a per-byte (or per-word) array over each text."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeats(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which elements occur twice or more in their text, and which are no first occurrence."""
    keys = hashes ^ mix(text.astype(np.uint64) * _ODD + np.uint64(5))
    _, one, which, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    again = np.ones(len(keys), bool)
    again[one] = False
    return n[which] > 1, again


def shingle_sets(w: Words, n: int) -> list[np.ndarray]:
    """Per text its distinct ``n``-word shingles, ascending; a text with fewer
    words has its whole sequence as the only one, a text without words none."""
    runs, begins = w.windows(n)
    sets = []
    for d in range(len(w.first) - 1):
        a, b = begins[d], begins[d + 1]
        if b > a:
            s = np.sort(runs[a:b])
            if len(s) > 1:
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        else:
            own = w.hashes[w.first[d] : w.first[d + 1]]
            whole = np.uint64(len(own)) + (own * constants(n, 7)[: len(own)]).sum(dtype=np.uint64)
            s = mix(np.array([whole], np.uint64))[: len(own)]
        sets.append(s)
    return sets
