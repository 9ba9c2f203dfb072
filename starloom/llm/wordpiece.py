"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a byte trie. Longest match from the left, word after word,
would look again at bytes behind the last match; the automaton never does. Each
trie node carries what greedy matching does when no edge fits: it pops a number
of pieces (precomputed) and goes on at the failure node, which spells the rest
of the path after these pieces. The count of a word is the number of pops on
its way, the end of the word included; no piece is ever built.

All distinct words of a batch walk the automaton at once, a byte per step. Long
words, as in unspaced text, are cut into stretches that walk at once as well, each
as if a piece began there. Then they are joined from the left: from the state
that a stretch is really entered in, single bytes are walked until the state is
the one noted at that byte, from where on both walks are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.bpe import public_path
from starloom.llm.registry import query, table
from starloom.llm.text import once, slices, utf8, words
from starloom.llm.vocab import ByteVocab

STEP_WORDS = 1 << 16  # distinct words that walk together
LONG = 256  # bytes; longer words walk in stretches of as many
AT_ONCE = 1 << 13  # stretches whose states are noted at a time


class Automaton:
    """``pieces`` are byte strings. Every byte that can occur should be a piece;
    a byte that begins no piece counts as one piece of its own.

    State 0 is the root. ``fail`` and ``pops`` belong to nodes below it: popping
    ``pops[v]`` pieces leaves the bytes that ``fail[v]`` spells.
    """

    def __init__(self, pieces: list[bytes]):
        pieces = sorted({p for p in pieces if p} | {bytes([b]) for b in range(256)})
        children: list[dict[int, int]] = [{}]
        ends, parent, byte, level = [False], [0], [0], [0]
        for piece in pieces:
            v = 0
            for b in piece:
                if b not in children[v]:
                    children[v][b] = len(children)
                    children.append({})
                    ends.append(False)
                    parent.append(v)
                    byte.append(b)
                    level.append(level[v] + 1)
                v = children[v][b]
            ends[v] = True
        self.fail = np.zeros(len(children), np.int32)
        self.pops = np.zeros(len(children), np.int32)
        fail, pops = self.fail, self.pops
        for v in np.argsort(np.array(level), kind="stable")[1:].tolist():
            if ends[v]:
                pops[v] = 1  # the path is a piece: nothing is left
                continue
            u, n = parent[v], 0
            while True:  # the path to u is popped until the last byte fits on what is left
                n += int(pops[u])
                u = int(fail[u])
                w = children[u].get(byte[v])
                if w is not None:
                    fail[v], pops[v] = w, n
                    break
        edges = [(v << 8 | b, w) for v, to in enumerate(children) for b, w in to.items()]
        edges.sort()
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.to = np.array([w for _, w in edges], np.int32)
        self.first = np.array([children[0][b] for b in range(256)], np.int32)
        self._single: tuple[dict[int, int], list[int], list[int]] | None = None

    def _next(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node along the edge, -1 where there is none."""
        key = state.astype(np.int64) << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def _step(self, state: np.ndarray, count: np.ndarray, byte: np.ndarray) -> None:
        """Move all walks on by a byte each, in place."""
        todo = np.arange(len(state))
        while len(todo):
            to = self._next(state[todo], byte[todo])
            good = to >= 0
            state[todo[good]] = to[good]
            todo = todo[~good]
            count[todo] += self.pops[state[todo]]
            state[todo] = self.fail[state[todo]]

    def _walk(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word, all words at once; the longest go first."""
        order = np.argsort(starts - ends, kind="stable")
        begin, size = starts[order], (ends - starts)[order]
        count = np.zeros(len(order), np.int64)
        state = np.zeros(len(order), np.int32)
        for k in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -k, side="left"))
            self._step(state[:live], count[:live], raw[begin[:live] + k])
        while True:  # what is left at the ends of words
            left = np.flatnonzero(state)
            if not len(left):
                break
            count[left] += self.pops[state[left]]
            state[left] = self.fail[state[left]]
        out = np.empty(len(order), np.int64)
        out[order] = count
        return out

    def _long(self, raw: np.ndarray, start: int, end: int) -> int:
        """Pieces of one long word, whose stretches walk at once and are then joined."""
        edges, fail, pops = self._plain()
        total = state = 0
        for at in range(start, end, LONG * AT_ONCE):
            block = raw[at : min(end, at + LONG * AT_ONCE)]
            n = -(-len(block) // LONG)
            rows = np.zeros(n * LONG, np.uint8)
            rows[: len(block)] = block
            rows = rows.reshape(n, LONG)
            states = np.zeros((LONG, n), np.int32)
            counts = np.zeros((LONG, n), np.int64)
            s, c = np.zeros(n, np.int32), np.zeros(n, np.int64)
            for k in range(LONG):
                self._step(s, c, np.ascontiguousarray(rows[:, k]))
                states[k], counts[k] = s, c
            for i in range(n):
                size = min(LONG, len(block) - i * LONG)
                if state:  # 0 is what the stretch was walked from
                    noted, passed = states[:size, i].tolist(), counts[:size, i].tolist()
                    more = 0
                    for k, b in enumerate(rows[i, :size].tolist()):
                        while (to := edges.get(state << 8 | b)) is None:
                            more += pops[state]
                            state = fail[state]
                        state = to
                        if state == noted[k]:
                            total += more + passed[-1] - passed[k]
                            state = noted[-1]
                            break
                    else:
                        total += more
                else:
                    total += int(counts[size - 1, i])
                    state = int(states[size - 1, i])
        while state:
            total += pops[state]
            state = fail[state]
        return total

    def _plain(self) -> tuple[dict[int, int], list[int], list[int]]:
        """Edges, failure nodes and pops for single steps, made when first needed."""
        if self._single is None:
            edges = dict(zip(self.keys.tolist(), self.to.tolist(), strict=True))
            self._single = edges, self.fail.tolist(), self.pops.tolist()
        return self._single

    def counts(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of the words that lie at ``starts`` to ``ends`` in ``raw``."""
        out = np.zeros(len(starts), np.int64)
        size = ends - starts
        for k in np.flatnonzero(size > LONG).tolist():
            out[k] = self._long(raw, int(starts[k]), int(ends[k]))
        short = np.flatnonzero(size <= LONG)
        for k in range(0, len(short), STEP_WORDS):
            part = short[k : k + STEP_WORDS]
            out[part] = self._walk(raw, starts[part], ends[part])
        return out


def word_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary that lie within a word. A piece that
    begins with a space starts a word, and is looked for without it."""
    vocab = ByteVocab(path)
    ids = {*np.flatnonzero(vocab.token_bytes).tolist()} - {*vocab.special.values()}
    pieces = map(vocab.core.decode_single_token_bytes, sorted(ids))
    return [p.removeprefix(b" ") for p in pieces]


def automaton(path: str) -> Automaton:
    return once(("pieces", path), lambda: Automaton(word_pieces(path)))


def _counted(
    batches: Iterator[pa.RecordBatch], path: str, column: str
) -> Iterator[pa.RecordBatch]:
    machine = automaton(path)
    for batch in batches:
        for part in slices(batch, column):
            raw, offsets = utf8(part.column(column))
            w = words(raw, offsets)
            _, one, which = np.unique(w.hashes, return_index=True, return_inverse=True)
            pieces = machine.counts(raw, w.starts[one], w.ends[one])[which]
            total = np.concatenate(([0], np.cumsum(pieces)))[w.first]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.diff(w.first).astype(np.int64)), pa.array(np.diff(total))],
                [*part.schema.names, "n_words", "n_pieces"],
            )


def count_pieces(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_pieces`` (earlier columns of these names go).

    A word's pieces are its greedy longest matches from the left. NULL, empty
    and blank texts have no words and no pieces. Rows keep their other columns
    and their number; an empty table gives no rows.
    """
    docs = docs.drop(*[c for c in ("n_words", "n_pieces") if c in docs.columns])
    schema = [T.StructField(f.name, f.dataType) for f in docs.schema.fields]
    schema += [T.StructField(c, T.LongType()) for c in ("n_words", "n_pieces")]
    return docs.mapInArrow(partial(_counted, path=path, column=column), T.StructType(schema))


@query("op7_token_counts")
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("text"))
    return count_pieces(docs, public_path("byte_bpe_50k.json")).drop("text")
