"""Ranked lexical search: best-first descent of K2-treaps over term-document grids.

A grid has a row per query term and a column per document of a block, ascending
by doc_id; a cell holds the impact of the term in the document. The treap is a
quadtree of the grid: per level the non-empty cells in Z-order, each with the
largest impact below it and four bits that say which quarters are not empty. A
child is found by counting bits, so empty space takes none.

An item walks down the row paths of its terms together. A state is a range of
columns with each term's cell there; the sum of weight times maximum bounds the
score of every document in the range, and is the score where the range is one
document. States are taken best first, ``BEAM`` at a time; the walk ends when
the best one left cannot enter the item's top ``k``. A task keeps these tops from
block to block, so later blocks are mostly cut off near their roots.

Blocks are of at most ``BLOCK`` documents, so memory depends neither on the
corpus nor on how rows are spread. Documents are never shuffled: tasks return
``k`` rows per item. Items are held by tasks in groups of about ``GROUP_TERMS``
terms (any number of items makes more groups, gone through one by one).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.registry import query, table
from starloom.llm.text import LOWER, constants, hash_runs, mix, slices, utf8
from starloom.session import reliable_checkpoint

TOP = 10
BLOCK = 1 << 12  # documents per grid
BEAM = 32  # states taken at once
GROUP_TERMS = 1 << 16

#: What separates terms, for bytes and as a pattern; the formula's numbers.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
INSIDE = np.ones(256, bool)
INSIDE[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
INSIDE[[*range(ord("A"), ord("Z") + 1)]] = True  # folded before they are looked up
K_TENTHS, B_PERCENT, SCALE = 8, 90, 1_000_000_000

_VALUE = constants(256, 41) * INSIDE


def _terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts, and each text's first term."""
    inside = INSIDE[raw]
    raw = LOWER[raw]
    n = len(raw)
    cuts = offsets[(offsets > 0) & (offsets < n)]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[cuts] = inside[cuts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(opens)
    hashes = hash_runs(raw, starts, np.flatnonzero(closes) + 1, _VALUE) if n else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(starts, offsets)


def term_hashes(terms: list[str]) -> np.ndarray:
    """What ``_terms`` has for these terms."""
    raw = [t.encode() for t in terms]
    ends = np.cumsum([len(t) for t in raw], dtype=np.int64)
    data = np.frombuffer(b" ".join(raw), np.uint8)
    ends += np.arange(len(raw))
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(raw) else ends
    return hash_runs(data, starts, ends, _VALUE) if len(raw) else np.zeros(0, np.uint64)


def _postings(batches: Iterator[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per document its number of terms, and numbers and frequencies of those in ``known``."""
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, first = _terms(*utf8(part.column("text")))
            text = np.repeat(np.arange(part.num_rows), np.diff(first))
            at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
            hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
            keys, tf = np.unique(text[hit] * max(1, len(known)) + at[hit], return_counts=True)
            of = keys // max(1, len(known))
            cuts = pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.ListArray.from_arrays(cuts, pa.array(keys - of * max(1, len(known)), pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int32())),
                ],
                ["doc_id", "n", "terms", "tf"],
            )


def _frequencies(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """``(term, df, n)``: documents of a task that hold each term; under term -1
    those with any term at all, and the number of their terms."""
    df, docs, n = np.zeros(width, np.int64), 0, 0
    for batch in batches:
        df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=width)
        sizes = batch.column("n").to_numpy()
        docs, n = docs + int((sizes > 0).sum()), n + int(sizes.sum())
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(([-1], some)), pa.int32()),
            pa.array(np.concatenate(([docs], df[some])), pa.int64()),
            pa.array(np.concatenate(([n], np.zeros(len(some)))), pa.int64()),
        ],
        ["term", "df", "n"],
    )


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits of numbers, with a zero before each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


_BITS = np.array([bin(k).count("1") for k in range(16)], np.int32)


class Treap:
    """A quadtree with maxima over the cells ``(row, column, impact)``, none repeated."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, height: int):
        self.height = height
        code = _spread(rows) << np.uint64(1) | _spread(columns)
        order = np.argsort(code)
        code, best = code[order], impacts[order].astype(np.int64)
        levels = [(np.zeros(len(code), np.uint8), best)]
        for _ in range(height):
            above = code >> np.uint64(2)
            first = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1]))) if len(code) else np.zeros(0, int)
            quarter = np.uint8(1) << (code & np.uint64(3)).astype(np.uint8)
            best = np.maximum.reduceat(best, first) if len(code) else best
            levels.append((np.bitwise_or.reduceat(quarter, first) if len(code) else quarter, best))
            code = above[first]
        levels.reverse()
        # Nodes of all levels in one row; children follow each other in Z-order.
        self.quarters = np.concatenate([q for q, _ in levels])
        self.best = np.concatenate([b for _, b in levels])
        counts = _BITS[self.quarters]
        roots = len(levels[0][0])
        self.first = np.cumsum(counts) - counts + roots
        self.empty = roots == 0

    def children(self, nodes: np.ndarray, row_bits: np.ndarray, column_bit: int) -> np.ndarray:
        """The quarters of ``nodes`` (-1: none) in these halves; -1 where empty."""
        quarter = (2 * row_bits + column_bit).astype(np.uint8)
        held = self.quarters[nodes]
        there = (nodes >= 0) & ((held >> quarter) & 1 == 1)
        before = _BITS[held & ((np.uint8(1) << quarter) - np.uint8(1))]
        return np.where(there, self.first[nodes] + before, -1)


def descend(
    treap: Treap, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, top: list[tuple], k: int, beam: int = BEAM
) -> list[tuple]:
    """``top`` with the columns of ``treap`` that belong among the best ``k``.

    ``top`` lists ``(-score, place, id)`` ascending; ``ids`` are the columns' places, ascending.
    """
    if treap.empty or not len(rows):
        return top
    height = treap.height
    path = (rows[None, :] >> (height - 1 - np.arange(height))[:, None]) & 1 if height else rows[None, :][:0]
    start = np.zeros(len(rows), np.int64)
    bound = int((treap.best[start] * weights).sum())
    heap = [(-bound, 0, 0, 0, start)]  # bound, first column, number, depth, cells
    made = 1
    top = list(top)

    def hopeless(negative: int, column: int) -> bool:
        return len(top) >= k and (negative, ids[column]) >= top[-1][:2]

    while heap:
        taken = []
        while heap and len(taken) < beam:
            state = heapq.heappop(heap)
            negative, column, _, depth, cells = state
            if negative == 0 or hopeless(negative, column):
                heap = []
                break
            if depth == height:
                top.append((negative, ids[column], column))
                top.sort(key=lambda t: t[:2])
                del top[k:]
            else:
                taken.append(state)
        if not taken:
            continue
        cells = np.array([s[4] for s in taken])
        depths = np.array([s[3] for s in taken])
        bits = path[depths]
        for half in (0, 1):
            below = treap.children(cells, bits, half)
            bounds = (np.where(below >= 0, treap.best[below], 0) * weights).sum(axis=1)
            for i in np.flatnonzero(bounds):
                _, column, _, depth, _ = taken[i]
                column += half << (height - 1 - depth)
                if column < len(ids) and not hopeless(-int(bounds[i]), column):
                    heapq.heappush(heap, (-int(bounds[i]), column, made, depth + 1, below[i]))
                    made += 1
    return top


def _search(
    batches: Iterator[pa.RecordBatch], items: list[list[int]], weights: np.ndarray, n_docs: int, length: int, k: int
) -> Iterator[pa.RecordBatch]:
    """``(item, doc_id, score)``: a task's best documents of each item."""
    width = len(weights)
    rows = [np.array(sorted(own), np.int64) for own in items]
    tops: list[list[tuple]] = [[] for _ in items]
    missing = 1 << 63  # a document without id comes after all others

    def block(parts: list[pa.RecordBatch]) -> None:
        held = pa.Table.from_batches(parts).combine_chunks()
        given = held.column("doc_id").to_pylist()
        order = sorted(range(len(given)), key=lambda i: (given[i] is None, given[i] or 0))
        held = held.take(order).combine_chunks()
        ids = [missing if given[i] is None else given[i] for i in order]
        lists = held.column("terms").chunk(0) if len(ids) else pa.array([], pa.list_(pa.int32()))
        sizes = np.diff(lists.offsets.to_numpy())
        column = np.repeat(np.arange(len(ids)), sizes)
        term = lists.flatten().to_numpy().astype(np.int64)
        tf = held.column("tf").chunk(0).flatten().to_numpy().astype(np.int64)
        n = held.column("n").to_numpy().astype(np.int64)[column]
        m = 100 - B_PERCENT + (B_PERCENT * n * n_docs) // max(1, length)
        impact = (SCALE * tf) // (1000 * tf + K_TENTHS * m)
        good = impact > 0
        height = max(1, int(max(width - 1, len(ids) - 1, 1)).bit_length())
        treap = Treap(term[good], column[good], impact[good], height)
        for i, own in enumerate(rows):
            found = descend(treap, own, weights[own], ids, [(s, d, None) for s, d, _ in tops[i]], k)
            tops[i] = [(s, d, None) for s, d, _ in found]

    parts, size = [], 0
    for batch in batches:
        begin = 0
        while begin < batch.num_rows:
            piece = batch.slice(begin, min(batch.num_rows - begin, BLOCK - size))
            parts.append(piece)
            size, begin = size + piece.num_rows, begin + piece.num_rows
            if size == BLOCK:
                block(parts)
                parts, size = [], 0
    if size:
        block(parts)
    out = [(i, None if d == missing else d, -s) for i, top in enumerate(tops) for s, d, _ in top]
    yield pa.RecordBatch.from_pylist(
        [{"item": i, "doc_id": d, "score": s} for i, d, s in out],
        pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())]),
    )


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, terms)``: distinct terms of each item, rows of one id together."""
    upper = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
    folded = F.translate(F.coalesce("text", F.lit("")), upper, upper.lower())
    terms = F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)))
    return (
        items.select("item_id", F.explode(terms).alias("term"))
        .groupBy("item_id")
        .agg(F.collect_set("term").alias("terms"))
    )


def search(docs: DataFrame, items: DataFrame, *, k: int = TOP, group_terms: int = GROUP_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``; further columns
    are not read. The score is an integer form of BM25, see the module's numbers.
    NULL, empty and termless texts match nothing and count for nothing. Repeated
    rows of ``docs`` are documents of their own, one without doc_id comes last
    among equal scores; rows of ``items`` with the same id (NULL too) are one item
    of all their terms. Empty tables give no rows.

    Terms are compared by 64-bit hashes, with a chance of 2**-64 per pair to err.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    queries = reliable_checkpoint(item_terms(items))
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, -(-total // group_terms))
    found = None
    for g in range(groups):
        own = queries.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).collect()
        if not own and g < groups - 1:
            continue
        terms = sorted({t for r in own for t in r.terms})
        hashes = term_hashes(terms)
        known, number = np.unique(hashes, return_inverse=True)
        number = dict(zip(terms, number.tolist(), strict=True))
        postings = reliable_checkpoint(
            docs.mapInArrow(
                partial(_postings, known=known), "doc_id bigint, n bigint, terms array<int>, tf array<int>"
            )
        )
        counts = (
            postings.select("terms", "n")
            .mapInArrow(partial(_frequencies, width=len(known)), "term int, df bigint, n bigint")
            .groupBy("term")
            .agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
            .collect()  # a row per term of the group
        )
        df = {r.term: r.df for r in counts}
        n_docs, length = df.pop(-1, 0), sum(r.n for r in counts)
        weights = np.zeros(len(known), np.int64)
        for t, c in df.items():
            weights[t] = floor(1000 * log((2 * n_docs + 2) / (2 * c + 1)))
        # Rows of like weight lie together, so that a quarter's maximum says more.
        order = np.argsort(-weights, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        paths = [[int(place[number[t]]) for t in r.terms if weights[number[t]] > 0] for r in own]
        best = postings.mapInArrow(
            partial(
                _placed_search,
                place=place,
                items=paths,
                weights=weights[order],
                n_docs=n_docs,
                length=length,
                k=k,
            ),
            "item int, doc_id bigint, score bigint",
        )
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(own)], _names(items))
        best = reliable_checkpoint(best).join(names, "item").drop("item")
        found = best if found is None else found.union(best)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def _names(items: DataFrame) -> str:
    return f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"


def _placed_search(batches: Iterator[pa.RecordBatch], place: np.ndarray, **options) -> Iterator[pa.RecordBatch]:
    """``_search`` with each term under its row of the grid."""

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("terms")
        rows = pa.array(place[lists.flatten().to_numpy()], pa.int32()) if len(place) else lists.flatten()
        cuts = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
        k = batch.schema.get_field_index("terms")
        return batch.set_column(k, "terms", pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows))

    return _search(map(placed, batches), **options)


SQL = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents),
totals AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM docs WHERE len(t) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf
       FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM docs) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, totals GROUP BY term, docs),
items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
scores AS (
    SELECT item_id, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
    FROM items JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query("op12_treap_search", SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
