"""Near-duplicate documents: one-permutation MinHash, banded buckets, star edges.

A document's set is its distinct five-word shingles. One hash of each shingle
gives both its bin (high bits) and its rank within it; the least of each of
``BINS`` bins is the signature. An empty bin borrows from a full one, picked by
a random order of all bins that is the bin's own ("optimal densification"): two
sets then agree in a bin with a chance equal to their Jaccard similarity.

``BANDS`` bands of ``ROWS`` bins each: a pair at similarity 0.85 shares no
bucket with a chance of (1 - 0.85**6)**48 = 1.4e-10, one at 0.3 shares some with
3.4 %. Equal sets are one class from the start. Within a bucket every class is
paired with the smallest one only. Pairs that this may leave out, both in a
bucket and not yet in one component, are looked for by ``_left_out``, so no link
depends on the choice of the centre and no group is paired off as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.registry import query, table
from starloom.llm.text import constants, mix, shingle_sets, slices, utf8, words
from starloom.session import reliable_checkpoint

BANDS, ROWS = 48, 6
BINS = BANDS * ROWS
SHINGLE = 5
#: Link at intersection / union >= 85 / 100.
SHARE = 85


def _orders() -> np.ndarray:
    """For each bin (row) a random order of all bins."""
    keys = constants(BINS * BINS, 21).reshape(BINS, BINS)
    return np.argsort(keys, axis=1).astype(np.int16)


_ORDERS = _orders()
_MIX = constants(BINS, 22).reshape(BANDS, ROWS) | np.uint64(1)
_BAND = constants(BANDS, 23)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Densified one-permutation MinHash of an ascending non-empty hash set."""
    bins = (((shingles >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    out = np.zeros(BINS, np.uint64)
    full = np.zeros(BINS, bool)
    out[bins[first]] = shingles[first]
    full[bins[first]] = True
    empty = np.flatnonzero(~full)
    for width in (8, 64, BINS):  # few need to look far
        if not len(empty):
            break
        options = _ORDERS[empty, :width]
        hit = full[options]
        found = hit.any(axis=1)
        done = empty[found]
        out[done] = out[options[found, hit[found].argmax(axis=1)]]
        empty = empty[~found]
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """Bucket keys, one per band, of signatures stacked in rows."""
    cells = signatures.reshape(-1, BANDS, ROWS) * _MIX
    return mix(mix(cells).sum(axis=2, dtype=np.uint64) + _BAND).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(words(*utf8(part.column("text")), lower=True), SHINGLE)
            some = [s for s in sets if len(s)]
            keys = band_keys(np.array([signature(s) for s in some])) if some else np.zeros((0, BANDS))
            sizes = np.array([BANDS if len(s) else 0 for s in sets])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                        pa.array(keys.reshape(-1), pa.int64()),
                    ),
                ],
                ["doc_id", "n_shingles", "set_digest", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(words(*utf8(part.column("text")), lower=True), SHINGLE)
            begins = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.ListArray.from_arrays(
                        pa.array(begins, pa.int32()), pa.array(flat.view(np.int64), pa.int64())
                    ),
                ],
                ["node", "shingles"],
            )


def _verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough, each class by its document."""
    left = pairs.join(sets.toDF("a", "set_a"), "a")
    both = left.join(sets.toDF("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (
        both.select("a", "b", common.alias("n"), (F.size("set_a") + F.size("set_b")).alias("m"))
        .where(f"100 * n >= {SHARE} * (m - n)")
        .select("a", "b")
        .distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document.

    ``docs`` has ``doc_id`` and ``text``; further columns are not read. Texts
    that are NULL or have no word have no shingles and are linked with nothing:
    they are their own component and kept. So is a row without a doc_id, whose
    component is NULL. Rows that repeat a doc_id are one document where they
    are linked with others. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    sketch = reliable_checkpoint(
        docs.mapInArrow(
            _sketches,
            "doc_id bigint, n_shingles bigint, set_digest binary, bands array<bigint>",
        )
    )
    some = sketch.where("doc_id is not null and set_digest is not null")
    classes = reliable_checkpoint(
        some.groupBy("set_digest").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    )
    entries = classes.select(F.explode("bands").alias("bucket"), "node")
    centres = reliable_checkpoint(
        entries.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
        .where("centre < last")
        .select("bucket", "centre")
    )
    members = reliable_checkpoint(entries.join(centres, "bucket"))
    stars = reliable_checkpoint(
        members.where("node <> centre")
        .select(F.col("centre").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    # Merged whatever the size, so that the work grows evenly with the input.
    sets = reliable_checkpoint(
        docs.join(nodes.hint("merge"), "doc_id", "left_semi")
        .mapInArrow(_sets, "node bigint, shingles array<bigint>")
    )
    links = reliable_checkpoint(_verified(sets, stars))
    found = reliable_checkpoint(components(links))
    rest = reliable_checkpoint(_left_out(members, found, sets))
    if not rest.isEmpty():
        links = links.union(_verified(sets, rest))
        found = reliable_checkpoint(components(links))
    owner = reliable_checkpoint(
        classes.select("set_digest", "node")
        .join(found, "node", "left")
        .select("set_digest", F.coalesce("component", "node").alias("owner"))
    )
    return (
        sketch.select("doc_id", "n_shingles", "set_digest")
        .join(owner, "set_digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("owner", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _left_out(members: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs in different components that may be similar enough, by prefix filter.

    It looks at the classes of buckets that still hold several components, for
    instance thousands of copies that are each a little too far from the
    others. Shingles are put in order of rarity among them. With ``|a| <= |b|``
    a linked pair shares at least ``170/185 |a|`` and ``85/100 |b|`` shingles, so
    the rarest ``|a| - ceil(170/185 |a|) + 1`` of ``a`` and the rarest ``|b| -
    ceil(85/100 |b|) + 1`` of ``b`` have one in common, and the first of these
    stands early enough in both for their sizes. Edits make rare shingles, so
    texts that differ by more do not meet: no link is lost, and no group is
    paired off as a whole.
    """
    placed = members.join(found, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    mixed = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
        .where("lo < hi and n > 2")
        .select("bucket")
    )
    open_ = placed.join(mixed, "bucket").select("node", "component").distinct()
    own = reliable_checkpoint(
        open_.join(sets, "node").select(
            "node", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("s")
        )
    )
    often = reliable_checkpoint(own.groupBy("s").agg(F.count("*").alias("often")))
    ranked = own.join(often, "s").withColumn(
        "place", F.row_number().over(Window.partitionBy("node").orderBy("often", "s"))
    )
    prefix = reliable_checkpoint(
        ranked.where(f"place <= n - ceil({SHARE} * n / 100) + 1 and often > 1")
    )
    side = prefix.select("s", "node", "component", "n", "place")
    a = side.toDF("s", "a", "c_a", "n_a", "at_a")
    b = side.toDF("s", "b", "c_b", "n_b", "at_b")
    met = reliable_checkpoint(_meetings(prefix))
    return (
        a.join(met, ["s", "c_a", "n_a"])
        .where(_early("a"))
        .join(b, ["s", "c_b", "n_b"])
        .where(_early("b"))
        .select("a", "b")
        .distinct()
    )


def _early(side: str) -> str:
    """Whether a shingle stands early enough in a set to be the first that a
    linked pair of sets of ``n_a`` and ``n_b`` shingles has in common."""
    return f"at_{side} <= n_{side} - ceil({SHARE} * (n_a + n_b) / {100 + SHARE}) + 1"


def _meetings(prefix: DataFrame) -> DataFrame:
    """``(s, c_a, n_a, c_b, n_b)``: sets of ``n_a`` shingles of one component and of
    ``n_b`` of another that some pair may be linked by shingle ``s``.

    The sets of one size in a component count once, with the earliest place of
    the shingle; so every row stands for at least one pair that has to be looked at.
    """
    at = reliable_checkpoint(prefix.groupBy("s", "component", "n").agg(F.min("place").alias("at")))
    a, b = at.toDF("s", "c_a", "n_a", "at_a"), at.toDF("s", "c_b", "n_b", "at_b")
    return (
        a.join(b, "s")
        .where("n_a < n_b and c_a <> c_b or n_a = n_b and c_a < c_b")
        .where(f"100 * n_a >= {SHARE} * n_b and {_early('a')} and {_early('b')}")
        .select("s", "c_a", "n_a", "c_b", "n_b")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the near-duplicates of a kept document."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


@query("op2_near_dedup")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))
