"""Token ids as fixed-width bits: sharded files in order of doc_id.

Layout of a shard, numbers little-endian: ``MAGIC``; then blocks of ids, each id
in the fewest bits that hold the vocabulary, the least significant first, each
block from a whole byte on; then the footer, numpy arrays one after the other:

=========== ======= ===================================================
doc_id      int64   0 where there is none
has_id      uint8   whether there is one
start       uint64  first id of each document in the shard, and the end
block       uint64  byte where each block begins, and the end
=========== ======= ===================================================

and at the very end ``TAIL``: footer place, documents, ids, ids per block, bits.
Any document is found by one look into ``start`` and one into ``block``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.bpe import public_path
from starloom.llm.files import committed, locate, new_folder, task_file, task_number
from starloom.llm.registry import query, table
from starloom.llm.text import slices
from starloom.llm.vocab import word_vocab
from starloom.session import reliable_checkpoint

MAGIC = b"TOKBITS1"
TAIL = "<QQQII"
BLOCK = 1 << 16  # ids
UNIT = 1 << 20  # ids read by one row of the manifest, if no document has more
END_ID = 2


def width(vocabulary: int) -> int:
    """Bits for ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits per id, from the lowest bit of the first byte on."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    cells = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(cells[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    cells = np.zeros((n, 32), np.uint8)
    raw = np.frombuffer(data, np.uint8)
    cells[:, :bits] = np.unpackbits(raw, count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(cells.reshape(-1), bitorder="little").view("<u4")


class Shard:
    """Random access to a shard file."""

    def __init__(self, uri: str):
        system, path = locate(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(struct.calcsize(TAIL), size - struct.calcsize(TAIL))
        self.footer, self.docs, self.ids, self.per_block, self.bits = struct.unpack(TAIL, tail)
        blocks = -(-self.ids // self.per_block)
        self.at_start = self.footer + 9 * self.docs
        self.at_block = self.at_start + 8 * (self.docs + 1)
        self.block_count = blocks

    def _array(self, at: int, kind: str, first: int, n: int) -> np.ndarray:
        k = np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at(n * k, at + first * k), kind)

    def index(self, first: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc_id, has_id and start (one more) of ``n`` documents."""
        return (
            self._array(self.footer, "<i8", first, n),
            self._array(self.footer + 8 * self.docs, "u1", first, n),
            self._array(self.at_start, "<u8", first, n + 1).astype(np.int64),
        )

    def read(self, begin: int, end: int) -> np.ndarray:
        """The shard's ids from ``begin`` up to ``end``."""
        if end <= begin:
            return np.zeros(0, "<u4")
        a, b = begin // self.per_block, -(-end // self.per_block)
        places = self._array(self.at_block, "<u8", a, b - a + 1).astype(np.int64)
        data = self.file.read_at(int(places[-1] - places[0]), int(places[0]))
        out = []
        for k in range(a, b):
            n = min(self.per_block, self.ids - k * self.per_block)
            out.append(unpack(data[places[k - a] - places[0] : places[k - a + 1] - places[0]], n, self.bits))
        return np.concatenate(out)[begin - a * self.per_block : end - a * self.per_block]


def _write(
    batches: Iterator[pa.RecordBatch], path: str, folder: str, end_id: int
) -> Iterator[pa.RecordBatch]:
    vocab = word_vocab(path)
    bits = width(vocab.size)
    docs: list[int | None] = []
    sizes: list[int] = []
    blocks = [len(MAGIC)]
    held: list[np.ndarray] = []
    n_held = 0
    uri = task_file(folder, "shard", "bits")
    end = np.array([end_id], np.uint32)
    with committed(uri) as out:
        out.write(MAGIC)
        for batch in batches:
            for part in slices(batch, "text"):
                docs += part.column("doc_id").to_pylist()
                for text in part.column("text").to_pylist():
                    ids = np.concatenate((vocab.encode(text or ""), end))
                    sizes.append(len(ids))
                    held.append(ids)
                    n_held += len(ids)
                if n_held >= BLOCK:
                    ids = np.concatenate(held)
                    whole = n_held - n_held % BLOCK
                    for k in range(0, whole, BLOCK):
                        data = pack(ids[k : k + BLOCK], bits)
                        out.write(data)
                        blocks.append(blocks[-1] + len(data))
                    held, n_held = [ids[whole:]], n_held - whole
        if n_held:
            data = pack(np.concatenate(held), bits)
            out.write(data)
            blocks.append(blocks[-1] + len(data))
        starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        out.write(np.array([d or 0 for d in docs], "<i8").tobytes())
        out.write(np.array([d is not None for d in docs], "u1").tobytes())
        out.write(starts.astype("<u8").tobytes())
        out.write(np.array(blocks, "<u8").tobytes())
        out.write(struct.pack(TAIL, blocks[-1], len(docs), int(starts[-1]), BLOCK, bits))
    cuts = [0]
    while cuts[-1] < len(docs):
        far = int(np.searchsorted(starts, starts[cuts[-1]] + UNIT, side="right")) - 1
        cuts.append(min(len(docs), max(cuts[-1] + 1, far)))
    a, b = np.array(cuts[:-1], np.int64), np.array(cuts[1:], np.int64)
    if len(a):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([task_number()] * len(a), pa.int64()),
                pa.array([uri] * len(a)),
                pa.array(a),
                pa.array(b - a),
                pa.array(starts[b] - starts[a]),
            ],
            ["shard", "uri", "first_doc", "n_docs", "n_ids"],
        )


MANIFEST = "shard bigint, uri string, first_doc bigint, n_docs bigint, n_ids bigint"


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_ids(docs: DataFrame, path: str, end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Encode ``docs`` (``doc_id, text``; other columns are not read) into shards.

    Documents are in ascending order of doc_id over all shards, rows without one
    first and rows that repeat one in the order of their texts' hashes. NULL and
    empty texts have the end id only. No rows: no shards. Returns the manifest,
    a stored table of units ``(shard, uri, first_doc, n_docs, n_ids)``.

    The texts are dealt out by ranges before they are encoded, so that the
    sample for the ranges does not encode them. A doc_id that many rows share is
    split between shards by the hash.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash").asc()]
    rows = docs.select("doc_id", "text").withColumn("_hash", F.xxhash64("text"))
    dealt = rows.repartitionByRange(shards or shuffle_parts(spark), *order)
    return reliable_checkpoint(
        dealt.sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(partial(_write, path=path, folder=folder, end_id=end_id), MANIFEST)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for unit in batch.to_pylist():
            shard = Shard(unit["uri"])
            docs, known, starts = shard.index(unit["first_doc"], unit["n_docs"])
            ids = shard.read(int(starts[0]), int(starts[-1]))
            at = starts - starts[0]
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, mask=known == 0), pa.array(unit["base"] + at[:-1]), lists],
                ["doc_id", "start", "ids"],
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy().astype("<u4")
        ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        sums = [crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("start"),
                pa.array(np.diff(ends).astype(np.int64)),
                pa.array(sums, pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def units_with_base(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids before each unit.

    Units are summed within their shard. Only shards, one per task of the write,
    are summed in one task and broadcast.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("shard").orderBy("first_doc").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    shards = shards.select("shard", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    inner: Column = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    placed = manifest.withColumn("_inner", inner).join(F.broadcast(shards), "shard")
    return placed.select(*manifest.columns, (F.col("_before") + F.col("_inner")).alias("base"))


def read_ids(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, ids)`` per document, read from the shards by units."""
    spark = manifest.sparkSession
    units = units_with_base(manifest).repartition(shuffle_parts(spark), "shard", "first_doc")
    return units.mapInArrow(_read, "doc_id bigint, start bigint, ids array<int>")


@query("op10_token_bits")
def _(spark: SparkSession, sf: str) -> DataFrame:
    manifest = write_ids(table(spark, sf, "documents"), public_path("word_bpe_49k.json"))
    return read_ids(manifest).mapInArrow(
        _digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
