"""Byte-level BPE encoding by tree concatenation, and decoding.

Texts of more than ``leaf_chars`` characters are cut into pieces wherever that
falls, also where nothing splits the text. Pieces of all texts are dealt to all
tasks and encoded there; those of a text meet again and are joined pairwise as
a tree. At each join a window of text around it is encoded anew and grown until
it agrees with both sides:

* Where a text is split depends on a few characters next to the place only (or
  on a special token's), so that a side's splits hold but for ``MARGIN`` bytes
  next to its ends.
* A sequence of tokens is a word's encoding if every two neighbours are the
  encoding of their concatenation. If window and side share a token beyond the
  margins, the side's tokens up to it and the window's from it on are valid
  pairs, hence the encoding of the whole.

A window that has grown to both whole sides is an encoding without a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.registry import query, table
from starloom.llm.text import slices
from starloom.llm.vocab import ByteVocab, byte_vocab

LEAF_CHARS = 16384
WINDOW = 512  # bytes on each side of a join, at first
MARGIN = 64  # bytes; more is added for special tokens

Piece = tuple[bytes, np.ndarray]


def _aligned(data: bytes, at: int, step: int) -> int:
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at += step
    return at


def _agreed(
    ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray, sizes: np.ndarray, low: int, high: int
) -> int | None:
    """End of a token that both have at the same place within ``low`` and ``high``."""
    _, i, j = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    ends = ends_a[i]
    same = (ids_a[i] == ids_b[j]) & (ends <= high) & (ends - sizes[ids_a[i]] >= low)
    return int(ends[same][0]) if same.any() else None


def join_pieces(vocab: ByteVocab, left: Piece, right: Piece) -> Piece:
    """The encoding of two pieces' concatenation from theirs."""
    sizes, margin = vocab.token_bytes, MARGIN + vocab.longest_special
    (text_l, ids_l), (text_r, ids_r) = left, right
    cut, n = len(text_l), len(text_l) + len(text_r)
    reach = WINDOW
    while True:
        a = _aligned(text_l, max(0, cut - reach), -1)
        b = _aligned(text_r, min(len(text_r), reach), 1) + cut
        window = vocab.encode((text_l[a:] + text_r[: b - cut]).decode())
        ends = a + np.cumsum(sizes[window])
        near_l, near_r = ids_l[-(cut - a) :] if a < cut else ids_l[:0], ids_r[: b - cut]
        ends_l = cut - np.concatenate((np.cumsum(sizes[near_l][::-1])[::-1][1:], [0]))[: len(near_l)]
        ends_r = cut + np.cumsum(sizes[near_r])
        p = 0 if a == 0 else _agreed(near_l, ends_l, window, ends, sizes, a + margin, cut - margin)
        q = n if b == n else _agreed(near_r, ends_r, window, ends, sizes, cut + margin, b - margin)
        if p is not None and q is not None:
            keep_l = len(ids_l) - int((ends_l > p).sum()) if a else 0
            from_r = int((ends_r <= q).sum()) if b < n else len(ids_r)
            middle = window[(ends > p) & (ends <= q)]
            return text_l + text_r, np.concatenate((ids_l[:keep_l], middle, ids_r[from_r:]))
        reach *= 2


def join_tree(vocab: ByteVocab, pieces: list[Piece]) -> Piece:
    """All pieces of a text joined, neighbours first, level by level."""
    while len(pieces) > 1:
        pairs = zip(pieces[::2], pieces[1::2], strict=False)
        pieces = [join_pieces(vocab, a, b) for a, b in pairs] + pieces[len(pieces) & ~1 :]
    return pieces[0]


def _id_lists(lists: list[np.ndarray]) -> pa.Array:
    begins = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    flat = np.concatenate(lists) if lists else np.zeros(0, np.uint32)
    return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(flat.astype(np.int32)))


def _encoded(
    batches: Iterator[pa.RecordBatch], path: str, column: str, out: str, keep: bool = True
) -> Iterator[pa.RecordBatch]:
    """Ids of the texts, and the texts if ``keep``, else NULL in their place."""
    vocab = byte_vocab(path)
    for batch in batches:
        for part in slices(batch, column):
            ids = _id_lists([vocab.encode(t or "") for t in part.column(column).to_pylist()])
            columns = [
                part.column(c) if keep or c != column else pa.nulls(part.num_rows, pa.string())
                for c in part.schema.names
            ]
            yield pa.RecordBatch.from_arrays([*columns, ids], [*part.schema.names, out])


def _cut(
    batches: Iterator[pa.RecordBatch], column: str, row: str, leaf: int
) -> Iterator[pa.RecordBatch]:
    """A row per piece; the other columns go with the first."""
    for batch in batches:
        for part in slices(batch, column):
            texts = part.column(column).to_pylist()
            pieces = [(k, at, t[at : at + leaf]) for k, t in enumerate(texts) for at in range(0, len(t), leaf)]
            first = pa.array([k if at == 0 else None for k, at, _ in pieces], pa.int64())
            every = pa.array([k for k, _, _ in pieces], pa.int64())
            columns = [
                part.column(c).take(every if c == row else first)
                if c != column
                else pa.array([p for _, _, p in pieces], pa.string())
                for c in part.schema.names
            ]
            at = pa.array([at for _, at, _ in pieces], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, at], [*part.schema.names, "__bpe_at"])


def _joined(group: pa.Table, path: str, column: str, out: str, names: list[str]) -> pa.Table:
    """The rows of a text from its pieces, whose texts are what their ids spell."""
    vocab = byte_vocab(path)
    group = group.sort_by("__bpe_at").combine_chunks()
    at = group.column("__bpe_at").to_numpy()
    n = int((at == 0).sum())  # rows with this text, each with a copy of all pieces
    ids = group.column(out).combine_chunks().take(pa.array(np.arange(0, len(at), n)))
    flat = ids.flatten().to_numpy()
    begins = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy())))
    parts = [flat[a:b].astype(np.uint32) for a, b in zip(begins[:-1], begins[1:], strict=True)]
    pieces = [(vocab.core.decode_bytes(p.tolist()), p) for p in parts]
    text, whole = join_tree(vocab, pieces)
    rows = group.slice(0, n)
    columns = [
        _id_lists([whole] * n)
        if c == out
        else (pa.array([text.decode()] * n) if c == column else rows.column(c))
        for c in names
    ]
    return pa.table(columns, names=names)


def _row_key(docs: DataFrame, column: str) -> Column:
    """What a row's pieces meet by: its text, its plain other columns, its partition.

    It does not depend on the order of rows, which a task run again behind a
    shuffle may change. Rows alike in all that share a key: their text is joined
    once and each of them gets the result.
    """
    others = [
        F.col(f"`{f.name}`")
        for f in docs.schema.fields
        if f.name != column and isinstance(f.dataType, T.AtomicType)
    ]
    text = F.sha2(F.col(column).cast("binary"), 256)
    return F.concat_ws("-", text, F.xxhash64(F.lit(0), *others), F.spark_partition_id())


def encode(
    docs: DataFrame, path: str, column: str = "text", out: str = "ids", leaf_chars: int = LEAF_CHARS
) -> DataFrame:
    """``docs`` with the ids of ``column`` as ``out`` (an earlier column of this name goes).

    Special tokens written in a text are encoded as such, none are added. NULL
    and empty texts have no ids. Rows keep all their columns and their number,
    repeated ones too; columns that begin with ``__bpe_`` are reserved.
    """
    docs = docs.drop(out) if out in docs.columns else docs
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields])
    ids = T.StructField(out, T.ArrayType(T.IntegerType()))
    long_text = F.coalesce(F.length(column) > leaf_chars, F.lit(False))
    short = docs.where(~long_text).mapInArrow(
        partial(_encoded, path=path, column=column, out=out), T.StructType([*schema, ids])
    )
    cut = docs.where(long_text).withColumn("__bpe_row", _row_key(docs, column))
    key, at = T.StructField("__bpe_row", T.StringType()), T.StructField("__bpe_at", T.LongType())
    pieces = cut.mapInArrow(
        partial(_cut, column=column, row="__bpe_row", leaf=leaf_chars),
        T.StructType([*schema, key, at]),
    ).repartition("__bpe_row", "__bpe_at")
    leaves = pieces.mapInArrow(
        partial(_encoded, path=path, column=column, out=out, keep=False),
        T.StructType([*schema, key, at, ids]),
    )
    names = [*docs.columns, out]

    def joined(group):  # not a partial: its kind is told from its parameters
        return _joined(group, path, column, out, names)

    return short.union(
        leaves.groupBy("__bpe_row").applyInArrow(joined, T.StructType([*schema, ids]))
    )


def _decoded(
    batches: Iterator[pa.RecordBatch], path: str, column: str, out: str
) -> Iterator[pa.RecordBatch]:
    vocab = byte_vocab(path)
    for batch in batches:
        lists = batch.column(column)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        begins = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())))
        texts = [
            vocab.decode(flat[begins[k] : begins[k + 1]]) if lists[k].is_valid else None
            for k in range(len(lists))
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out]
        )


def decode(df: DataFrame, path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids in ``column`` as ``out``, special tokens written out.

    NULL stays NULL, no ids give an empty text, and ids that are no token are
    left out; bytes that are no UTF-8 become U+FFFD.
    """
    df = df.drop(out) if out in df.columns else df
    schema = [T.StructField(f.name, f.dataType) for f in df.schema.fields]
    return df.mapInArrow(
        partial(_decoded, path=path, column=column, out=out),
        T.StructType([*schema, T.StructField(out, T.StringType())]),
    )


def public_path(name: str) -> str:
    """Where an installed public vocabulary is."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_bpe")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = public_path("byte_bpe_50k.json")
    ids = encode(table(spark, sf, "documents").select("doc_id", "text"), path).select("doc_id", "ids")
    return decode(ids, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
