"""WARC records in seekable Zstandard bundles, with revisits for equal payloads.

A bundle is a Zstandard file of independent frames of about ``FRAME`` bytes of
records each, followed by a seek table in a skippable frame as the public
seekable format lays it out (per frame its compressed and decompressed size;
frame count, a zero byte and the magic number at the end). Any decompressor
reads the file as a whole; a record is read by decompressing its frame alone.
The catalogue maps every record identifier to its bundle, frame, and place
within the decompressed frame.

A response holds the HTTP header and the payload; a revisit holds the header
only (with the payload's length) and names the record it repeats.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import partial
from hashlib import sha1

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.files import committed, locate, new_folder, task_file, task_number
from starloom.llm.pack import shuffle_parts
from starloom.llm.registry import query, table
from starloom.llm.text import slices
from starloom.session import reliable_checkpoint

FRAME = 1 << 20
LEVEL = 3
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def record(
    record_id: str, uri: str, date: str, digest: str, payload: bytes, refers_to: str | None
) -> bytes:
    """One WARC/1.1 record; with ``refers_to`` a revisit without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {''.join(uri.split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header (names in lower case) and payload of a record."""
    def fields(lines: bytes) -> dict[str, str]:
        pairs = (x.partition(":") for x in lines.decode().split("\r\n")[1:])
        return {k.strip().lower(): v.strip() for k, _, v in pairs}

    head, _, rest = data.partition(b"\r\n\r\n")
    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", a, b) for a, b in sizes)
    foot = struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body) + len(foot)) + body + foot


class Bundle:
    """Random access to a bundle by its seek table."""

    def __init__(self, uri: str):
        system, path = locate(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"no seek table: {uri}")
        table_ = np.frombuffer(self.file.read_at(8 * n, size - 9 - 8 * n), "<u4").reshape(n, 2)
        self.sizes = table_.astype(np.int64)
        self.places = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))

    def frame(self, k: int) -> bytes:
        data = self.file.read_at(int(self.sizes[k, 0]), int(self.places[k]))
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=int(self.sizes[k, 1]))


CATALOGUE = (
    "record_id string, page_id bigint, bundle string, frame int, offset bigint, length bigint"
)


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    number = task_number()
    uri = task_file(folder, "bundle", "warc.zst")
    packer = zstandard.ZstdCompressor(level=LEVEL)
    rows: list[tuple] = []
    sizes: list[tuple[int, int]] = []
    held: list[bytes] = []
    n_held = n_rows = 0
    with committed(uri) as out:

        def close() -> None:
            nonlocal held, n_held
            if held:
                data = packer.compress(b"".join(held))
                out.write(data)
                sizes.append((len(data), n_held))
                held, n_held = [], 0

        for batch in batches:
            for part in slices(batch, "html"):
                for p in part.to_pylist():
                    name = f"urn:page:{number}-{n_rows}" if p["page_id"] is None else f"urn:page:{p['page_id']}"
                    digest = base64.b32encode(bytes.fromhex(p["digest"])).decode()
                    other = None if p["refers_to"] is None else f"urn:page:{p['refers_to']}"
                    data = record(name, p["url"] or "", date, digest, (p["html"] or "").encode(), other)
                    if n_held and n_held + len(data) > FRAME:
                        close()
                    rows.append((name, p["page_id"], uri, len(sizes), n_held, len(data)))
                    held.append(data)
                    n_held += len(data)
                    n_rows += 1
            if len(rows) >= 10_000:
                yield _catalogue(rows)
                rows = []
        close()
        out.write(seek_table(sizes))
    yield _catalogue(rows)


def _catalogue(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["record_id", "page_id", "bundle", "frame", "offset", "length"],
    )


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with payload ``size``, ``digest`` (hexadecimal SHA-1), and the page each
    revisit ``refers_to``.

    Of equal payloads of at least ``least`` bytes the largest page_id is the
    response. Only digests that repeat are joined back, one row each, with a
    key that lets a hot digest's pages be split.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    described = pages.select(
        "page_id", "url", "html", F.octet_length(payload).alias("size"), F.sha1(payload).alias("digest")
    )
    kept = reliable_checkpoint(
        described.where(F.col("size") >= least)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.max("page_id").alias("_kept"), F.count("*").alias("_n"))
        .where("_n > 1 and _kept is not null")
        .select("_digest", "_kept")
    )
    joined = described.join(kept, F.col("digest") == F.col("_digest"), "left")
    other = (F.col("page_id") != F.col("_kept")) | F.col("page_id").isNull()
    return joined.withColumn("refers_to", F.when(other, F.col("_kept"))).drop("_digest", "_kept")


def write_bundles(pages: DataFrame, least: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (``page_id, url, html``; further columns
    are not read) and return the catalogue, a stored table ``(record_id, page_id,
    bundle, frame, offset, length)``.

    A NULL html is an empty payload, a NULL url an empty one. Rows without a
    page_id are named after their place; in a group of equal payloads they
    revisit the largest page_id. Rows that repeat the largest page_id with an
    equal payload are all responses. Rows that repeat a page_id share its record
    identifier; the catalogue has a place for each. An empty table writes no records.
    """
    folder = new_folder(pages.sparkSession, "warc")
    return reliable_checkpoint(
        with_revisits(pages, least).mapInArrow(partial(_write, folder=folder, date=date), CATALOGUE)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        bundle, at, frame, data = None, None, None, b""
        for r in batch.to_pylist():
            if r["bundle"] != at:
                bundle, at, frame = Bundle(r["bundle"]), r["bundle"], None
            if r["frame"] != frame:
                data, frame = bundle.frame(r["frame"]), r["frame"]
            warc, http, payload = parse_record(data[r["offset"] : r["offset"] + r["length"]])
            kind = warc["warc-type"]
            digest = warc["warc-payload-digest"].removeprefix("sha1:")
            if kind == "response" and base32_sha1(payload) != digest:
                raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
            other = warc.get("warc-refers-to", "").strip("<>").removeprefix("urn:page:")
            out.append(
                (
                    warc["warc-record-id"].strip("<>"),
                    r["page_id"],
                    int(http["content-length"]),
                    digest,
                    kind,
                    int(other) if other else None,
                    payload if kind == "response" else None,
                )
            )
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["record_id", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
        )


def read_records(catalogue: DataFrame) -> DataFrame:
    """The records of a catalogue, read from their frames: ``(record_id, page_id,
    payload_bytes, payload_digest, record_type, refers_to, payload)``. A revisit
    has no payload; its size and digest are those of the whole payload. A payload
    that does not match its digest fails the read.

    A bundle's frames are dealt out apart, so a large bundle is read in parallel.
    """
    n = shuffle_parts(catalogue.sparkSession)
    dealt = catalogue.repartition(n, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return dealt.mapInArrow(
        _read,
        "record_id string, page_id bigint, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint, payload binary",
    )


@query("op8_warc")
def _(spark: SparkSession, sf: str) -> DataFrame:
    catalogue = write_bundles(table(spark, sf, "pages"))
    return read_records(catalogue).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
