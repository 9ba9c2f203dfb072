import base64
import collections
import hashlib
from functools import partial

import pyarrow.fs as fs
import pytest
import zstandard
from pyspark.sql import functions as F

from starloom.llm import warc
from starloom.llm.files import locate
from starloom.session import drop_intermediates, intermediates


@pytest.fixture(scope="module")
def pages(spark):
    texts = ["<p>é" * n for n in (1, 1, 1, 5, 5, 900_000)] + ["", None, "a\r\n\r\nWARC/1.1\r\n", None]
    rows = [(k, f"http://x.example/{k} {k}" if k % 2 else None, t, "en") for k, t in enumerate(texts)]
    rows += [(None, "u", "<p>é", "x"), (None, None, "only here", "x"), (3, "u", "other page, same id", "x")]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)


def expected(rows, least):
    groups = collections.defaultdict(list)
    for k, _, html, _ in rows:
        groups[(html or "").encode()].append(k)
    for k, _, html, _ in rows:
        b = (html or "").encode()
        best = max((x for x in groups[b] if x is not None), default=None)
        repeat = len(b) >= least and len(groups[b]) > 1 and best is not None and k != best
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        yield (k, len(b), digest, "revisit" if repeat else "response", best if repeat else None)


@pytest.mark.parametrize("least", [0, 6])
def test_records_read_back(pages, least):
    rows, df = pages
    out = warc.read_records(warc.write_bundles(df, least)).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=str) == sorted(expected(rows, least), key=str)
    payloads = {(r.page_id, bytes(r.payload)) for r in out if r.payload is not None}
    assert payloads <= {(k, (t or "").encode()) for k, _, t, _ in rows}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in out)


def test_a_bundle_is_plain_zstandard_and_seekable(pages, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 1 << 12)
    catalogue = warc.write_bundles(pages[1]).collect()
    assert len({r.record_id for r in catalogue}) >= len(catalogue) - 1
    for uri in {r.bundle for r in catalogue}:
        system, path = fs.FileSystem.from_uri(uri)
        data = system.open_input_file(path).read()
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        bundle = warc.Bundle(uri)
        frames = [bundle.frame(k) for k in range(len(bundle.sizes))]
        assert b"".join(frames) == whole
        for r in catalogue:
            if r.bundle == uri:
                assert frames[r.frame][r.offset : r.offset + r.length].startswith(b"WARC/1.1\r\n")


def test_no_pages(pages):
    assert warc.read_records(warc.write_bundles(pages[1].where("page_id < 0"))).count() == 0


def test_a_task_that_runs_twice_leaves_its_first_file_whole(spark, pages, monkeypatch):
    """A second attempt, with its rows in another order, does not touch what the
    catalogue of the first one points to."""
    folder = warc.new_folder(spark, "warc")
    described = warc.with_revisits(pages[1]).coalesce(1)
    first, second = (
        df.mapInArrow(partial(warc._write, folder=folder, date="d"), warc.CATALOGUE)
        for df in (described.sortWithinPartitions("html"), described.sortWithinPartitions(F.desc("html")))
    )
    catalogue = spark.createDataFrame(first.collect(), warc.CATALOGUE)
    assert {r.bundle for r in second.collect()}.isdisjoint({r.bundle for r in catalogue.collect()})
    got = [
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in warc.read_records(catalogue).collect()
    ]
    assert sorted(got, key=str) == sorted(expected(pages[0], 0), key=str)


def test_bundles_go_with_the_intermediate_tables(spark, pages):
    before = intermediates()
    uris = {r.bundle for r in warc.write_bundles(pages[1]).collect()}
    drop_intermediates(spark, since=before)
    for uri in uris:
        system, path = locate(uri)
        assert system.get_file_info(path).type == fs.FileType.NotFound


def test_spark_names_of_s3_are_known():
    assert locate("s3a://bucket/a/b?region=x")[1] == "bucket/a/b"
