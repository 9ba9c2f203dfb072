import hashlib
import random

import pytest
from pyspark.sql import functions as F

from starloom.llm import bpe, pack
from starloom.llm.vocab import byte_vocab, word_vocab

tokenizers = pytest.importorskip("tokenizers")
BYTE = bpe.public_path("byte_bpe_50k.json")
WORD = bpe.public_path("word_bpe_49k.json")
ALPHABETS = ["abcdefgh", "ab '’s\n\t  12é日  'tll!?#🙂", " \n", "é日🙂", "'s", "the and of ing "]


@pytest.fixture(scope="module")
def library():
    return {p: tokenizers.Tokenizer.from_file(p) for p in (BYTE, WORD)}


def expected(library, path, texts):
    return [e.ids for e in library[path].encode_batch_fast(list(texts), add_special_tokens=False)]


def random_texts(n, seed):
    rng = random.Random(seed)
    for k in range(n):
        t = "".join(rng.choices(rng.choice(ALPHABETS), k=rng.randint(0, 900)))
        at = rng.randint(0, len(t))
        yield t[:at] + "<|endoftext|>" * (k % 3 == 0) + t[at:]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_every_code_point_as_the_library_has_it(library, path):
    vocab = byte_vocab(path) if path == BYTE else word_vocab(path)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    points = points if path == BYTE else points[:0x3000]
    for k in range(0, len(points), 50_000):
        texts = [f"a{c}b 1{c}2 !{c}? {c}{c}  {c} X{c}'s" for c in points[k : k + 50_000]]
        for t, want in zip(texts, expected(library, path, texts), strict=True):
            assert vocab.encode(t).tolist() == want, repr(t)


@pytest.mark.parametrize("leaf", [7, 60, 400])
def test_tree_joins_give_the_whole_texts_encoding(library, leaf):
    vocab = byte_vocab(BYTE)
    texts = [t for t in random_texts(250, leaf) if t]
    for t, want in zip(texts, expected(library, BYTE, texts), strict=True):
        pieces = [t[i : i + leaf] for i in range(0, len(t), leaf)]
        whole = bpe.join_tree(vocab, [(p.encode(), vocab.encode(p)) for p in pieces])
        assert whole[0] == t.encode() and whole[1].tolist() == want


def test_encode_and_decode_keep_rows_and_columns(library, docs, corpus, no_docs):
    twice = docs.union(docs.where("doc_id < 3")).withColumn("ids", F.lit("x"))
    out = bpe.decode(bpe.encode(twice, BYTE, leaf_chars=50), BYTE)
    assert out.columns == ["doc_id", "text", "tag", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(corpus) + 3
    texts = dict(corpus)
    for r in rows:
        want = expected(library, BYTE, [texts[r.doc_id] or ""])[0]
        assert (r.ids, r.text, r.tag) == (want, texts[r.doc_id], f"tag{r.doc_id}")
        assert r.decoded == library[BYTE].decode(want, skip_special_tokens=False)
    assert bpe.encode(no_docs, BYTE).count() == 0


def test_pieces_meet_whatever_the_order_of_rows(spark, library):
    """Keys of pieces do not depend on the order in which a task meets its rows, and
    rows that are alike, or differ in a column that has no hash only, all come back."""
    rng = random.Random(9)
    texts = ["".join(rng.choices("abc de'", k=300)) for _ in range(5)]
    rows = [(k % 3, texts[k % 5], {"n": k // 15}) for k in range(60)]
    want = sorted((a, t, m["n"]) for a, t, m in rows)
    encoded = dict(zip(texts, expected(library, BYTE, texts), strict=True))
    keys = []
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, "doc_id long, text string, tag map<string, int>").coalesce(1)
        out = bpe.encode(df, BYTE, leaf_chars=50).collect()
        assert sorted((r.doc_id, r.text, r.tag["n"]) for r in out) == want
        assert all(r.ids == encoded[r.text] for r in out)
        keyed = df.withColumn("key", bpe._row_key(df, "text")).collect()
        keys.append({(r.doc_id, r.text): r.key for r in keyed})
    assert keys[0] == keys[1] and len(set(keys[0].values())) == 15


def test_query_digests(spark, library, tmp_path, docs, corpus):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    from starloom.llm.registry import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op1_bpe"](spark, str(tmp_path)).collect()}
    for k, t in corpus:
        ids = expected(library, BYTE, [t or ""])[0]
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (rows[k].n_tokens, rows[k].ids_sha256) == (len(ids), digest)
        assert rows[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_word_vocabulary_as_the_library_has_it(library):
    texts = list(random_texts(600, 3)) + ["İstanbul ΣΑΣ ﬁ é é \x1c\x85", "a\0b", "<|startoftext|>a"]
    vocab = word_vocab(WORD)
    for t, want in zip(texts, expected(library, WORD, texts), strict=True):
        assert vocab.encode(t).tolist() == want, repr(t)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packing_round_trip(bits):
    import numpy as np

    ids = np.random.default_rng(bits).integers(0, 2**bits, 999, dtype=np.uint64).astype(np.uint32)
    data = pack.pack(ids, bits)
    assert len(data) == -(-999 * bits // 8)
    assert (pack.unpack(data, 999, bits) == ids).all()


def test_shards_in_order_of_doc_id(library, spark, docs, corpus, no_docs):
    extra = spark.createDataFrame([(None, "no id", "t"), (2, "again", "t")], docs.schema)
    manifest = pack.write_ids(docs.union(extra), WORD, shards=4)
    rows = pack.read_ids(manifest).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted([k for k, _ in corpus] + [None, 2], key=lambda k: -1 if k is None else k)
    start, texts = 0, dict(corpus)
    for r in rows:
        assert r.start == start
        start += len(r.ids)
        if r.doc_id not in (None, 2):
            assert r.ids == expected(library, WORD, [texts[r.doc_id] or ""])[0] + [2]
    shard = pack.Shard(manifest.orderBy("shard").first().uri)
    assert shard.read(3, 3).tolist() == []
    ids, _, starts = shard.index(0, shard.docs)
    one = shard.read(int(starts[1]), int(starts[2])).tolist()
    assert one == next(r.ids for r in rows if r.doc_id == (int(ids[1]) if ids[0] or rows[0].doc_id is None else None))
    assert pack.read_ids(pack.write_ids(no_docs, WORD, shards=2)).count() == 0


def test_ids_before_each_unit_are_summed_within_shards(spark):
    units = [(2, "c", 0, 1, 5), (0, "a", 0, 2, 7), (0, "a", 2, 1, 1), (1, "b", 0, 4, 2), (1, "b", 4, 1, 9)]
    got = pack.units_with_base(spark.createDataFrame(units, pack.MANIFEST)).collect()
    assert {(r.shard, r.first_doc): r.base for r in got} == {(0, 0): 0, (0, 2): 7, (1, 0): 8, (1, 4): 10, (2, 0): 19}
