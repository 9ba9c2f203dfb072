import random
import time

import numpy as np
import pyarrow as pa

from starloom.llm import text, wordpiece
from starloom.llm.bpe import public_path
from tests.llm.conftest import split_words

PATH = public_path("byte_bpe_50k.json")


def greedy(word, pieces, longest):
    n = i = 0
    while i < len(word):
        k = next((k for k in range(min(longest, len(word) - i), 1, -1) if word[i : i + k] in pieces), 1)
        i, n = i + k, n + 1
    return n


def test_words_and_lines_of_many_texts(corpus):
    texts = [t for _, t in corpus]
    raw, offsets = text.utf8(pa.array(texts))
    w = text.words(raw, offsets)
    rows = text.lines(raw, offsets, w)
    names, line_names = {}, {}
    for d, t in enumerate(texts):
        own = range(w.first[d], w.first[d + 1])
        assert [bytes(raw[w.starts[i] : w.ends[i]]).decode() for i in own] == split_words(t)
        for i, word in zip(own, split_words(t), strict=True):
            assert names.setdefault(word, w.hashes[i]) == w.hashes[i]
        full = [x for x in (t or "").split("\n") if split_words(x)]
        own = range(rows.first[d], rows.first[d + 1])
        assert [bytes(raw[rows.starts[i] : rows.ends[i]]).decode() for i in own] == full
        assert [rows.n_words[i] for i in own] == [len(split_words(x)) for x in full]
        for i, line in zip(own, full, strict=True):
            assert line_names.setdefault(line, rows.hashes[i]) == rows.hashes[i]
    assert len(set(names.values())) == len(names)
    assert len(set(line_names.values())) == len(line_names)


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (0, 9, 3, 50, 0, 1, 2)]})
    parts = list(text.slices(batch.slice(1), "text", limit=10))
    assert [p.column(0).to_pylist() for p in parts][1] == ["xxx"]
    assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()[1:]


def test_automaton_counts_as_greedy_matching_does():
    rng = random.Random(2)
    for _ in range(120):
        alphabet = b"abc"[: rng.randint(1, 3)]
        pieces = {bytes(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(rng.randint(1, 25))}
        words = [bytes(rng.choices(alphabet, k=rng.choice([1, 5, 40, 300]))) for _ in range(30)]
        ends = np.cumsum([len(x) + 1 for x in words]) - 1
        starts = ends - [len(x) for x in words]
        got = wordpiece.Automaton(list(pieces)).counts(np.frombuffer(b" ".join(words), np.uint8), starts, ends)
        assert got.tolist() == [greedy(x, pieces, 7) for x in words]


def test_long_words_are_joined_from_stretches(monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(wordpiece, "LONG", 16)
    monkeypatch.setattr(wordpiece, "AT_ONCE", 4)
    for _ in range(60):
        alphabet = b"abc"[: rng.randint(1, 3)]
        pieces = {bytes(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(rng.randint(1, 25))}
        machine = wordpiece.Automaton(list(pieces))
        for n in (15, 16, 17, 31, 33, 64, 65, 500):
            word = bytes(rng.choices(alphabet, k=n))
            got = machine.counts(np.frombuffer(word, np.uint8), np.array([0]), np.array([n]))
            assert got.tolist() == [greedy(word, pieces, 7)]


def test_unspaced_text_costs_about_as_much_as_spaced():
    rng = random.Random(4)
    machine = wordpiece.automaton(PATH)
    pieces = set(wordpiece.word_pieces(PATH))
    word = "".join(chr(rng.randrange(0x4E00, 0x6000)) for _ in range(200_000)).encode()
    raw = np.frombuffer(word, np.uint8)
    machine._plain()
    begin = time.process_time()
    got = machine.counts(raw, np.array([0]), np.array([len(raw)]))
    assert time.process_time() - begin < 2  # 0.6 MB; byte by byte it took about a minute
    assert got.tolist() == [greedy(word, pieces, max(map(len, pieces)))]


def test_counts_per_document(docs, corpus, no_docs):
    pieces = set(wordpiece.word_pieces(PATH))
    longest = max(map(len, pieces))
    out = wordpiece.count_pieces(docs.union(docs.limit(2)), PATH)
    assert out.columns == ["doc_id", "text", "tag", "n_words", "n_pieces"]
    assert out.count() == len(corpus) + 2
    rows = {r.doc_id: r for r in out.collect()}
    for k, t in corpus:
        w = [x.encode() for x in split_words(t)]
        assert (rows[k].n_words, rows[k].n_pieces) == (len(w), sum(greedy(x, pieces, longest) for x in w))
    assert wordpiece.count_pieces(no_docs, PATH).count() == 0
