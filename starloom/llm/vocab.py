"""Public BPE vocabularies, read from the tokenizers library's JSON files.

Encoding goes through tiktoken's merge loop, which yields the same ids as the
tokenizers library several times faster; tests hold both against each other on
every code point and on random texts. Word vocabularies are encoded so only
where the library's Unicode steps cannot differ, the rest by the library itself.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import tiktoken

from starloom.llm.text import once

#: How byte-level tokenizers split a text, and how the word tokenizer does.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_END = "</w>"


def _bytes_of_chars() -> dict[str, int]:
    """Vocabulary characters and the bytes they stand for: printable Latin-1
    characters are themselves, other bytes are numbered from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _parts(path: str) -> tuple[dict[str, int], dict[str, int]]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {t: i for t, i in spec["model"]["vocab"].items() if t not in special}, special


class ByteVocab:
    """A byte-level BPE vocabulary."""

    def __init__(self, path: str):
        vocab, self.special = _parts(path)
        chars = _bytes_of_chars()
        ranks = {bytes(chars[c] for c in t): i for t, i in vocab.items()}
        self.core = tiktoken.Encoding(
            "bytes", pat_str=BYTE_SPLIT, mergeable_ranks=ranks, special_tokens=self.special
        )
        self.token_bytes = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, np.int64)
        for t, i in ranks.items():
            self.token_bytes[i] = len(t)
        for t, i in self.special.items():
            self.token_bytes[i] = len(t.encode())
        self.longest_special = max((len(t.encode()) for t in self.special), default=0)

    def encode(self, text: str) -> np.ndarray:
        return self.core.encode_to_numpy(text, allowed_special="all")

    def decode(self, ids: np.ndarray) -> str:
        """Ids that are no token are left out."""
        ids = ids[(ids >= 0) & (ids < len(self.token_bytes))]
        ids = ids[self.token_bytes[ids] > 0]
        return self.core.decode_bytes(ids.tolist()).decode("utf-8", "replace")


class WordVocab:
    """A BPE vocabulary over lower-case words, with word ends; white space is dropped."""

    PLAIN_BELOW = 0x180  # normal forms and lower case are settled below it

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        vocab, special = _parts(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = max([*vocab.values(), *special.values()]) + 1
        chars = _bytes_of_chars()
        ranks = {}
        for t, i in vocab.items():  # a word end is written as a zero byte
            body, end = (t[: -len(WORD_END)], b"\0") if t.endswith(WORD_END) else (t, b"")
            ranks[bytes(chars[c] for c in body) + end] = i
        self.core = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        )
        low = [chr(c) for c in range(self.PLAIN_BELOW)]
        letters = "".join(c for c in low if unicodedata.category(c)[0] == "L")
        numbers = "".join(c for c in low if unicodedata.category(c)[0] == "N")
        blank = "\t-\r \x85\xa0"
        self.words = re.compile(
            f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{blank}{letters}{numbers}]+"
        )
        self.odd = re.compile(f"[\0{chr(self.PLAIN_BELOW)}-\U0010ffff]|<\\|")

    def encode(self, text: str) -> np.ndarray:
        if self.odd.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return np.array(ids, np.uint32)
        words = self.words.findall(text.lower())
        if not words:
            return np.zeros(0, np.uint32)
        return self.core.encode_to_numpy("\0".join(words) + "\0")


def byte_vocab(path: str) -> ByteVocab:
    return once(("bytes", path), lambda: ByteVocab(path))


def word_vocab(path: str) -> WordVocab:
    return once(("words", path), lambda: WordVocab(path))
