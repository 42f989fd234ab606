"""Token ids of whole texts with a public tokenizer file, inside Spark tasks.

The word-level vocabulary drops white space and never looks across it, so a
text's ids are those of its white-space-separated chunks in order. Each chunk is
encoded once per task and kept in a bounded cache. Most new chunks are a Latin
word and perhaps signs after it: these go straight to the tokenizer's model,
without its normaliser and splitter, which take most of the time. The tests hold
the ids against whole-text encoding.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np

#: Entries of a cache's generation, and the longest key that is kept: some 300 MB in a Python worker at most.
_CACHED, _LONG = 400_000, 64
#: Latin letters, which are split and lower-cased alike here and by the tokenizer, and then ASCII signs. An
#: apostrophe may belong to what follows it, and one dotted capital becomes two characters: both are left out.
_WORD = re.compile(r"""([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!"#$%&()*+,\-./:;<=>?@[\\\]^_`{|}~]*)""")

#: The same for each line of many chunks; a line that is no such word has two empty groups.
_LINE = re.compile(rf"^(?:{_WORD.pattern}$|.*$)", re.MULTILINE)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _little(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Cache(dict):
    """Value by key, made when first asked for; kept if the key is short.

    Of two generations: when the young one is full it becomes the old one, from
    which entries asked for again return.
    """

    def __init__(self, make):
        self._make, self._old = make, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(key) <= _LONG:
            self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > _CACHED:
            self._old = dict(self)
            self.clear()


class ChunkEncoder:
    """``raw(text)``: ids as little-endian unsigned 32-bit integers, one after another."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer, pre_tokenizers
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenize = self._tokenizer.model.tokenize
        self._letters = _byte_letters()
        assert set(self._letters.values()) == set(pre_tokenizers.ByteLevel.alphabet())
        self._chunks, self._words, self._signs = _Cache(self._chunk), _Cache(self._word), _Cache(self._whole)

    def _whole(self, text: str) -> bytes:
        return _little(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        return _little([t.id for t in self._tokenize(letters)])

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        found = _WORD.fullmatch(text)
        if not found:
            return self._whole(text)
        word, signs = found.groups()
        return self._words[word.lower()] + self._signs[signs] if signs else self._words[word.lower()]

    def turn(self) -> None:
        for cache in (self._chunks, self._words, self._signs):
            cache.turn()

    def many(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each chunk has, and the ids of all, for callers that remember them; each word, and each sequence of signs after one, is encoded once."""
        found = _LINE.findall(b"\n".join(chunks).decode()) if chunks else []
        words, others = {}, {"": 0}
        # A part's number: from 0 for words, down from -1 for what no model takes alone.
        first = [words.setdefault(word.lower(), len(words)) if word else ~others.setdefault(chunk.decode(), len(others))
                 for chunk, (word, _) in zip(chunks, found, strict=True)]
        second = [~others.setdefault(signs, len(others)) for _, signs in found]
        made = [*map(self._words.__getitem__, words), *map(self._signs.__getitem__, reversed(others))]
        parts = np.array([first, second], np.int64).T.ravel()  # a negative number counts from the end
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        size, begin = sizes[parts], (np.cumsum(sizes) - sizes)[parts]
        place = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
        return size.reshape(-1, 2).sum(axis=1), np.frombuffer(b"".join(made), "<u4")[place]

    def raw(self, text: bytes | None) -> bytes:
        self.turn()
        return b"".join(map(self._chunks.__getitem__, (text or b"").split()))


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder for all tasks of a Python worker: its cache serves the next task too."""
    return ChunkEncoder(path)
