"""Helpers that run inside Spark tasks: words of a batch of texts as numpy arrays.

A text's words are cut and hashed over whole Arrow buffers, not one by one, so
that the operators' per-word work stays in numpy. Hashes are the same in every
process and on every machine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one chunk holds at most, unless a single text is longer.
CHUNK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_GRAM_INV = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def byte_mask(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


#: Words ``[^\x20\x09-\x0D]+``.
BY_SPACE = byte_mask(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose texts have ``limit`` bytes at most (one row at least)."""
    for batch in batches:
        i = batch.schema.get_field_index(column)
        ends = np.cumsum(byte_lengths(batch.column(i)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes one after another, and where each text starts (one more than texts). A null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0]:bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    return (_LOWER[data] if lower else data), bounds - bounds[0]


def word_bounds(data: np.ndarray, bounds: np.ndarray, mask: np.ndarray = BY_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (one more than texts)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = mask[data]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    # A text's first byte starts a word and its end closes one, whatever the neighbour has there.
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    starts[cut] = inside[cut + 1]
    ends[cut] = inside[cut]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    own = data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    own *= powers(_BASE, int(lengths.max()))[place]
    return mix(np.add.reduceat(own, first) + lengths.astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words, across text ends too (callers leave those out)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    if n <= 8:
        out = np.zeros(len(words) - n + 1, np.uint64)
        for j in range(n):
            out = out * _GRAM + words[j:len(words) - n + 1 + j]
        return mix(out + np.uint64(n))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(_GRAM, len(words)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * powers(_GRAM_INV, len(words))[:len(words) - n + 1] + np.uint64(n))


def owner(first: np.ndarray) -> np.ndarray:
    """For each word, the index of its text; ``first`` as word_bounds gives it."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Which word indices begin ``n`` words of one text."""
    total = int(first[-1])
    ends = np.repeat(first[1:], np.diff(first))
    return np.arange(total) + n <= ends


def covered(starts: np.ndarray, length: int | np.ndarray, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a span that begins at one of ``starts``."""
    steps = np.bincount(starts, minlength=total + 1)[:total + 1] - np.bincount(starts + length, minlength=total + 1)[:total + 1]
    return np.cumsum(steps)[:total] > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def sha256_hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def as_int64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def out_schema(fields: str, passed=()) -> str:
    """A DDL string of ``passed`` Spark fields and then ``fields``."""
    return ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in passed), fields])
