"""Training-order materialisation: a keyed permutation of all sequences, written as fixed-stride shards.

1. One pass counts the sequences of each input split; their sums give every
   sequence a number from 0 to n - 1 without a sort.
2. A Feistel network over the next power of four, walked until it falls below
   n, permutes the numbers: the slot. It needs the key only, no table.
3. Sequences go to their range of slots, one task a shard, which writes its
   records one after another. Record i of a shard begins at i times the stride,
   so a reader can start, or go on, at any slot.

Both passes hash words over whole Arrow buffers and look them up in a table that
a Python worker keeps; just new ones are tokenised. The first one needs only how
many ids each word has. The second pass cuts the texts instead of reading stored
ids, which halves the disk. Its
splits must be those that were counted, and its counts the same; each task checks
that they are and fails otherwise. A shard is written under another name and
renamed when it is whole, so a lost executor leaves no half of one.
"""

from __future__ import annotations

import uuid
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.store import stored, tables
from tidemark.llm.tokens import ChunkEncoder, chunk_encoder, default_path
from tidemark.llm.words import chunks, flat, mix, out_schema, word_bounds, word_hashes
from tidemark.session import scratch_dir

LENGTH, SHARD_ROWS, ROUNDS = 256, 1 << 16, 6
#: Fills up a record. No id has this value: the vocabulary must be smaller.
PAD = 0xFFFF
#: Words whose length a Python worker remembers, and bytes of text counted and cut at once.
MOST_WORDS, COUNT_BYTES, CUT_BYTES = 2_000_000, 8 << 20, 4 << 20


def feistel(x: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The keyed permutation of 0 to ``n`` - 1 at each of ``x``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low, width = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 64)))

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> width, v & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        return (left << width) | right

    out = once(x.astype(np.uint64))
    beyond = np.flatnonzero(out >= n)
    while len(beyond):  # cycle walking: stays a permutation
        out[beyond] = once(out[beyond])
        beyond = beyond[out[beyond] >= n]
    return out.astype(np.int64)


def _ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last eight bytes of each word (all of a shorter one) as numbers."""
    padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,))
    beyond = (8 * (8 - np.minimum(ends - starts, 8))).astype(np.uint64)
    return eight[starts + 8] << beyond, eight[ends] >> beyond


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: of its ``_ends``, which are all of a word of up to 16 bytes, and of all bytes of a longer one."""
    # Times a large number, so that a longer word with a smaller first byte is another one.
    keys = mix(mix(head + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + tail)
    long = np.flatnonzero(ends - starts > 16)
    keys[long] = word_hashes(data, starts[long], ends[long])
    return keys


def cut_records(ids: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and piece of each record of ``length`` ids, and its ids as little-endian bytes."""
    pieces = -(-np.diff(bounds) // length)
    row = np.repeat(np.arange(len(pieces)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    offsets = np.append(bounds[row] + piece * length, bounds[-1]) * 2
    return row, piece, pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.tobytes())]).cast(pa.binary())


class WordCounts:
    """Ids of texts, and how many each has, by a sorted table of word hashes; one for all tasks of a Python worker.

    Only words that the table lacks are encoded. Beyond ``MOST_WORDS`` it begins anew.
    """

    def __init__(self, path: str):
        self.encoder = chunk_encoder(path)
        self._empty()

    def _empty(self) -> None:
        self.hashes, self.slots, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint16)
        self.begin, self.size, self.width = (np.zeros(0, np.int64) for _ in range(3))
        self.head, self.tail = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """The table's slot of each word; ``head`` and ``tail`` as ``_ends`` gives them."""
        # By a table: most words come again, so a sort of all would be dear.
        code, own = pd.factorize(_keys(data, starts, ends, head, tail))
        order = np.argsort(own)  # neighbours are looked up in the same part of the table
        at = np.empty(len(own), np.int64)
        at[order] = np.searchsorted(self.hashes, own[order])
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == own[known]
        new = order[~known[order]]
        if len(self.hashes) and len(self.hashes) + len(new) > MOST_WORDS:
            self._empty()
            return self._words(data, starts, ends, head, tail)
        slots = np.empty(len(own), np.int64)
        slots[known] = self.slots[at[known]]
        if len(new):
            where = np.empty(len(own), np.int64)
            where[code] = np.arange(len(code))
            where = where[new]
            first, last, raw = starts[where], ends[where], data.tobytes()
            self.encoder.turn()
            size, ids = self.encoder.many([raw[a:b] for a, b in zip(first.tolist(), last.tolist())])
            slots[new] = len(self.size) + np.arange(len(new))
            self.hashes, self.slots = np.insert(self.hashes, at[new], own[new]), np.insert(self.slots, at[new], slots[new])
            self.begin = np.append(self.begin, len(self.pool) + np.cumsum(size) - size)
            self.pool = np.append(self.pool, ids.astype(np.uint16))
            self.size, self.width = np.append(self.size, size), np.append(self.width, last - first)
            self.head, self.tail = np.append(self.head, head[where]), np.append(self.tail, tail[where])
        return slots[code]

    def of(self, column: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        data, bounds = flat(column)
        starts, ends, first = word_bounds(data, bounds)
        slot = self._words(data, starts, ends, *_ends(data, starts, ends))  # before the sizes are read: it adds to them
        sums = np.concatenate([[0], np.cumsum(self.size[slot])])
        return sums[first[1:]] - sums[first[:-1]]

    def ids(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids one after another, each text's closed by ``end``, and where each starts (one more than texts).

        Every word is held against the table's by length and by its first and
        last eight bytes, which is all of a word of up to 16; where two differ,
        these texts are encoded one by one.
        """
        data, bounds = flat(column)
        starts, ends, first = word_bounds(data, bounds)
        head, tail = _ends(data, starts, ends)
        slot = self._words(data, starts, ends, head, tail)
        if not ((self.width[slot] == ends - starts) & (self.head[slot] == head) & (self.tail[slot] == tail)).all():
            raw = data.tobytes()
            each = [np.append(np.frombuffer(self.encoder.raw(raw[a:b]), "<u4"), end) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            return np.concatenate(each).astype("<u2"), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        # The end of a text is a word of one id.
        begin = np.insert(self.begin[slot], first[1:], len(self.pool))
        size = np.insert(self.size[slot], first[1:], 1)
        stop = np.cumsum(size)
        place = np.arange(int(size.sum())) + np.repeat(begin - (stop - size), size)
        return np.append(self.pool, np.uint16(end))[place].astype("<u2"), np.concatenate([[0], stop[first[1:] + np.arange(len(first) - 1)]])


@lru_cache(maxsize=2)
def _word_counts(path: str) -> WordCounts:
    return WordCounts(path)


def _count(picked: DataFrame, path: str, length: int) -> dict[int, tuple[int, int]]:
    def rows(batches):
        counts, n, texts = _word_counts(path), 0, 0
        for batch in chunks(batches, "_text", COUNT_BYTES):
            n += int((-(-(counts.of(batch.column(1)) + 1) // length)).sum())
            texts += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([texts]), pa.array([n])], names=["split", "texts", "n"])

    # One row for each input split.
    return {r.split: (r.texts, r.n) for r in picked.mapInArrow(rows, "split int, texts long, n long").collect()}


def materialise(docs: DataFrame, out_dir: str, key: int, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                shard_rows: int = SHARD_ROWS, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Write ``docs`` as shards of ``length`` ids a record and return the manifest, written and read back.

    Manifest: ``id_col``, ``piece``, ``slot``, ``shard``, ``place`` (record in the
    shard), ``n_tokens``, ``ids_crc32`` (of the unsigned 16-bit little-endian ids
    without padding). Shard k is the file ``shard-k.u16`` under ``out_dir``, a
    path or URI that all executors can write to; a later run writes the same
    files. Each text's ids end in ``end_id``; a null or empty text is a record
    of that id alone. Repeated rows and null ids are rows like others. An empty
    table gives no shards. ``docs`` must be a read of files, possibly projected
    or filtered, so that both passes see the same splits.
    """
    path = tokenizer or default_path()
    from tokenizers import Tokenizer
    if Tokenizer.from_file(path).get_vocab_size() > PAD:
        raise ValueError("ids do not fit 16 bits")
    spark = docs.sparkSession
    picked = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("_text"))
    counted = _count(picked, path, length)
    begins, total = {}, 0
    for split in sorted(counted):
        begins[split] = total
        total += counted[split][1]
    shared = spark.sparkContext.broadcast((begins, counted))
    kind = docs.schema[id_col]

    def rows(batches):
        begins, counted = shared.value
        words, split = _word_counts(path), TaskContext.get().partitionId()
        at, texts = begins.get(split, 0), 0
        for batch in chunks(batches, "_text", CUT_BYTES):
            row, piece, ids = cut_records(*words.ids(batch.column(1), end_id), length)
            slot = feistel(np.arange(at, at + len(row)), total, key)
            at, texts = at + len(row), texts + batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece.astype(np.int32)), pa.array(slot), pa.array((slot // shard_rows).astype(np.int32)), ids],
                                             names=[kind.name, "piece", "slot", "shard", "ids"])
        if (texts, at - begins.get(split, 0)) != counted.get(split, (0, 0)):
            raise RuntimeError("the input's splits changed between the two passes; run again")

    dealt = picked.mapInArrow(rows, out_schema("piece int, slot long, shard int, ids binary", [kind]))
    shards = max(1, -(-total // shard_rows))
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")

    def write(batches):
        fs, folder = _file_system(out_dir)
        open_, number, temporary = None, None, None
        for batch in batches:
            crc, size = [], []
            for shard, ids in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                if shard != number:
                    _finish(fs, folder, open_, temporary, number)
                    number, temporary = shard, f"{folder}/.part-{shard}-{uuid.uuid4().hex}"
                    open_ = fs.open_output_stream(temporary)
                open_.write(ids + b"\xff" * (2 * length - len(ids)))
                crc.append(zlib.crc32(ids))
                size.append(len(ids) // 2)
            slot = batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(slot % shard_rows), pa.array(size, pa.int32()), pa.array(crc, pa.int64())],
                                             names=[kind.name, "piece", "slot", "shard", "place", "n_tokens", "ids_crc32"])
        _finish(fs, folder, open_, temporary, number)

    return stored(dealt.mapInArrow(write, out_schema("piece int, slot long, shard int, place long, n_tokens int, ids_crc32 long", [kind])), "manifest")


def _file_system(uri: str):
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        got, folder = fs.LocalFileSystem(), uri
    else:
        got, folder = fs.FileSystem.from_uri(uri)
    got.create_dir(folder, recursive=True)
    return got, folder


def _finish(fs, folder: str, open_, temporary: str | None, number: int | None) -> None:
    if open_ is not None:
        open_.close()
        fs.move(temporary, f"{folder}/shard-{number:08d}.u16")


def read_slots(spark: SparkSession, out_dir: str, start: int, stop: int, length: int = LENGTH, shard_rows: int = SHARD_ROWS, step: int = 4096) -> DataFrame:
    """``slot``, ``ids`` (padding cut off) of the slots from ``start`` to before ``stop``; each task seeks to its own."""
    ranges = spark.range(start, max(start, stop), step)

    def rows(batches):
        fs, folder = _file_system(out_dir)
        for batch in batches:
            for first in batch.column(0).to_pylist():
                slots = list(range(first, min(first + step, stop)))
                while slots:
                    shard = slots[0] // shard_rows
                    own = [s for s in slots if s // shard_rows == shard]
                    slots = slots[len(own):]
                    with fs.open_input_file(f"{folder}/shard-{shard:08d}.u16") as f:
                        f.seek(own[0] % shard_rows * 2 * length)
                        got = np.frombuffer(f.read(len(own) * 2 * length), "<u2").reshape(-1, length)
                    yield pa.RecordBatch.from_arrays([pa.array(own[:len(got)], pa.int64()), pa.array([x[x != PAD].tolist() for x in got], pa.list_(pa.int32()))], names=["slot", "ids"])

    return ranges.mapInArrow(rows, "slot long, ids array<int>")


def op10(spark, sf_dir: str) -> DataFrame:
    return materialise(tables(spark, sf_dir, "documents"), scratch_dir(spark, "shards"), key=20_260_101)


QUERIES = {"op10_training_order": op10}
ORACLES = {}
