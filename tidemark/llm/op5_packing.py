"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Pieces are dealt into blocks of some thousand by hash. Every block is packed on
several islands, one Spark row each: a population of packings, seeded by
best-fit decreasing, evolves by crossover that injects whole well-filled bins of
one parent into another, drops the bins that hold the same pieces, and best-fits
the displaced ones. After each epoch the best packing of an island migrates to
the next island of its block, through a join. The bins of the best packing that
are filled well are final; the pieces of all others form new blocks for one more
round, so that the loss at block ends does not grow with the input.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import stored, tables
from tidemark.llm.tokens import chunk_encoder, default_path
from tidemark.llm.words import chunks, out_schema

CAPACITY, BLOCK_ITEMS = 4096, 4096
ISLANDS, EPOCHS, POPULATION, CROSSOVERS = 3, 2, 4, 16
#: Bins below this share of the capacity are packed anew in the next round.
WELL_FILLED, ROUNDS = 0.98, 2


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None,
                 end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` (binary, little-endian 32 bit).

    A text's ids end in ``end_id``; a null or empty text has that one only. Every
    row is cut by itself, so repeated rows give repeated pieces.
    """
    path = tokenizer or default_path()
    kind = docs.schema[id_col]

    def rows(batches):
        encoder, end = chunk_encoder(path), end_id.to_bytes(4, "little")
        for batch in chunks(batches, "_text"):
            at, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, text in enumerate(batch.column(1).cast(pa.large_binary()).to_pylist()):
                raw = encoder.raw(text) + end
                for p, a in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[a:a + 4 * capacity]
                    for column, value in zip((at, piece, start, length, crc), (r, p, a // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
                    if with_ids:
                        ids.append(part)
            arrays = [batch.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(ids, pa.binary())] * with_ids, names=[kind.name, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    picked = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("_text"))
    return picked.mapInArrow(rows, out_schema("piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids, [kind]))


# Inside tasks: packings of one block. A packing is the bin of each item, bins numbered from 0.

def best_fit(lengths: np.ndarray, bins: np.ndarray, items, capacity: int) -> np.ndarray:
    """Put each of ``items`` in turn where the least room is left that takes it; ``bins`` has -1 for items without a bin."""
    bins = bins.copy()
    held = bins >= 0
    count = int(bins.max(initial=-1)) + 1
    loads = np.bincount(bins[held], weights=lengths[held], minlength=count).astype(np.int64)
    room = sorted((int(capacity - x), b) for b, x in enumerate(loads.tolist()))
    size = lengths.tolist()
    for i in items:
        at = bisect_left(room, (size[i], -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, count
            count += 1
        bins[i] = b
        insort(room, (left - size[i], b))
    return bins


def renumbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1]


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then fuller ones (mean square fill)."""
    loads = np.bincount(bins, weights=lengths) / capacity
    return -len(loads), float((loads ** 2).mean()) if len(loads) else 0.0


def crossover(lengths: np.ndarray, host: np.ndarray, donor: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``host`` with some well-filled bins of ``donor`` taken over whole."""
    loads = np.bincount(donor, weights=lengths)
    full = np.argsort(-loads, kind="stable")[:max(1, len(loads) // 2)]
    taken = rng.choice(full, max(1, len(full) // 4), replace=False)
    injected = np.isin(donor, taken)
    broken = np.isin(host, np.unique(host[injected]))
    # Each crossover also opens some of the least filled bins, whose pieces go where room is left.
    poor = np.argsort(np.bincount(host, weights=lengths), kind="stable")[:max(1, len(loads) // 50)]
    broken |= np.isin(host, poor)
    child = np.where(broken, -1, host)
    child[injected] = host.max() + 1 + renumbered(donor[injected])
    keep = child >= 0
    child[keep] = renumbered(child[keep])
    displaced = np.flatnonzero(child < 0)
    size = lengths[displaced] * (rng.normal(1, 0.1, len(displaced)) if rng.random() < 0.5 else 1)
    return best_fit(lengths, child, displaced[np.argsort(-size, kind="stable")].tolist(), capacity)


def evolve(lengths: np.ndarray, capacity: int, seed: list[int], elites: list[np.ndarray]) -> np.ndarray:
    """The best packing of one island after one epoch."""
    rng = np.random.default_rng(seed)
    population = list(elites)
    empty = np.full(len(lengths), -1)
    while len(population) < POPULATION:
        noise = rng.normal(1, 0.0 if not population else 0.1, len(lengths))
        population.append(best_fit(lengths, empty, np.argsort(-lengths * noise, kind="stable").tolist(), capacity))
    bound = -(-int(lengths.sum()) // capacity)
    score = [fitness(lengths, p, capacity) for p in population]
    for _ in range(CROSSOVERS):
        if -max(score)[0] <= bound:
            break
        rank = sorted(range(len(population)), key=lambda i: score[i], reverse=True)
        host, donor = rank[0] if rng.random() < 0.5 else rank[1], rank[int(rng.integers(0, len(rank)))]
        child = crossover(lengths, population[host], population[donor], capacity, rng)
        worth = fitness(lengths, child, capacity)
        if worth >= score[rank[-1]]:
            population[rank[-1]], score[rank[-1]] = child, worth
    return population[max(range(len(population)), key=lambda i: score[i])]


def offsets(lengths: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Each item's place in its bin: bins are filled in the order of items."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    begin = ends - lengths[order]
    first = np.flatnonzero(np.r_[True, np.diff(bins[order]) > 0]) if len(order) else order
    out = np.empty(len(lengths), np.int64)
    out[order] = begin - np.repeat(begin[first], np.diff(np.r_[first, len(order)]))
    return out


def _epoch(rows: DataFrame, capacity: int, round_: int, epoch: int) -> DataFrame:
    """``rows``: block, island, lengths, own, other (packings or null). Its best packing, with what it is worth."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                every = np.array(r["lengths"], np.int64)
                open_ = every < capacity  # a full piece is a bin of its own
                lengths = every[open_]
                elites = [np.array(e, np.int64) for e in (r["own"], r["other"]) if e is not None]
                best = renumbered(evolve(lengths, capacity, [round_, epoch, r["block"], r["island"]], elites))
                worth = fitness(lengths, best, capacity)
                bins = np.empty(len(every), np.int64)
                bins[open_] = best
                bins[~open_] = len(every) + np.arange((~open_).sum())
                total = np.bincount(renumbered(bins), weights=every)[renumbered(bins)].astype(np.int64)
                yield pa.RecordBatch.from_pylist([{"block": r["block"], "island": r["island"], "best": best.tolist(), "bins": -worth[0], "fill": worth[1],
                                                   "bin_of": bins.tolist(), "offset": offsets(every, bins).tolist(), "load": total.tolist()}], schema=kind)

    kind = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("best", pa.list_(pa.int32())), ("bins", pa.int32()), ("fill", pa.float64()),
                      ("bin_of", pa.list_(pa.int32())), ("offset", pa.list_(pa.int32())), ("load", pa.list_(pa.int32()))])
    return rows.mapInArrow(run, "block long, island int, best array<int>, bins int, fill double, bin_of array<int>, offset array<int>, load array<int>")


def _round(items: DataFrame, n: int, capacity: int, round_: int, block_items: int) -> DataFrame:
    """``items`` with ``sequence_id``, ``offset`` and the load of their bin."""
    blocks = max(1, -(-n // block_items))
    columns = [F.col(f"`{c}`") for c in items.columns]
    block = F.pmod(F.xxhash64(*columns, F.lit(round_)), F.lit(blocks))
    # A block has about block_items rows: its number follows from theirs.
    packed = stored(items.select(block.alias("block"), F.struct(F.col("length").alias("_size"), *columns).alias("x")).groupBy("block")
                    .agg(F.sort_array(F.collect_list("x"), asc=False).alias("items")), "blocks")
    lengths = packed.select("block", F.expr("transform(items, x -> int(x._size))").alias("lengths"))
    tasks = min(blocks * ISLANDS, 20_000)
    state = lengths.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "lengths")
    none = F.lit(None).cast("array<int>")
    best = stored(_epoch(state.withColumn("own", none).withColumn("other", none).repartition(tasks, "block", "island"), capacity, round_, 0), "islands")
    for epoch in range(1, EPOCHS):
        own = best.select("block", "island", F.col("best").alias("own"))
        guest = best.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("best").alias("other"))
        again = state.join(own, ["block", "island"]).join(guest, ["block", "island"]).select("block", "island", "lengths", "own", "other")
        best = stored(_epoch(again.repartition(tasks, "block", "island"), capacity, round_, epoch), "islands")
    won = best.groupBy("block").agg(F.min_by(F.struct("bin_of", "offset", "load"), F.struct("bins", -F.col("fill"), "island")).alias("w"))
    placed = packed.join(won, "block").select("block", F.explode(F.arrays_zip("items", "w.bin_of", "w.offset", "w.load")).alias("z"))
    sequence = F.lit(round_ << 58) + F.col("block") * (1 << 24) + F.col("z.bin_of")
    return placed.select(*[F.col("z.items").getField(c).alias(c) for c in items.columns], sequence.alias("sequence_id"), F.col("z.offset").cast("long").alias("offset"), F.col("z.load").alias("_load"))


def pack(items: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: no sequence is longer than ``capacity``, none has a gap.

    ``items`` needs ``length`` (1 to ``capacity``); null lengths or others raise.
    Repeated rows are packed each by itself. An empty table gives an empty result.
    """
    if {"sequence_id", "offset", "block"} & {*items.columns}:
        raise ValueError("items has a column that packing adds")
    n, low, high, known = items.agg(F.count("*"), F.min("length"), F.max("length"), F.count("length")).first()
    if n != known or n and not 0 < low <= high <= capacity:
        raise ValueError("lengths must be from 1 to the capacity")
    done = []
    for round_ in range(ROUNDS):
        placed = _round(items, n, capacity, round_, block_items)
        last = round_ == ROUNDS - 1 or n <= block_items
        if last:
            done.append(placed)
            break
        placed = stored(placed, "packed")
        well = F.col("_load") >= int(WELL_FILLED * capacity)
        done.append(placed.where(well))
        items = placed.where(~well).select(*items.columns)
        n = items.count()
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.drop("_load")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``: every piece of every row, packed."""
    return pack(stored(token_pieces(docs, id_col, text_col, capacity, tokenizer), "pieces"), capacity)


def op5(spark, sf_dir: str) -> DataFrame:
    return pack_documents(tables(spark, sf_dir, "documents"))


QUERIES = {"op5_packing": op5}
ORACLES = {}
