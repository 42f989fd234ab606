"""Exact substring dedup by blockwise suffix sorting with a difference cover.

Every byte of a string of ``length`` bytes that starts in two places is removed.

1. A window's anchor is its smallest ``gram``-byte hash (leftmost): equal
   windows have equal anchors in equal places. Tasks emit each anchor with a
   digest of its context, the bytes that the windows of this anchor hold: each
   window is in one context. Anchors met at one place are done, most of them.
   Contexts that are equal are represented by one, and covered altogether.
2. The differing contexts of an anchor are a suffix bucket. Buckets are dealt
   out and sorted in blocks of bounded size: a sample of the suffixes, those at
   places of a difference cover, is ranked first; then one range of suffixes at
   a time is sorted by its first bytes, and ties by the ranks of the sample
   places that two suffixes reach after equally many bytes. Neighbours that
   agree in ``length`` bytes are duplicates.
3. A bucket of more than ``hot`` contexts is split before it is sorted: by where
   the window starts before the anchor and by the bytes that all those windows
   have in common. Equal windows stay together, and a range of one start is one
   group of equal windows, so the split always ends.

Copies of a whole text are told by two hashes and represented by one of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import stored, tables
from tidemark.llm.words import as_int64, chunks, covered, flat, gram_hashes, out_schema, runs, sha256_hex

LENGTH, GRAM = 400, 128
#: A difference cover modulo 32 (fixed values): any two places reach one of these residues after equally many steps, below 32.
COVER, PERIOD = (0, 1, 2, 3, 7, 11, 19), 32
#: Bytes of contexts that are sorted together, and suffixes of one range.
BLOCK_BYTES, RANGE = 1 << 20, 1 << 16
#: Differing contexts beyond which a bucket is split, and into how many ranges of starts.
HOT, FAN = 512, 8
#: Contexts met more often than this, or than by one in a million of all rows, are looked up by broadcast: a million at most.
FREQUENT, MOST_FREQUENT = 1_000, 1_000_000


class DifferenceCover:
    """Sample places of a text, and for each two places how many bytes on both are sample places."""

    def __init__(self, residues: tuple[int, ...], period: int):
        self.period, self.size = period, len(residues)
        self.residues = np.array(residues)
        self.order = np.full(period, -1)
        self.order[self.residues] = np.arange(self.size)
        inside = self.order >= 0
        step = np.arange(period)
        self.delta = np.full((period, period), -1)
        for a in range(period):
            for b in range(period):
                both = np.flatnonzero(inside[(a + step) % period] & inside[(b + step) % period])
                if not len(both):
                    raise ValueError("not a difference cover")
                self.delta[a, b] = both[0]

    def places(self, n: int) -> np.ndarray:
        """Sample places below ``n``, rounded up to a whole period."""
        return (np.arange(0, n, self.period)[:, None] + self.residues).ravel()

    def index(self, place: np.ndarray) -> np.ndarray:
        return place // self.period * self.size + self.order[place % self.period]


_COVER = DifferenceCover(COVER, PERIOD)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number."""
    w = text.astype(np.uint64)
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        w = (w << np.uint64(bits)) | np.concatenate([w[step:], np.zeros(step, np.uint64)])
    return w


def _dense(key: np.ndarray) -> tuple[np.ndarray, int]:
    values, rank = np.unique(key, return_inverse=True)
    return rank.astype(np.int64), len(values)


class SuffixBlock:
    """Suffixes of ``text``, compared by ``length`` bytes at least; ``text`` may not end within ``length`` of a place asked for."""

    def __init__(self, text: np.ndarray, length: int, cover: DifferenceCover = _COVER):
        self.cover, self.length = cover, length
        v = cover.period
        self.words = _words(np.concatenate([text, np.zeros(length + 3 * v, np.uint8)]))
        places = cover.places(len(text) + v)
        places = places[places + v <= len(self.words)]
        rank, n = _dense(self.words[places])
        for k in range(8, v, 8):
            more, m = _dense(self.words[places + k])
            rank, n = _dense(rank * m + more)
        #: Ranks of the sample by its first v, 2v, 4v ... bytes, up to more than ``length``; equal ranks are equal bytes.
        self.ranks, self.width = [rank], v
        while self.width < length:
            shift = self.width // v * cover.size
            later = np.zeros_like(rank)
            later[:max(0, len(rank) - shift)] = rank[shift:] + 1
            rank, n = _dense(rank * (n + 1) + later)
            self.ranks.append(rank)
            self.width *= 2

    def _rank(self, level: int, place: np.ndarray) -> np.ndarray:
        return self.ranks[level][np.minimum(self.cover.index(place), len(self.ranks[level]) - 1)]

    def sorted(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``places`` in suffix order, and whether each one's first period of bytes is that of the one before."""
        keys = [self.words[places + k] for k in range(self.cover.period - 8, -1, -8)]
        order = np.lexsort(keys)
        same = np.ones(len(places), bool)
        same[:1] = False
        for key in keys:
            same[1:] &= key[order][1:] == key[order][:-1]
        out = places[order]
        a, b = runs(np.append(same[1:], False))
        if len(a):
            self._break_ties(out, a, b + 1)
        return out, same

    def _break_ties(self, out: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Sort each ``out[begin:end]`` by the ranks of sample places: a quicksort of all these ranges at once."""
        top, v, delta = len(self.ranks) - 1, self.cover.period, self.cover.delta
        while len(begin):
            size = end - begin
            at = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
            place, pivot = out[at], np.repeat(out[(begin + end) // 2], size)
            d = delta[place % v, pivot % v]
            side = np.sign(self._rank(top, place + d) - self._rank(top, pivot + d)) + 1
            group = np.repeat(np.arange(len(begin)), size)
            order = np.argsort(group * 3 + side, kind="stable")
            out[at] = place[order]
            count = np.bincount(group * 3 + side, minlength=3 * len(begin)).reshape(-1, 3)
            less = np.stack([begin, begin + count[:, 0]], 1)
            more = np.stack([end - count[:, 2], end], 1)
            left = np.concatenate([less, more])
            left = left[left[:, 1] - left[:, 0] > 1]
            begin, end = left[:, 0], left[:, 1]

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffixes that agree in their first period of bytes agree in ``length``."""
        v, n = self.cover.period, self.length
        level = max(i for i in range(len(self.ranks)) if i == 0 or (v << i) <= n - v + 1)
        width = v << level
        d = self.cover.delta[x % v, y % v]
        out = np.ones(len(x), bool)
        last = np.maximum(0, (n - d - width) // v)
        for k in range(0, int(last.max(initial=0)) + 1, max(1, width // v)):
            step = d + v * np.minimum(k, last)
            out &= self._rank(level, x + step) == self._rank(level, y + step)
        step = d + v * last
        out &= self._rank(level, x + step) == self._rank(level, y + step)
        for k in range(max(0, n - v), n - 7, 8):
            out &= self.words[x + k] == self.words[y + k]
        return out & (self.words[x + n - 8] == self.words[y + n - 8])


def duplicate_starts(text: np.ndarray, places: np.ndarray, length: int, size: int = RANGE) -> np.ndarray:
    """Those of ``places`` whose ``length`` bytes begin at another of them too."""
    if len(places) < 2:
        return places[:0]
    block = SuffixBlock(text, length)
    first = block.words[places]
    some = np.sort(first[::max(1, len(first) // 4096)])
    cuts = np.unique(some[::max(1, len(some) * size // len(first))])
    bucket = np.searchsorted(cuts, first, side="right")
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket))
    out = []
    for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):  # one range of suffixes at a time
        found, same = block.sorted(places[order[a:b]])
        near = np.flatnonzero(same)
        near = near[block.equal(found[near], found[near - 1])] if len(near) else near
        out += [found[near], found[near - 1]]
    return np.unique(np.concatenate(out))


def duplicate_spans(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context the (start, end) of what its duplicated windows cover."""
    text = np.frombuffer(b"\x00".join(contexts), np.uint8)
    size = np.array([len(c) for c in contexts], np.int64)
    first = np.cumsum(size + 1) - size - 1
    n = np.maximum(0, size - length + 1)
    places = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
    found = duplicate_starts(text, places, length)
    a, b = runs(covered(found, length, len(text)))
    row = np.searchsorted(first, a, side="right") - 1
    spans = np.stack([a - first[row], b - first[row]], 1)
    return np.split(spans, np.searchsorted(row, np.arange(1, len(contexts))))


# Inside tasks: anchors and contexts.

def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive elements."""
    blocks = -(-len(x) // width)
    wide = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    wide[:len(x)] = x
    wide = wide.reshape(blocks, width)
    up = np.minimum.accumulate(wide, axis=1).ravel()
    down = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(down[:n], up[width - 1:width - 1 + n])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place and hash of each anchor of a window that lies in one text, and where its first and its last window start."""
    if len(data) < length:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64)) + 2 * (np.zeros(0, np.int64),)
    grams = gram_hashes(data.astype(np.uint64) + np.uint64(1), gram)
    low = np.uint64((1 << 32) - 1)
    least = sliding_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & low
    inside = np.zeros(len(least) + 1, np.int8)
    begin, end = bounds[:-1], bounds[1:] - length + 1
    fits = end > begin
    inside[begin[fits]] += 1
    np.add.at(inside, end[fits], -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    at = least[starts].astype(np.int64)  # never goes back, so an anchor's windows are neighbours
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][:len(at)])
    last = np.append(new[1:], len(at)) - 1
    return at[new], grams[at[new]], starts[new], starts[last]


def _digests(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, raw)), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _batch(columns, types, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_I8, _I4 = pa.int64(), pa.int32()


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def rows(batches):
        for batch in chunks(batches, "_text"):
            data, bounds = flat(_column(batch, "_text"))
            place, hashes, first, last = anchors(data, bounds, length, gram)
            row = np.searchsorted(bounds, place, side="right") - 1
            raw, at, size = data.tobytes(), place - first, last - first + length
            c1, c2 = _digests([x.to_bytes(4, "little") + raw[a:a + n] for x, a, n in zip(at.tolist(), first.tolist(), size.tolist())])
            # A run of one context, as in a text of one letter, is one row.
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(first) != 1) | (row[1:] != row[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
            begin = np.flatnonzero(new)
            times = np.diff(np.append(begin, len(at)))
            t1, t2 = (_column(batch, c).to_numpy()[row[begin]] for c in ("t1", "t2"))
            yield _batch((as_int64(hashes[begin]), c1[begin], c2[begin], t1, t2, (first - bounds[row])[begin], at[begin], size[begin], times),
                         (_I8,) * 5 + (_I4,) * 4, ["anchor", "c1", "c2", "t1", "t2", "start", "at", "size", "times"])

    return texts.select("t1", "t2", "_text").mapInArrow(rows, "anchor long, c1 long, c2 long, t1 long, t2 long, start int, at int, size int, times int")


def _contexts(joined: DataFrame) -> DataFrame:
    """The bytes of each listed context, and where its anchor is in them."""
    def rows(batches):
        for batch in chunks(batches, "_text"):
            texts = _column(batch, "_text").cast(pa.large_binary())
            out = ([], [], [], [], [])
            for text, listed in zip(texts, _column(batch, "_places").to_pylist()):
                raw = text.as_py()
                for x in listed:
                    for column, value in zip(out, (x["anchor"], x["c1"], x["c2"], x["at"], raw[x["start"]:x["start"] + x["size"]])):
                        column.append(value)
            yield _batch(out, (_I8, _I8, _I8, _I4, pa.binary()), ["anchor", "c1", "c2", "at", "bytes"])

    return joined.mapInArrow(rows, "anchor long, c1 long, c2 long, at int, bytes binary")


def _sort_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """``contexts``: bucket, c1, c2, anchor, shift, bytes. The covered spans of each, moved by ``shift``."""
    dealt = contexts.repartition("bucket").sortWithinPartitions("bucket", "anchor", "c1", "c2")

    def solve(block):
        out = ([], [], [], [], [])
        for (_, anchor, c1, c2, shift, _), spans in zip(block, duplicate_spans([r[5] for r in block], length)):
            for a, b in spans.tolist():
                for column, value in zip(out, (anchor, c1, c2, a + shift, b + shift)):
                    column.append(value)
        return _batch(out, (_I8, _I8, _I8, _I4, _I4), ["anchor", "c1", "c2", "start", "end"])

    def spans(batches):
        block, size, last = [], 0, None
        for batch in chunks(batches, "bytes"):
            for row in zip(*(_column(batch, c).to_pylist() for c in ("bucket", "anchor", "c1", "c2", "shift", "bytes"))):
                if row[0] != last and size > BLOCK_BYTES:
                    yield solve(block)
                    block, size = [], 0
                block.append(row)
                last, size = row[0], size + len(row[5])
        yield solve(block)

    return dealt.mapInArrow(spans, "anchor long, c1 long, c2 long, start int, end int")


def _nodes(contexts: DataFrame, length: int) -> DataFrame:
    """The next smaller ranges of window starts of each context's listed ranges.

    ``low`` to ``high`` are how far before the anchor windows begin, ``core``
    names the range and the bytes all its windows have, f1 and f2 all bytes that
    one of this context's windows has (``start`` to ``end`` of the context).
    """
    def rows(batches):
        for batch in chunks(batches, "bytes"):
            out = tuple([] for _ in range(10))
            for anchor, c1, c2, at, raw, listed in zip(*(_column(batch, c).to_pylist() for c in ("anchor", "c1", "c2", "at", "bytes", "_nodes"))):
                for node in listed:
                    low, high = node["low"], node["high"]
                    step = -(-(high - low + 1) // FAN)
                    for a in range(low, high + 1, step):
                        b = min(high, a + step - 1)
                        x, y = max(a, at + length - len(raw)), min(b, at)
                        if x > y:
                            continue
                        start, end = at - y, at - x + length
                        head = (node["core"] % (1 << 64)).to_bytes(8, "little") + a.to_bytes(4, "little")
                        core = xxhash.xxh3_64_intdigest(head + raw[at - a:at - b + length])
                        whole = xxhash.xxh3_128_digest(raw[start:end])
                        values = (anchor, c1, c2, core - (1 << 64) if core >> 63 else core, a, b, int.from_bytes(whole[:8], "little", signed=True),
                                  int.from_bytes(whole[8:], "little", signed=True), start, end)
                        for column, value in zip(out, values):
                            column.append(value)
            yield _batch(out, (_I8,) * 4 + (_I4,) * 2 + (_I8,) * 2 + (_I4,) * 2,
                         ["anchor", "c1", "c2", "core", "low", "high", "f1", "f2", "start", "end"])

    return contexts.mapInArrow(rows, "anchor long, c1 long, c2 long, core long, low int, high int, f1 long, f2 long, start int, end int")


_CONTEXT = ["anchor", "c1", "c2"]


def _looked_up(rows: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` joined to ``table``, whose ``n`` is how many rows each of its keys has there."""
    bound = max(FREQUENT, (table.agg(F.sum("n")).first()[0] or 0) // MOST_FREQUENT)
    often, seldom = table.where(F.col("n") > bound).drop("n"), table.where(F.col("n") <= bound).drop("n")
    return rows.join(seldom, key).union(rows.join(F.broadcast(often), key))  # often: at most a million rows


def _split_hot(hot: DataFrame, length: int, gram: int, bound: int) -> DataFrame:
    """Spans of the contexts of buckets too large to sort in one block."""
    nodes = hot.select(*_CONTEXT, F.array(F.struct(F.col("anchor").alias("core"), F.lit(0).alias("low"), F.lit(length - gram).alias("high"))).alias("_nodes"))
    found = None
    while True:
        made = stored(_nodes(hot.join(nodes, _CONTEXT), length), "nodes")
        key = ["core", "low", "high", "f1", "f2"]
        own = F.struct(*_CONTEXT, "start", "end")
        alike = stored(made.groupBy(*key).agg(F.min(own).alias("one"), F.max(F.struct(*_CONTEXT)).alias("last"), F.count("*").alias("n"))
                       .select(*key, "one", "n", (F.expr("struct(one.anchor, one.c1, one.c2)") != F.col("last")).alias("many")), "alike")
        full = _looked_up(made, alike.where("many").select(*key, "n"), key).select(*_CONTEXT, "start", "end")
        width = stored(alike.groupBy("core").agg(F.count("*").alias("width")).where("width > 1"), "width")
        heads = alike.join(width, "core").select("core", "low", "high", "width", "one.*")
        few = hot.select(*_CONTEXT, "bytes").join(heads.where(F.col("width") <= bound), _CONTEXT)
        few = few.select(F.col("core").alias("bucket"), *_CONTEXT, F.col("start").alias("shift"), F.expr("substring(bytes, start + 1, end - start)").alias("bytes"))
        spans = stored(full.union(_sort_buckets(few, length)), "spans")
        found = spans if found is None else found.union(spans)
        many = heads.where(F.col("width") > bound)
        nodes = stored(many.groupBy(*_CONTEXT).agg(F.collect_list(F.struct("core", "low", "high")).alias("_nodes")), "hot")
        if not nodes.limit(1).count():
            return found


def _cut(joined: DataFrame, passed, length: int, with_kept: bool) -> DataFrame:
    names = [f.name for f in passed]

    def rows(batches):
        for batch in chunks(batches, "_text"):
            data, bounds = flat(_column(batch, "_text"))
            copies = _column(batch, "_copy").to_pylist()
            n_removed, n_spans, digests, kept_bytes, found = [], [], [], [], []
            for r, spans in enumerate(_column(batch, "_spans").to_pylist()):
                own = data[bounds[r]:bounds[r + 1]]
                gone = np.zeros(len(own), bool)
                if copies[r] and len(own) >= length:
                    gone[:] = True
                elif spans:
                    at = np.array([(s["start"], min(s["end"], len(own))) for s in spans])
                    gone = covered(at[:, 0], at[:, 1] - at[:, 0], len(own))
                a, b = runs(gone)
                kept = own[~gone].tobytes() if len(a) else own.tobytes()
                n_removed.append(int(gone.sum()))
                n_spans.append(len(a))
                digests.append(sha256_hex(kept))
                if with_kept:
                    kept_bytes.append(kept)
                    found.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())])
            arrays = [pa.array(np.diff(bounds)), pa.array(n_removed, _I8), pa.array(n_spans, _I8), pa.array(digests, pa.string())]
            arrays += [pa.array(kept_bytes, pa.binary()), pa.array(found, pa.list_(pa.struct([("start", _I4), ("end", _I4)])))] if with_kept else []
            yield pa.RecordBatch.from_arrays([_column(batch, c) for c in names] + arrays,
                                             names=names + ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "spans"] * with_kept)

    more = ", kept binary, spans array<struct<start:int,end:int>>" * with_kept
    return joined.mapInArrow(rows, out_schema("n_bytes long, n_removed long, n_spans long, kept_sha256 string" + more, passed))


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                          hot: int = HOT, with_kept: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns in ``keep``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for, ``kept`` and ``spans``.

    A byte of a row's text (UTF-8) is removed if a string of ``length`` bytes
    covers it that starts in another place too, of this row or of any other;
    strings do not run on into another row. ``n_spans`` counts the maximal
    removed runs, ``kept`` is what is left, bytes as they are: a character may
    be cut. A null text is empty. Texts below ``length`` bytes stay whole. Rows
    are documents whatever their ids, so repeated rows remove each other, null
    ids too. One row out for each row in; an empty table gives none. Other
    columns are not read, so none can clash.
    """
    if not 8 < gram <= length or length < 2 * PERIOD:
        raise ValueError(f"gram must be above 8 and at most length, and length at least {2 * PERIOD}")
    packed = docs.select(F.struct(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in keep if c != id_col]).alias("_row"),
                         F.col(f"`{text_col}`").alias("_text"), F.xxhash64(F.col(f"`{id_col}`")).alias("s"))
    packed = packed.withColumn("t1", F.xxhash64("_text")).withColumn("t2", F.xxhash64(F.lit(1), "_text"))
    able = packed.where(F.octet_length("_text") >= length)
    text = ["t1", "t2", "s"]
    firsts = able.groupBy("t1", "t2").agg(F.min("s").alias("s"), F.count("*").alias("n"))
    firsts = stored(firsts.select(*text, (F.col("n") > 1).alias("_copy")), "firsts")

    place = F.xxhash64("t1", "t2", "start").alias("p")
    found = stored(_anchor_rows(able, length, gram).distinct().select("*", place), "anchors")
    # A context is met at several places, or at one alone; an anchor has several contexts, or one alone.
    met = found.groupBy(*_CONTEXT).agg(F.min("p").alias("p"), F.max("p").alias("last"), F.max("times").alias("times"), F.max("size").alias("size"), F.count("*").alias("n"))
    met = stored(met.select(*_CONTEXT, "n", "size", "p", F.expr("p <> last OR times > 1").alias("many")), "contexts")
    width = stored(met.groupBy("anchor").agg(F.count("*").alias("width")).where("width > 1"), "width")

    # One place stands for a context; that it is part of the key spreads a frequent context's rows.
    heads = found.join(met.select(*_CONTEXT, "p").join(width, "anchor"), [*_CONTEXT, "p"])
    heads = heads.join(firsts.select(*text), ["t1", "t2"])
    asked = stored(heads.groupBy(*text, (F.col("width") > hot).alias("large")).agg(F.collect_list(F.struct(*_CONTEXT, "start", "at", "size")).alias("_places")), "asked")

    def contexts(large: bool) -> DataFrame:
        return _contexts(able.join(asked.where(F.col("large") == large).drop("large"), text).select("_text", "_places"))

    few = contexts(False).select(F.col("anchor").alias("bucket"), *_CONTEXT, F.lit(0).alias("shift"), "bytes")
    spans = stored(_sort_buckets(few, length), "spans")
    if asked.where("large").limit(1).count():
        spans = spans.union(_split_hot(stored(contexts(True), "large"), length, gram, hot))
    # What is known of a context holds wherever it is met; one that is met twice is covered altogether.
    known = spans.join(met.where("many").select(*_CONTEXT), _CONTEXT, "left_anti").groupBy(*_CONTEXT).agg(F.collect_set(F.struct("start", "end")).alias("_known"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("size").alias("end")))
    known = met.join(known, _CONTEXT, "left").where("many OR _known IS NOT NULL")
    known = stored(known.select(*_CONTEXT, "n", F.coalesce("_known", whole).alias("_known")), "known")
    marks = _looked_up(found.drop("size", "p"), known, _CONTEXT)
    marks = marks.select("t1", "t2", "start", "times", F.explode("_known").alias("k"))
    marks = marks.select("t1", "t2", F.struct((F.col("k.start") + F.col("start")).alias("start"), (F.col("k.end") + F.col("start") + F.col("times") - 1).alias("end")).alias("x"))
    marks = marks.groupBy("t1", "t2").agg(F.collect_set("x").alias("_spans"))
    per_text = firsts.join(marks, ["t1", "t2"], "left")
    joined = packed.join(per_text, text, "left").withColumn("_copy", F.coalesce("_copy", F.lit(True)))
    out = _cut(joined.select("_row", "_text", "_copy", "_spans"), [packed.schema["_row"]], length, with_kept)
    return out.select("_row.*", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept", "spans"] * with_kept)


def op11(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(tables(spark, sf_dir, "documents"), with_kept=False)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS s FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM d WHERE len(h) >= 800)),
starts AS (SELECT r, i FROM windows SEMI JOIN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1) USING (s)),
marked AS (SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 1 ELSE 0 END AS fresh FROM starts),
numbered AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM marked),
spans AS (SELECT r, k, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY r, k),
pieces AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM spans),
kept AS (
  SELECT r, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS t, max(b) AS b, sum(b - a) AS n_removed, count(*) AS n_spans
  FROM pieces JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN t IS NULL THEN h ELSE t || substr(h, 2 * b + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

QUERIES = {"op11_suffix_dedup": op11}
ORACLES = {"op11_suffix_dedup": ORACLE}
