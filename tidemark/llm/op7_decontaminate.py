"""Benchmark decontamination with suffix arrays of the training texts.

Each task cuts its documents into shards of whole documents, builds a suffix
array of every shard's word ids and binary-searches every test suffix that
begins a window. Matches give the words that are hit, the items they come from
and the longest verbatim match with its place. No rows are shuffled: the test
items are broadcast in blocks whose size is checked, one pass a block.

A suffix can only equal a window if as many words as the shortest window has
are words of the items, so the array holds just those suffixes. This leaves out
no match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.llm.store import tables
from tidemark.llm.words import chunks, covered, flat, owner, runs, word_bounds

#: ASCII letters and digits, and every byte of a character beyond ASCII.
_KEEP = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
#: Broadcast at most so many characters of items at once.
BLOCK_CHARS = 16_000_000
SHARD_BYTES = 6 << 20


def plain_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.lower().translate(_KEEP).split() if text else []


class TestIndex:
    """The test items of one block: word ids, and the suffixes that begin windows."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        ids, starts, lengths, names, ends = [], [], [], [], []
        for name, text in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in plain_words(text)]
            if not own:
                continue
            w = min(window, len(own))
            at = np.arange(len(own) - w + 1)
            starts.append(at + len(ids))
            lengths.append(np.full(len(at), w))
            names.append(np.full(len(at), place[name]))
            ids += own
            ends.append(np.full(len(at), len(ids)))
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        self.ids = np.array(ids, np.int64)
        self.starts, self.lengths, self.names_at, self.ends = join(starts), join(lengths), join(names), join(ends)


def suffix_array(ids: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """``positions`` sorted by the ``depth`` ids from there on, by prefix doubling."""
    rank, width = ids.copy(), 1
    where = positions
    while width < depth:
        high = int(rank.max(initial=0)) + 1
        nxt = np.zeros_like(rank)
        nxt[:len(rank) - width] = rank[width:]
        key = rank * (high + 1) + nxt
        # Equal keys get equal ranks; order by key is order by twice as many ids.
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return where[np.argsort(rank[where], kind="stable")]


def search(ids: np.ndarray, sa: np.ndarray, test: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each test suffix, the range of ``sa`` whose suffixes begin with its first ``lengths`` ids."""
    lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(sa), np.int64)
    for depth in range(int(lengths.max(initial=0))):
        live = np.flatnonzero((hi > lo) & (depth < lengths))
        if not len(live):
            break
        want = test[starts[live] + depth]
        bounds = []
        for extra in (0, 1):  # first suffix with an id not below want, then with one above
            a, b = lo[live].copy(), hi[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) // 2
                less = open_ & (ids[np.minimum(sa[np.minimum(mid, len(sa) - 1)] + depth, len(ids) - 1)] < want + extra)
                a, b = np.where(less, mid + 1, a), np.where(open_ & ~less, mid, b)
            bounds.append(a)
        lo[live], hi[live] = bounds
    return lo, np.maximum(hi, lo)


def match_shard(texts: list[bytes | None], index: TestIndex) -> dict:
    """What the texts of one shard share with the items.

    Returns ``n_words`` by text, ``hit`` (a flag for each word of the shard, a
    gap after each text), ``first`` (each text's first word), ``pairs`` (text
    and item, each once) and ``longest`` (match length, word start, item, by text).
    """
    get, ids, first = index.vocabulary.get, [], [0]
    for text in texts:
        ids += [get(w, 0) for w in plain_words(text)]
        ids.append(0)  # a gap that no window has
        first.append(len(ids))
    ids, first = np.array(ids, np.int64), np.array(first, np.int64)
    text_of = owner(first)
    longest = np.zeros((len(texts), 3), np.int64)
    out = {"n_words": np.diff(first) - 1, "hit": np.zeros(len(ids), bool), "first": first, "pairs": np.zeros((0, 2), np.int64), "longest": longest}
    if not len(index.starts):
        return out
    known = ids > 0
    a, b = runs(known)
    room = np.zeros(len(ids), np.int64)
    room[known] = np.repeat(b, b - a) - np.flatnonzero(known)
    eligible = np.flatnonzero(room >= int(index.lengths.min()))
    if not len(eligible):
        return out
    # The array is built over the runs that hold eligible suffixes, each followed by a gap.
    keep = np.zeros(len(ids) + 1, bool)
    long_runs = (b - a) >= int(index.lengths.min())
    for_run = np.zeros(len(ids) + 2, np.int64)
    np.add.at(for_run, a[long_runs], 1)
    np.add.at(for_run, b[long_runs] + 1, -1)
    keep = np.cumsum(for_run)[:len(ids)] > 0
    back = np.flatnonzero(keep)
    small = np.where(known, ids, 0)[back]
    place = np.full(len(ids), -1, np.int64)
    place[back] = np.arange(len(back))
    sa = suffix_array(small, place[eligible], int(index.lengths.max()))
    lo, hi = search(small, sa, index.ids, index.starts, index.lengths)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return out
    n = (hi - lo)[found]
    which = np.repeat(found, n)
    at = back[sa[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[found], n)]]
    lengths = index.lengths[which]
    out["hit"] = covered(at, lengths, len(ids)) if len(at) else out["hit"]
    out["pairs"] = np.unique(np.stack([text_of[at], index.names_at[which]], 1), axis=0)
    # Lengthen each match word by word as far as item and document agree.
    size, more = lengths.copy(), np.arange(len(at))
    while len(more):
        x, y = at[more] + size[more], index.starts[which[more]] + size[more]
        same = (y < index.ends[which[more]]) & (ids[np.minimum(x, len(ids) - 1)] == index.ids[np.minimum(y, len(index.ids) - 1)])
        more = more[same]
        size[more] += 1
    order = np.lexsort((index.names_at[which], at, -size, text_of[at]))
    text, best = np.unique(text_of[at][order], return_index=True)
    pick = order[best]
    longest[text] = np.stack([size[pick], at[pick] - first[text], index.names_at[which[pick]]], 1)
    return out


def _block_step(df: DataFrame, text_col: str, index, last: bool) -> DataFrame:
    state = "_n_words long, _spans array<int>, _items array<string>, _longest struct<length:int,start:int,item:string>"
    own = [x.split()[0] for x in state.split(", ") if not x.startswith("_longest")] + ["_longest"]
    passed = [f for f in df.schema.fields if f.name not in own and not (last and f.name == text_col)]
    names = [f.name for f in passed]

    def step(batches):
        block = index.value
        for batch in chunks(batches, text_col, SHARD_BYTES):
            column = batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_binary())
            got = match_shard(column.to_pylist(), block)
            first, spans, longest = got["first"], [], []
            seen = [[] for _ in range(batch.num_rows)]
            for t, i in got["pairs"].tolist():
                seen[t].append(block.names[i])
            a, b = runs(got["hit"])
            row = np.searchsorted(first, a, side="right") - 1
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for r in range(batch.num_rows):
                s = slice(cut[r], cut[r + 1])
                spans.append(np.stack([a[s], b[s]], 1).ravel() - first[r])
                size, start, item = got["longest"][r].tolist()
                longest.append({"length": size, "start": start, "item": block.names[item]} if size else None)
            if "_spans" in batch.schema.names:
                old = {k: batch.column(batch.schema.get_field_index(k)).to_pylist() for k in own}
                for r in range(batch.num_rows):
                    spans[r] = _merged(np.array(old["_spans"][r], np.int64), spans[r])
                    seen[r] = sorted({*seen[r], *old["_items"][r]})
                    longest[r] = max((x for x in (old["_longest"][r], longest[r]) if x), key=lambda x: x["length"], default=None)
            kind = pa.struct([("length", pa.int32()), ("start", pa.int32()), ("item", pa.string())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names]
                + [pa.array(got["n_words"]), pa.array([x.tolist() for x in spans], pa.list_(pa.int32())),
                   pa.array(seen, pa.list_(pa.string())), pa.array(longest, kind)],
                names=[*names, *own])

    return df.mapInArrow(step, StructType([*passed, *StructType.fromDDL(state).fields]))


def _merged(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    both = np.concatenate([x, y]).reshape(-1, 2)
    flags = covered(both[:, 0], both[:, 1] - both[:, 0], int(both.max(initial=0)))
    return np.stack(runs(flags), 1).ravel()


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = 13, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the text, plus what each shares with ``items``.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window of
    ``window`` item words; a shorter item is one window), ``n_items``,
    ``items_sha256`` (of the sorted, comma-joined item ids), ``contaminated``
    (at least one word hit, and a twentieth of all), ``hit_spans`` (word start
    and end, flat) and ``longest_match`` (length, word start, item).

    One row out for each row in, repeated ids too. A null or empty text, or one
    without words, has no words and is clean. Items with a null id or without
    words are left out; with no items nothing is hit. Columns of ``docs`` with
    an added name are replaced; any other name may occur.
    """
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans", "longest_match"]
    # A row's own columns travel as one struct, so none of their names can clash with a helper's.
    rest = [c for c in docs.columns if c != text_col and c not in added]
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("none")]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    items = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("binary").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    sc = docs.sparkSession.sparkContext
    for k in range(blocks):
        # Sized by the sum above: one block of items at a time reaches the driver.
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()
        index = sc.broadcast(TestIndex(sorted((r.i, bytes(r.t)) for r in rows), window))
        docs = _block_step(docs, "_text", index, last=k == blocks - 1)
    hit = F.expr("aggregate(sequence(1, size(_spans), 2), 0L, (s, i) -> s + _spans[i] - _spans[i - 1])")
    hit = F.when(F.size("_spans") == 0, F.lit(0).cast("long")).otherwise(hit)
    names = F.array_sort(F.array_distinct("_items"))
    n_hit, n_words = hit.alias("n_hit"), F.col("_n_words").alias("n_words")
    contaminated = ((hit > 0) & (20 * hit >= F.col("_n_words"))).alias("contaminated")
    return docs.select(*[F.col("_row").getField(c).alias(c) for c in rest], n_words, n_hit, F.size(names).cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), contaminated,
                       F.col("_spans").alias("hit_spans"), F.col("_longest").alias("longest_match"))


def remove_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    names = docs.columns
    copy = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    found = find_contamination(copy, items, text_col="_text", **options)
    return found.where(~F.col("contaminated")).select("_row.*")


def op7(spark, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, tables(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, list_aggregate(w[i : i + least(len(w), 13) - 1], 'string_agg', ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
found_at AS (
  SELECT doc_id, n, i, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item, i, f.n FROM found_at f JOIN windows ON f.n = windows.n AND f.s = windows.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUERIES = {"op7_decontaminate": op7}
ORACLES = {"op7_decontaminate": ORACLE}
