"""Substring dedup: suffix automata of reference texts, matching statistics, removal of long shared spans.

A word goes if a window of ``length`` words of one document covers it whose
word sequence also starts in a document with a smaller id. One automaton of
everything smaller would neither fit a task nor a broadcast, so the reference
texts are cut into shards that surely hold what a document can match:

1. Every window has an anchor: its smallest ``gram``-word hash (leftmost). Equal
   windows have equal anchors in equal places. Anchors found in one document
   only are dropped after a pre-aggregated count.
2. Each other anchor is dealt out with the words around it that its windows can
   hold. The rows of an anchor are one reference shard: documents are streamed
   by id, matched against the automaton of those before them, and added to it.
   Match lengths of ``length`` or more are the spans to remove.
3. An anchor in more than ``hot`` documents (a passage or a group of copies) is
   not grouped: its windows are counted one by one, with a smallest id each. At
   most a million anchors are hot, so these can be broadcast. So can windows that
   are met more often than once in a million: tasks look these up in place.

Exact copies of a text with a smaller id are settled by their text's hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import stored, tables
from tidemark.llm.words import (as_int64, chunks, covered, flat, gram_hashes, out_schema, owner, runs, sha256_hex,
                                window_starts, word_bounds, word_hashes)

GRAM = 20
#: Documents beyond which an anchor is hot (its automaton would hold some 80 words of each), and how many anchors can be hot at most.
HOT, MOST_HOT = 64, 1_000_000
#: Meetings beyond which a hot anchor's window is looked up in place.
OFTEN = 1_000


class SuffixAutomaton:
    """Of several word sequences; ``lengths`` streams another one over it."""

    def __init__(self):
        self.to: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]

    def add(self, words: list[int]) -> None:
        to, link, size, last = self.to, self.link, self.size, 0
        for w in words:
            if w in to[last]:
                q = to[last][w]
                last = q if size[q] == size[last] + 1 else self._split(last, w, q)
                continue
            new = len(to)
            to.append({})
            link.append(0)
            size.append(size[last] + 1)
            p = last
            while p != -1 and w not in to[p]:
                to[p][w] = new
                p = link[p]
            if p != -1:
                q = to[p][w]
                link[new] = q if size[q] == size[p] + 1 else self._split(p, w, q)
            last = new

    def _split(self, p: int, w: int, q: int) -> int:
        """A state for the shorter strings of ``q`` that end in ``p`` and ``w``."""
        new = len(self.to)
        self.to.append(dict(self.to[q]))
        self.link.append(self.link[q])
        self.size.append(self.size[p] + 1)
        while p != -1 and self.to[p].get(w) == q:
            self.to[p][w] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def lengths(self, words: list[int]) -> list[int]:
        """Matching statistics: at each word, how many words up to it the automaton has in a row."""
        to, link, size, state, n, out = self.to, self.link, self.size, 0, 0, []
        for w in words:
            while state and w not in to[state]:
                state = link[state]
                n = size[state]
            if w in to[state]:
                state = to[state][w]
                n += 1
            out.append(n)
        return out


def shared_spans(automaton: SuffixAutomaton, words: list[int], length: int) -> list[tuple[int, int]]:
    """Merged word spans of ``words`` that lie in matches of ``length`` words or more."""
    spans: list[tuple[int, int]] = []
    for end, n in enumerate(automaton.lengths(words), 1):
        if n >= length:
            start = end - n
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, end))
    return spans


def shard_spans(rows, length: int):
    """``rows`` of one anchor by id: (id, text key, place, words). Yields (text key, start, end)."""
    automaton, seen, waiting, last = SuffixAutomaton(), {}, [], None
    for doc, key, at, words in rows:
        if doc != last:  # a document is not held against itself
            for w in waiting:
                automaton.add(np.frombuffer(w, np.uint32).tolist())
            waiting, last = [], doc
        if words not in seen:
            seen[words] = doc
            waiting.append(words)
        if seen[words] != doc:
            if len(words) >= 4 * length:
                yield key, at, at + len(words) // 4
        elif len(automaton.to) > 1:
            for a, b in shared_spans(automaton, np.frombuffer(words, np.uint32).tolist(), length):
                yield key, at + a, at + b


def anchors(grams: np.ndarray, first: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows that lie in one text, and where each one's anchor is."""
    width = length - gram + 1
    starts = np.flatnonzero(window_starts(first, length))
    if not len(starts):
        return starts, starts
    best = np.lib.stride_tricks.sliding_window_view(grams, width)[starts].argmin(1)
    return starts, best + starts


def _read(batch: pa.RecordBatch):
    data, bounds = flat(batch.column(batch.schema.get_field_index("_text")))
    starts, ends, first = word_bounds(data, bounds)
    return word_hashes(data, starts, ends), first


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def rows(batches):
        for batch in chunks(batches, "_text"):
            words, first = _read(batch)
            grams = gram_hashes(words, gram)
            at = np.unique(anchors(grams, first, length, gram)[1])
            row = owner(first)[at]
            yield pa.RecordBatch.from_arrays([pa.array(as_int64(grams[at])), pa.array(_column(batch, "_id")[row]), pa.array(_column(batch, "_key")[row]),
                                              pa.array((at - first[row]).astype(np.int32))], names=["anchor", "_id", "_key", "place"])

    return docs.select("_id", "_key", "_text").mapInArrow(rows, "anchor long, _id long, _key long, place int")


def _among(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``values`` are in the sorted ``table``, and which of them are there at all."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _hot_starts(batch: pa.RecordBatch, hot: np.ndarray, length: int, gram: int):
    """Starts of the windows whose anchor is hot, their hashes, their rows, and each row's first word."""
    words, first = _read(batch)
    grams = gram_hashes(words, gram)
    starts, at = anchors(grams, first, length, gram)
    starts = starts[_among(as_int64(grams)[at], hot)[1]]
    hashes = as_int64(gram_hashes(words, length)[starts]) if len(starts) else np.zeros(0, np.int64)
    return starts, hashes, owner(first)[starts], first


def _hot_windows(docs: DataFrame, hot, length: int, gram: int, without) -> DataFrame:
    """The windows of hot anchors, but for those in ``without`` (sorted hashes)."""
    def rows(batches):
        for batch in chunks(batches, "_text"):
            starts, hashes, row, first = _hot_starts(batch, hot.value, length, gram)
            left = ~_among(hashes, without.value[0])[1]
            starts, hashes, row = starts[left], hashes[left], row[left]
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(_column(batch, "_id")[row]), pa.array(_column(batch, "_key")[row]),
                                              pa.array((starts - first[row]).astype(np.int32))], names=["window", "_id", "_key", "place"])

    return docs.select("_id", "_key", "_text").mapInArrow(rows, "window long, _id long, _key long, place int")


def _hot_counts(docs: DataFrame, hot, length: int, gram: int) -> DataFrame:
    """Smallest and largest id and number of the hot anchors' windows, summed up in each chunk."""
    def rows(batches):
        for batch in chunks(batches, "_text"):
            _, hashes, row, _ = _hot_starts(batch, hot.value, length, gram)
            ids = _column(batch, "_id")[row]
            order = np.lexsort((ids, hashes))
            hashes, ids = hashes[order], ids[order]
            begin = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][:len(hashes)])
            end = np.append(begin[1:], len(hashes))
            yield pa.RecordBatch.from_arrays([pa.array(hashes[begin]), pa.array(ids[begin]), pa.array(ids[end[:len(begin)] - 1]), pa.array((end[:len(begin)] - begin).astype(np.int64))],
                                             names=["window", "a", "b", "n"])

    return docs.select("_id", "_text").mapInArrow(rows, "window long, a long, b long, n long")


def _often_spans(docs: DataFrame, hot, often, length: int, gram: int) -> DataFrame:
    """Merged spans of the windows in ``often`` (sorted hashes, and each one's smallest id) that an earlier document has."""
    def rows(batches):
        for batch in chunks(batches, "_text"):
            starts, hashes, row, first = _hot_starts(batch, hot.value, length, gram)
            at, known = _among(hashes, often.value[0])
            known[known] = _column(batch, "_id")[row[known]] > often.value[1][at[known]]
            a, b = runs(covered(starts[known], length, int(first[-1])))
            # Texts touch here: a run may go on into the next one.
            cuts = np.unique(np.concatenate([a, b, first[(np.searchsorted(a, first, side="right") > np.searchsorted(b, first, side="right"))]]))
            inside = np.searchsorted(a, cuts[:-1], side="right") > np.searchsorted(b, cuts[:-1], side="right")
            a, b = cuts[:-1][inside], cuts[1:][inside]
            row = np.searchsorted(first, a, side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(_column(batch, "_key")[row]), pa.array((a - first[row]).astype(np.int32)), pa.array((b - first[row]).astype(np.int32))],
                                             names=["_key", "start", "end"])

    return docs.select("_id", "_key", "_text").mapInArrow(rows, "_key long, start int, end int")


def _context_rows(joined: DataFrame, length: int, gram: int) -> DataFrame:
    """For each listed place its anchor and the words that windows around it can hold, as 32-bit hashes."""
    side = length - gram

    def rows(batches):
        for batch in chunks(batches, "_text"):
            words, first = _read(batch)
            small = (words >> np.uint64(32)).astype(np.uint32)
            listed = batch.column(batch.schema.get_field_index("_places"))
            ids, keys = _column(batch, "_id"), _column(batch, "_key")
            out = ([], [], [], [], [])
            for r in np.flatnonzero(listed.is_valid().to_numpy(zero_copy_only=False)).tolist():
                begin, end = int(first[r]), int(first[r + 1])
                for x in listed[r].as_py():
                    a = max(0, x["place"] - side)
                    for column, value in zip(out, (x["anchor"], int(ids[r]), int(keys[r]), a, small[begin + a:min(end, begin + x["place"] + length)].tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                             names=["anchor", "_id", "_key", "place", "words"])

    return joined.mapInArrow(rows, "anchor long, _id long, _key long, place int, words binary")


def _shard_spans(contexts: DataFrame, length: int) -> DataFrame:
    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor", "_id", "_key", "place")

    def spans(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))
        key, group, out = None, [], []
        for anchor, *row in rows():
            if anchor != key:
                if len(group) > 1:
                    out += shard_spans(group, length)
                key, group = anchor, []
                if len(out) > 10_000:
                    yield _span_batch(out)
                    out = []
            group.append(row)
        if len(group) > 1:
            out += shard_spans(group, length)
        yield _span_batch(out)

    return dealt.mapInArrow(spans, "_key long, start int, end int")


def _span_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], names=["_key", "start", "end"])


def _cut(joined: DataFrame, passed, length: int, with_text: bool) -> DataFrame:
    names = [f.name for f in passed]

    def rows(batches):
        for batch in chunks(batches, "_text"):
            texts = batch.column(batch.schema.get_field_index("_text")).cast(pa.large_binary()).to_pylist()
            copies = batch.column(batch.schema.get_field_index("_copy")).to_pylist()
            listed = batch.column(batch.schema.get_field_index("_spans")).to_pylist()
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for text, copy, spans in zip(texts, copies, listed):
                words = (text or b"").split()
                gone = np.zeros(len(words), bool)
                if copy and len(words) >= length:
                    gone[:] = True
                elif spans:
                    at = np.array([(s["start"], s["end"]) for s in spans])
                    gone = covered(at[:, 0], at[:, 1] - at[:, 0], len(words))
                kept = b" ".join(w for w, g in zip(words, gone) if not g) if gone.any() else b" ".join(words)
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                digests.append(sha256_hex(kept))
                if with_text:
                    kept_texts.append(kept if n_removed[-1] else text)
            arrays = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests)]
            arrays += [pa.array(kept_texts, pa.large_binary()).cast(pa.large_string()).cast(pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in names] + arrays,
                                             names=names + ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text)

    return joined.mapInArrow(rows, out_schema("n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text, passed))


def remove_shared_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, gram: int = GRAM,
                        hot: int = HOT, with_text: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns in ``keep``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text`` of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``kept_text`` is the text itself where
    nothing goes, else the kept words joined by one space; ``kept_sha256`` is
    that of the joined words in either case. Ids are integers. A null text has
    no words. A row with a null id is kept whole and removes nothing. Rows with
    an equal id do not remove from each other. Texts below ``length`` words are
    kept. One row out for each row in.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be from 1 to length")
    packed = docs.select(F.struct(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in keep if c != id_col]).alias("_row"),
                         F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    # Rows of one key have one id and one text, so that what holds for one holds for all.
    packed = packed.withColumn("_key", F.xxhash64("_id", "_text"))
    able = packed.where("_id IS NOT NULL AND _text IS NOT NULL")

    texts = able.select(F.xxhash64("_text", F.lit(1)).alias("h"), "_id", "_key")
    firsts = texts.groupBy("h").agg(F.min(F.struct("_id", "_key")).alias("m")).select(F.col("m._key").alias("_key"), F.lit(False).alias("_copy"))

    found = _anchor_rows(able, length, gram)
    shared = found.groupBy("anchor").agg(F.min("_id").alias("a"), F.max("_id").alias("b"), F.count("*").alias("n")).where("a < b")
    shared = stored(shared.select("anchor", "n"), "anchors")
    bound = max(hot, (shared.agg(F.sum("n")).first()[0] or 0) // MOST_HOT)
    hot_list = [r.anchor for r in shared.where(F.col("n") > bound).select("anchor").collect()]  # MOST_HOT at most

    places = found.join(shared.where(F.col("n") <= bound).select("anchor"), "anchor").select("_key", F.struct("place", "anchor").alias("x"))
    places = places.join(firsts.select("_key"), "_key", "left_semi").groupBy("_key").agg(F.collect_set("x").alias("_places"))
    # Both joins read one exchange of the texts: neither filters them.
    contexts = _context_rows(packed.join(places, "_key", "left"), length, gram)
    spans = _shard_spans(contexts, length)
    if hot_list:
        hot_list = docs.sparkSession.sparkContext.broadcast(np.array(sorted(hot_list), np.int64))
        least = _hot_counts(able, hot_list, length, gram).groupBy("window")
        least = least.agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n")).where("a < b")
        least = stored(least.select("window", "a", "n"), "windows")
        many = F.col("n") > max(OFTEN, (least.agg(F.sum("n")).first()[0] or 0) // MOST_HOT)
        often = least.where(many).select("window", "a").orderBy("window").toArrow()  # MOST_HOT at most
        often = docs.sparkSession.sparkContext.broadcast(tuple(often[c].to_numpy() for c in ("window", "a")))
        spans = spans.union(_often_spans(able, hot_list, often, length, gram))
        windows = _hot_windows(able, hot_list, length, gram, often)
        more = windows.join(least.where(~many).select("window", "a"), "window").where("_id > a").select("_key", F.col("place").alias("start"), (F.col("place") + length).alias("end"))
        spans = spans.union(more)
    spans = spans.distinct().groupBy("_key").agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    joined = packed.join(spans, "_key", "left").join(firsts, "_key", "left")
    joined = joined.withColumn("_copy", F.coalesce("_copy", F.col("_id").isNotNull() & F.col("_text").isNotNull()))
    out = _cut(joined, [f for f in joined.schema.fields if f.name == "_row"], length, with_text)
    return out.select("_row.*", "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text)


def op4(spark, sf_dir: str) -> DataFrame:
    return remove_shared_spans(tables(spark, sf_dir, "documents"), with_text=False)


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(list_aggregate(w[i : i + 49], 'string_agg', ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
least AS (SELECT s, min(doc_id) AS a FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, list(DISTINCT p) AS p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN least USING (s) WHERE doc_id > a) GROUP BY doc_id),
flat AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d SEMI JOIN gone USING (doc_id)),
marked AS (SELECT DISTINCT doc_id, unnest(p) AS i FROM gone),
kept AS (SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS t FROM flat ANTI JOIN marked USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN p IS NULL THEN coalesce(list_aggregate(w, 'string_agg', ' '), '') ELSE coalesce(t, '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUERIES = {"op4_substring_dedup": op4}
ORACLES = {"op4_substring_dedup": ORACLE}
