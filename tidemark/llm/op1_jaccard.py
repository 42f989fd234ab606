"""N-gram Jaccard join: T-occurrence search with DivideSkip, without emitting all pairs.

1. Equal shingle sets form a class; only classes are compared.
2. Blocking that loses no link. Two sets that reach the threshold differ in at
   most ``k`` shingles, where ``k`` follows from their sizes. Cut the hash space
   into more than ``k`` parts: one part at least holds the same shingles in both
   sets. Each class signs every part. Classes with an equal signature of several
   shingles fall into one candidate group (connected components over these).
   A part of one or two shingles is often equal by chance, where texts share a
   line; it gives candidate pairs instead, and only across groups. There are more
   than k + 1 parts, so a linked pair has several equal ones: pairs with fewer go
   before any text is shipped. Shingles that
   very many texts have are left out of the parts: leaving out any fixed set of
   shingles takes no equal part away.
3. In a candidate group the sets are indexed by inverted lists. Each set is a
   query: the short lists are heap-merged with skips, the long ones probed by
   binary search (DivideSkip), and what reaches the required overlap is checked
   exactly. Only links that join two components of the group are emitted.
4. A group beyond ``block_shingles`` is dealt over blocks; one member goes to all
   of them. Where that leaves several components, the members of all but the
   largest go to every block as queries, which finds each link that still counts.

Components are thus those of all links, while rows emitted stay in proportion
to documents.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.store import stored, tables
from tidemark.llm.words import as_int64, chunks, flat, gram_hashes, mix, window_starts, word_bounds, word_hashes

_CLASS, _PART, _ALONE = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)
#: Work of probing a list for one document, in merged entries.
PROBE = 20
#: Entries of short lists up to which these are merged by a heap.
HEAP_ENTRIES = 400
BLOCK_SHINGLES = 400_000
QUERIES_PER_CHUNK = 500
#: Shingles of a part from which equal parts make a group.
WIDE = 3
#: A shingle counts as frequent from so many texts on, found so often in some task at least; so many are left out at most.
FREQUENT, FREQUENT_IN_TASK, MOST_FREQUENT = 100, 3, 1_000_000
_COUNTED = 4_000_000
#: Rows of a plan (40 bytes each) that may be broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


# Inside tasks: sets, classes, signatures.

def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``n``-word shingles; of a shorter text, one of all its words."""
    data, bounds = flat(column, lower=True)
    starts, ends, first = word_bounds(data, bounds)
    words = word_hashes(data, starts, ends)
    grams, begins = gram_hashes(words, n), window_starts(first, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        else:
            out.append(gram_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    assert len(begins) == first[-1]
    return out


def set_class(hashes: np.ndarray) -> int:
    return int(as_int64(mix(np.array([mix(hashes ^ _CLASS).sum(dtype=np.uint64) + np.uint64(len(hashes))])))[0])


class Levels:
    """Size levels such that two sets that can reach the threshold are in one level or in neighbouring ones."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low, self.high = [1], []
        while self.low[-1] < 1 << 40:
            self.high.append(max(self.low[-1], self.low[-1] * den // num))
            self.low.append(self.high[-1] + 1)
        self.low = np.array(self.low[:-1])
        # Sets of sizes up to h that reach the threshold differ in at most k elements.
        k = [2 * h * (den - num) // (den + num) for h in self.high]
        #: Parts beyond k + 1: so many more of a linked pair are equal, or empty in both.
        self.spare = np.array([0 if not x else max(1, x // 8) for x in k])
        self.parts = np.array(k) + 1 + self.spare

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, side="right") - 1


def _among(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(hashes), bool)
    return frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes


def signatures(sets: list[np.ndarray], levels: Levels, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
    """Signatures of non-empty ``sets``, the index of each one's set, whether it is of several shingles, its level, and how many it must share.

    Two linked sets share at least the larger of their two numbers of signatures
    at a level that both have: of its parts ``k`` at most are unequal, and an
    empty part of both is no signature. ``frequent``: sorted hashes that parts
    leave out.
    """
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int32), np.zeros(0, np.int32)
    sizes = np.array([len(s) for s in sets])
    every, who = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    often = _among(every, frequent)
    own, of_set = every[~often], who[~often]
    mixed, high = mix(own ^ _PART), own >> np.uint64(32)
    found, owners, wide, at_level, needs, sparse = [], [], [], [], [], np.zeros(len(sets), bool)
    for up in (0, 1):  # its own level, and the next one's for larger partners
        level = levels.of(sizes) + up
        parts = levels.parts[level]
        part = (high * parts[of_set].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(own), bool)
        new[1:] = (of_set[1:] != of_set[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        of = of_set[begin]
        empty = parts - np.bincount(of, minlength=len(sets))
        if len(begin):
            found.append(mix(np.add.reduceat(mixed, begin) + part[begin] * _ALONE + level[of].astype(np.uint64) * _CLASS))
            owners.append(of)
            # A whole set of one part is no part equal by chance.
            wide.append((np.diff(np.r_[begin, len(own)]) >= WIDE) | (parts[of] == 1))
            at_level.append(level[of])
            needs.append((1 + levels.spare[level] - empty)[of])
        sparse |= empty > levels.spare[level]
    first = np.concatenate([[0], np.cumsum(sizes)])
    for i in np.flatnonzero(sparse):
        # Two sets with too many empty parts share one of their first hashes instead (prefix filter), frequent ones last.
        n, o = int(sizes[i]), often[first[i]:first[i + 1]]
        order = np.argsort(o, kind="stable")[:n - -(-n * levels.num // levels.den) + 1]
        found.append(mix(sets[i][order] ^ _ALONE))
        owners.append(np.full(len(order), i))
        wide.append(o[order])
        at_level.append(np.full(len(order), -1))
        needs.append(np.zeros(len(order), np.int64))
    return tuple(np.concatenate(x) for x in (found, owners, wide)) + tuple(np.concatenate(x).astype(np.int32) for x in (at_level, needs))


# Inside tasks: DivideSkip over one block.

class Forest:
    def __init__(self, n: int):
        self.up, self.trees = list(range(n)), n

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
            self.trees -= 1
        return i != j


def merge_skip(lists: list[list[int]], need: int) -> dict[int, int]:
    """Elements in at least ``need`` of the sorted ``lists``, with their counts."""
    heap = [(x[0], i, 0) for i, x in enumerate(lists) if x]
    heapq.heapify(heap)
    found: dict[int, int] = {}
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need:
            found[top] = len(popped)
            for _, i, at in popped:
                if at + 1 < len(lists[i]):
                    heapq.heappush(heap, (lists[i][at + 1], i, at + 1))
            continue
        # Fewer than need: no element below the need-th smallest head can reach it.
        while heap and len(popped) < need - 1:
            popped.append(heapq.heappop(heap))
        if not heap:
            break
        head = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(lists[i], head, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))
    return found


class InvertedIndex:
    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        self.tokens, token = np.unique(every, return_inverse=True)
        who = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(token, kind="stable")
        self.docs = who[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(token, minlength=len(self.tokens)))])
        #: One sorted key for each (token, document): a probe of any list is a binary search here.
        self.keys = token[order] * len(sets) + self.docs

    def _merge(self, tokens: np.ndarray, length: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents in at least ``need`` of the tokens' lists, and in how many."""
        total = int(length.sum())
        if total <= HEAP_ENTRIES:
            counts = merge_skip([self.docs[self.first[t]:self.first[t + 1]].tolist() for t in tokens.tolist()], need)
            return np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))
        # The same count without a heap, where lists are long.
        place = np.arange(total) + np.repeat(self.first[tokens] - np.cumsum(length) + length, length)
        counts = np.bincount(self.docs[place], minlength=len(self.sets))
        docs = np.flatnonzero(counts >= need)
        return docs, counts[docs]

    def linked(self, query: np.ndarray, num: int, den: int) -> np.ndarray:
        """Documents whose set reaches num / den of Jaccard similarity with ``query``."""
        n = len(query)
        need = -(-n * num // den)  # the overlap with any partner that is not too small
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        if len(at) < need:
            return np.zeros(0, np.int64)
        length = self.first[at + 1] - self.first[at]
        order = np.argsort(length, kind="stable")
        at, length = at[order], length[order]
        # How many long lists to leave to probes: the number with the least estimated work.
        merged = np.concatenate([[0], np.cumsum(length)])[len(at) - np.arange(need)]
        left = need - np.arange(need)
        n_long = int(np.argmin(merged + PROBE * np.arange(need) * np.minimum(merged / left, len(self.sets))))
        cut = len(at) - n_long
        docs, overlap = self._merge(at[:cut], length[:cut], need - n_long)
        step = max(1, 2_000_000 // max(1, n_long))
        for some in range(0, len(docs) if n_long else 0, step):
            s = slice(some, some + step)
            probe = (at[None, cut:] * len(self.sets) + docs[s, None]).ravel()
            place = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            overlap[s] += (self.keys[place] == probe).reshape(-1, n_long).sum(1)
        return docs[den * overlap >= num * (n + self.sizes[docs] - overlap)]


def link_block(members: list[np.ndarray], queries: list[np.ndarray] | None, num: int, den: int) -> list[tuple[int, int]]:
    """Links (numbers below ``len(members)`` are members, then queries) that join two components of the block.

    Without ``queries`` each member is one.
    """
    index = InvertedIndex(members)
    asked = members if queries is None else queries
    shift = 0 if queries is None else len(members)
    forest, out = Forest(len(members) + (0 if queries is None else len(queries))), []
    for q, query in enumerate(asked):
        if forest.trees == 1:
            break
        out += [(q + shift, d) for d in index.linked(query, num, den).tolist() if forest.join(q + shift, d)]
    return out


# The Spark job.

def _doc_classes(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    def rows(batches):
        for batch in chunks(batches, "_text"):
            sets = shingle_sets(batch.column(1), n)
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array([set_class(s) if len(s) else None for s in sets], pa.int64())],
                names=["_id", "n_shingles", "class"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return picked.mapInArrow(rows, f"_id {kind}, n_shingles long, class long")


def _frequent(texts: DataFrame, n: int) -> np.ndarray:
    """Sorted hashes of shingles that many texts have, ``MOST_FREQUENT`` at most.

    Which ones exactly only bears on the work: links do not depend on it.
    """
    def rows(batches):
        held, size, seen = [], 0, set()

        def counted():
            hashes, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            many = counts >= FREQUENT_IN_TASK
            return pa.RecordBatch.from_arrays([pa.array(as_int64(hashes[many])), pa.array(counts[many])], names=["hash", "n"])

        for batch in chunks(batches, "_text"):
            for s in shingle_sets(batch.column(0), n):
                if len(s) and (c := set_class(s)) not in seen:
                    seen.add(c)
                    held.append(s)
                    size += len(s)
            if size > _COUNTED:
                yield counted()
                held, size = [], 0
        yield counted()

    many = texts.mapInArrow(rows, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    got = many.orderBy(F.desc("n"), "hash").limit(MOST_FREQUENT).select("hash").toArrow()["hash"].to_numpy()
    return np.sort(got.astype(np.int64).view(np.uint64))


def _signature_rows(texts: DataFrame, n: int, num: int, den: int, frequent) -> DataFrame:
    def rows(batches):
        levels, seen = Levels(num, den), set()
        for batch in chunks(batches, "_text"):
            own, classes = [], []
            for s in shingle_sets(batch.column(0), n):
                if len(s) and (c := set_class(s)) not in seen:  # a task signs copies once
                    seen.add(c)
                    own.append(s)
                    classes.append(c)
            sig, who, wide, level, need = signatures(own, levels, frequent.value)
            yield pa.RecordBatch.from_arrays([pa.array(as_int64(sig)), pa.array(np.array(classes, np.int64)[who]), pa.array(wide), pa.array(level), pa.array(need)],
                                             names=["sig", "class", "wide", "level", "need"])

    return texts.mapInArrow(rows, "sig long, class long, wide boolean, level int, need int")


def _class_texts(texts: DataFrame, n: int) -> DataFrame:
    def rows(batches):
        seen = set()
        for batch in chunks(batches, "_text"):
            keep, classes = [], []
            for i, s in enumerate(shingle_sets(batch.column(0), n)):
                if len(s) and (c := set_class(s)) not in seen:
                    seen.add(c)
                    keep.append(i)
                    classes.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), batch.column(0).take(pa.array(keep, pa.int64()))], names=["class", "_text"])

    return texts.mapInArrow(rows, "class long, _text string")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _block_links(texts: DataFrame, plan: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``plan``: class, group, block, chunk, query. Links found in each (group, block, chunk)."""
    if plan.count() <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    dealt = (_class_texts(texts, n).join(plan, "class").repartition("group", "block", "chunk")
             .sortWithinPartitions("group", "block", "chunk", "query", "class"))

    def solve(chunk: int, rows: list[tuple[int, bool, np.ndarray]]) -> list[tuple[int, int]]:
        # A class may come from several tasks; the first chunk asks every member, later ones the queries.
        members = {c: s for c, query, s in rows if not (query and chunk)}
        asked = {c: s for c, query, s in rows if query and chunk}
        if not members or (chunk and not asked):
            return []
        names = sorted(members, key=lambda c: (len(members[c]), c))
        links = link_block([members[c] for c in names], list(asked.values()) if chunk else None, num, den)
        names += asked
        return [(names[i], names[j]) for i, j in links if names[i] != names[j]]

    def links(batches):
        key, rows = None, []
        for batch in chunks(batches, "_text"):
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            got = zip(*(column[c].to_pylist() for c in ("group", "block", "chunk", "class", "query")), shingle_sets(column["_text"], n))
            edges = []
            for group, block, chunk, c, query, s in got:
                if (group, block, chunk) != key:
                    edges += solve(key[2], rows) if rows else []
                    key, rows = (group, block, chunk), []
                rows.append((c, query, s))
            yield _edges(edges)
        if rows:
            yield _edges(solve(key[2], rows))

    return dealt.mapInArrow(links, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, num: int = 85, den: int = 100,
                       block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a row's set is its
    distinct ``n``-word shingles, or its whole word sequence if shorter. Rows
    link when ``den * intersection >= num * union``; ``component_id`` is the
    smallest id reachable. A row without words (null, empty, blank) has size 0
    and is its own component. Repeated rows and ids are rows like others; a null
    id never is the smallest unless all of the component are null. An empty
    table gives an empty result. Other columns are not read.

    Sets are told apart by 64-bit hashes.
    """
    rows = stored(_doc_classes(docs, id_col, text_col, n), "classes")
    texts = docs.select(F.col(f"`{text_col}`").alias("_text"))
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(texts, n))
    signed = _signature_rows(texts, n, num, den, frequent)
    at = Window.partitionBy("sig")
    shared = signed.select("sig", "class", "wide", "level", "need", F.min("class").over(at).alias("least"), F.max("class").over(at).alias("most")).where("least <> most")
    # Only signatures of two classes or more are left: few rows of all that were signed.
    shared = stored(shared.select("sig", "class", "wide", "level", "need", "least"), "signatures")
    groups = connected_components(shared.where("wide AND class <> least").select("least", "class").distinct(), "least", "class")
    in_group = stored(groups.select(F.col("node").alias("class"), F.col("component").alias("group"))
                      .union(groups.select("component", "component").distinct()), "groups")
    thin = shared.where("NOT wide").select("sig", "class", "level", "need").distinct()
    thin = thin.join(in_group, "class", "left").select("sig", "class", "level", "need", F.coalesce("group", "class").alias("group"))
    thin = stored(thin, "thin")
    mixed = thin.groupBy("sig").agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a <> b").select("sig")
    thin = stored(thin.join(mixed, "sig"), "thin")
    x, y = thin.alias("x"), thin.alias("y")
    pairs = x.join(y, F.expr("x.sig = y.sig AND x.class < y.class AND x.group <> y.group"))
    pairs = pairs.groupBy(F.col("x.class").alias("a"), F.col("y.class").alias("b"), "x.level").agg(F.count("*").alias("n"), F.max(F.greatest("x.need", "y.need")).alias("need"))
    pairs = stored(pairs.where("n >= need").select("a", "b").distinct(), "pairs")
    pairs = pairs.select(F.explode(F.array("a", "b")).alias("class"), F.xxhash64("a", "b").alias("group"), F.lit(-1).cast("long").alias("block"))
    sizes = rows.where("class IS NOT NULL").groupBy("class").agg(F.max("n_shingles").alias("size"))
    mass = stored(in_group.join(sizes, "class").groupBy("group").agg(F.ceil(F.sum("size") / block_shingles).alias("blocks")), "mass")
    dealt = in_group.join(mass, "group").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    first = dealt.select("class", "group", "block", F.lit(0).alias("chunk"), F.lit(False).alias("query"))
    roots = dealt.where("class = group AND blocks > 1").select("class", "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("chunk"), F.lit(True).alias("query"))
    alone = pairs.select("class", "group", "block", F.lit(0).alias("chunk"), F.lit(False).alias("query"))
    links = stored(_block_links(texts, stored(first.union(roots).union(alone), "plan"), n, num, den), "links")
    parts = connected_components(links)
    if mass.where("blocks > 1").limit(1).count():
        label = dealt.where("blocks > 1").join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("part", F.coalesce("component", "class"))
        label = stored(label.select("class", "group", "blocks", "block", "part"), "labels")
        per = label.groupBy("group", "part").agg(F.count("*").alias("k"))
        # Members outside their group's largest part are asked against every block.
        most = stored(per.groupBy("group").agg(F.max_by("part", F.struct("k", "part")).alias("largest"), F.count("*").alias("n_parts")).where("n_parts > 1"), "largest")
        asked = label.join(most, "group").where("part <> largest").withColumn("chunk", F.pmod(F.xxhash64("class", F.lit(7)), F.greatest(F.lit(1), F.ceil(F.col("n_parts") / QUERIES_PER_CHUNK))).cast("int") + 1)
        asked = stored(asked.select("class", "group", "blocks", "chunk"), "asked")
        if asked.limit(1).count():
            chunk_of = asked.select("group", "chunk").distinct()
            members = label.join(chunk_of, "group").select("class", "group", "block", "chunk", F.lit(False).alias("query"))
            queries = asked.select("class", "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "chunk", F.lit(True).alias("query"))
            more = stored(_block_links(texts, members.union(queries), n, num, den), "links")
            parts = connected_components(links.union(more))
    named = rows.join(parts.withColumnRenamed("node", "class"), "class", "left")
    named = stored(named.select("_id", "n_shingles", F.coalesce("component", "class").alias("label")), "labelled")
    least = stored(named.where("label IS NOT NULL").groupBy("label").agg(F.min("_id").alias("least")), "least")
    out = named.join(least, "label", "left")
    return out.select(F.col("_id").alias(id_col), "n_shingles", F.coalesce("least", "_id").alias("component_id"))


def op1(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(tables(spark, sf_dir, "documents"))


QUERIES = {"op1_jaccard_join": op1}
ORACLES = {}
