"""Source divergence audit with late string materialisation.

How far each source's use of words lies from every other source's of its
language, and which words set it apart from the language as a whole.

1. Tasks count terms by 64-bit digest. Counts, joins, sums and rankings move
   digests and numbers of fixed width only.
2. Strings are looked at once, for digests that a language keeps: the smallest
   and the largest string of a digest differ if two terms share it. Such digests
   are split: their terms are counted again by string and get a number each.
3. The text is joined back to the terms that can be among the first ranks.

A pair of sources is not compared term by term over the whole vocabulary. Terms
that both have are compared where they lie; what one or none has enters as a
histogram of probabilities and as one product, so all of it stays exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.store import stored, tables
from tidemark.llm.words import as_int64, byte_mask, chunks, flat, mix, owner, word_bounds, word_hashes

SCALE = 1_000_000_000
#: Terms ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``: ASCII letters and every character beyond ASCII.
TERM = byte_mask(lambda b: b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
_CHUNK = 8 << 20
#: Digests that a task remembers having named, and split digests that are broadcast at once.
_NAMED, SPLIT_BLOCK = 1_000_000, 1_000_000
#: Longer terms are named in every chunk, so that equal hashes alone never hide one.
_SHORT = 64
#: Pairs of sources looked at together in one step of a task.
_PAIRS = 2_000_000


# Inside tasks.

def _terms(batch: pa.RecordBatch, bits: int):
    data, bounds = flat(batch.column(batch.schema.get_field_index("_text")), lower=True)
    starts, ends, first = word_bounds(data, bounds, TERM)
    digests = word_hashes(data, starts, ends)
    return data, starts, ends, owner(first), digests if bits == 64 else digests & np.uint64((1 << bits) - 1)


def _groups(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Language and group id of each row."""
    return tuple(batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("lid", "gid"))


def _counts(rows: DataFrame, bits: int) -> DataFrame:
    def count(batches):
        for batch in chunks(batches, "_text", _CHUNK):
            _, _, _, doc, digests = _terms(batch, bits)
            lid, gid = _groups(batch)
            names, first_row, code = np.unique(gid, return_index=True, return_inverse=True)
            group = code[doc]
            order = np.lexsort((doc, digests, group))
            g, h, d = group[order], digests[order], doc[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
            new_doc = new.copy()
            new_doc[1:] |= d[1:] != d[:-1]
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(g)))
            n_docs = np.add.reduceat(new_doc, begin, dtype=np.int64) if len(begin) else n
            yield pa.RecordBatch.from_arrays(
                [pa.array(lid[first_row][g[begin]]), pa.array(names[g[begin]]), pa.array(as_int64(h[begin])), pa.array(n), pa.array(n_docs)],
                names=["lid", "gid", "digest", "n", "docs"])

    return rows.select("lid", "gid", "_text").mapInArrow(count, "lid long, gid long, digest long, n long, docs long")


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, lengths)
    return pa.Array.from_buffers(pa.large_utf8(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[place]))]).cast(pa.string())


def _differing(data, starts, ends, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Where the words ``one[i]`` and ``other[i]`` differ."""
    lengths = ends[one] - starts[one]
    out = lengths != ends[other] - starts[other]
    same = np.flatnonzero(~out)
    lengths = lengths[same]
    if len(same):
        first = np.cumsum(lengths) - lengths
        step = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        unequal = data[step + np.repeat(starts[one[same]], lengths)] != data[step + np.repeat(starts[other[same]], lengths)]
        out[same] = np.logical_or.reduceat(unequal, first)
    return out


def _vocabulary(rows: DataFrame, bits: int) -> DataFrame:
    """``digest``, ``term``: every term of every digest, often once a task."""
    def name(batches):
        named: set[int] = set()
        for batch in chunks(batches, "_text", _CHUNK):
            data, starts, ends, _, digests = _terms(batch, bits)
            order = np.argsort(digests, kind="stable")
            h = digests[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            begin = np.flatnonzero(new)
            head = order[begin]
            odd = np.flatnonzero(_differing(data, starts, ends, order, np.repeat(head, np.diff(np.append(begin, len(h))))))
            pick = head.tolist()
            if len(odd):  # two terms of this chunk share a digest: name them all
                seen = {bytes(data[starts[i]:ends[i]]) for i in pick}
                for i in order[odd].tolist():
                    term = bytes(data[starts[i]:ends[i]])
                    if term not in seen:
                        seen.add(term)
                        pick.append(i)
            pick = np.array(pick, np.int64)
            short = ends[pick] - starts[pick] <= _SHORT
            # A second, unlike hash tells terms of one digest apart.
            second = mix(word_hashes(data, starts[pick], ends[pick]) ^ _by_ends(data, starts[pick], ends[pick]))
            known = np.fromiter((s and x in named for s, x in zip(short.tolist(), second.tolist())), bool, len(pick))
            if len(named) > _NAMED:
                named.clear()
            named.update(second[short & ~known].tolist())
            pick = pick[~known]
            yield pa.RecordBatch.from_arrays([pa.array(as_int64(digests[pick])), _strings(data, starts[pick], ends[pick])], names=["digest", "term"])

    return rows.select("_text").mapInArrow(name, "digest long, term string")


def _by_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes with a multiplier of its own, from sums over words of at most ``_SHORT`` bytes."""
    out = np.zeros(len(starts), np.uint64)
    lengths = np.minimum(ends - starts, _SHORT)
    for k in range(int(lengths.max(initial=0))):
        more = np.flatnonzero(lengths > k)
        out[more] = mix(out[more] + data[starts[more] + k].astype(np.uint64) + np.uint64(1))
    return out


def _split_counts(rows: DataFrame, split: np.ndarray, bits: int) -> DataFrame:
    """``lid, gid, digest, term, n, docs`` of the terms whose digest is in ``split`` (sorted)."""
    shared = rows.sparkSession.sparkContext.broadcast(split)

    def count(batches):
        for batch in chunks(batches, "_text", _CHUNK):
            data, starts, ends, doc, digests = _terms(batch, bits)
            lid, gid = _groups(batch)
            at = np.minimum(np.searchsorted(shared.value, digests), len(shared.value) - 1)
            n, last, docs = {}, {}, {}
            for i in np.flatnonzero(shared.value[at] == digests).tolist():
                d = int(doc[i])
                key = (int(lid[d]), int(gid[d]), int(as_int64(digests[i:i + 1])[0]), bytes(data[starts[i]:ends[i]]).decode())
                n[key] = n.get(key, 0) + 1
                if last.get(key) != d:
                    last[key], docs[key] = d, docs.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in n], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
                                             + [pa.array(list(n.values()), pa.int64()), pa.array([docs[k] for k in n], pa.int64())],
                                             names=["lid", "gid", "digest", "term", "n", "docs"])

    return rows.select("lid", "gid", "_text").mapInArrow(count, "lid long, gid long, digest long, term string, n long, docs long")


def _gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared_terms(held: DataFrame) -> DataFrame:
    """For each pair of groups, the sum over terms both have of how their value differs from the parts that go by one group each.

    ``held``: a row per term with ``members``, an array of (gid, p, p0).
    """
    def pairs(batches):
        for batch in batches:
            members = batch.column(0)
            size = np.diff(members.offsets.to_numpy())
            flat_ = members.flatten()
            gid, p, p0 = (flat_.field(i).to_numpy() for i in range(3))
            begin = np.cumsum(size) - size
            ends = np.cumsum(size * size)
            row = 0
            while row < len(size):
                stop = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + _PAIRS, side="right")))
                s, b = size[row:stop], begin[row:stop]
                within = np.arange(int((s * s).sum())) - np.repeat(np.cumsum(s * s) - s * s, s * s)
                side, base = np.repeat(s, s * s), np.repeat(b, s * s)
                x, y = base + within // side, base + within % side
                x, y = x[x != y], y[x != y]
                value = _gain(p[x], p[y]) - _gain(p[x], p0[y]) - _gain(p0[x], p[y]) + _gain(p0[x], p0[y])
                order = np.lexsort((gid[y], gid[x]))
                a, c = gid[x][order], gid[y][order]
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(c[at]), pa.array(np.add.reduceat(value[order], at) if len(at) else value)], names=["a", "b", "value"])
                row = stop

    return held.select("members").mapInArrow(pairs, "a long, b long, value long")


# The Spark job.

def _with_ids(named: DataFrame) -> tuple[DataFrame, int]:
    """The distinct (lang, source), with fixed-width ids that no two share, and the seed these come from."""
    groups = stored(named.select("lang", "source").distinct(), "groups")
    for seed in range(64):
        got = groups.select("*", *_ids(seed))
        n, n_gid, n_lang, n_lid = got.agg(F.count("*"), F.countDistinct("gid"), F.countDistinct("lang"), F.countDistinct("lid")).first()
        if n == n_gid and n_lang == n_lid:
            return got, seed
    raise RuntimeError("no seed gives every group an id of its own")


def _ids(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), "lang").alias("lid"), F.xxhash64(F.lit(seed), "lang", "source").alias("gid")]


def _kept_terms(rows: DataFrame, least_docs: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Terms that a language keeps (``lid, digest, slot, n, members``), and their strings (``digest, slot, term``)."""
    def by_language(counted: DataFrame, *key: str) -> DataFrame:
        per_group = counted.groupBy("lid", "gid", *key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        return (per_group.groupBy("lid", *key).agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("gid", "n")).alias("members"))
                .where(F.col("docs") >= least_docs).drop("docs"))

    terms = stored(by_language(_counts(rows, bits), "digest").withColumn("slot", F.lit(0)), "terms")
    found = _vocabulary(rows, bits).join(terms.select("digest").distinct(), "digest", "left_semi")
    names = stored(found.groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("most")), "names")
    clash = names.where("term <> most").select("digest")
    blocks = -(-clash.count() // SPLIT_BLOCK)
    single = names.where("term = most").select("digest", F.lit(0).alias("slot"), "term")
    if not blocks:
        return terms, single
    apart = None
    for k in range(blocks):  # at most about SPLIT_BLOCK digests at once; one block unless digests are few
        block = clash.where(F.pmod(F.xxhash64("digest"), F.lit(blocks)) == k).toArrow()["digest"].to_numpy()
        part = by_language(_split_counts(rows, np.sort(block.astype(np.int64).view(np.uint64)), bits), "digest", "term")
        part = stored(part, "split")
        apart = part if apart is None else apart.union(part)
    number = Window.partitionBy("digest").orderBy("term")
    numbered = stored(apart.select("digest", "term").distinct().withColumn("slot", F.row_number().over(number)), "numbered")
    terms = terms.join(clash, "digest", "left_anti").select("lid", "digest", "slot", "n", "members").union(
        apart.join(numbered, ["digest", "term"]).select("lid", "digest", "slot", "n", "members"))
    return stored(terms, "terms"), single.union(numbered.select("digest", "slot", "term"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      least_docs: int = 3, top: int = 200, digest_bits: int = 64) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language differs.

    Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased; a
    language keeps those in at least ``least_docs`` of its rows (V of them). A
    (lang, source) group, and a language, gives a kept term p = 1 +
    floor(10**9 * (count + 1) / (N + V)), N being its count of all kept terms.
    With f = floor((p - q)**2 / q), part ``pair`` has every other source of the
    language with f summed over all kept terms, q being the other's; part
    ``term`` has the group's own terms whose p is above the language's q, up to
    rank ``top``. Ranks are by value from the highest, then by item in UTF-8
    order. ``value`` is below 2**63 for fewer than 10**9 kept terms.

    Null text, lang and source read as ''. A group without terms has its pairs
    (value 0 where the language keeps none) and no terms. Repeated rows count as
    rows. An empty table gives none. No other column is read, so none can
    clash. Fewer ``digest_bits`` make collisions, for tests.
    """
    named = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"), F.col(f"`{text_col}`").alias("_text"))
    groups, seed = _with_ids(named)
    terms, names = _kept_terms(named.select(*_ids(seed), "_text"), least_docs, digest_bits)

    members = terms.select("lid", "digest", "slot", F.col("n").alias("n_lang"), F.explode("members").alias("m")).select("lid", "digest", "slot", "n_lang", "m.gid", "m.n")
    by_group = members.groupBy("gid").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    by_lang = terms.groupBy("lid").agg(F.count("*").alias("kept"), F.sum("n").alias("total_lang"))
    stats = groups.join(by_group, "gid", "left").join(by_lang, "lid", "left").na.fill(0, ["total", "own", "kept", "total_lang"])
    stats = stored(stats.withColumn("p0", F.expr(_probability("0L", "total"))), "stats")

    held = members.join(stats.select("gid", "total", "kept", "total_lang", "p0"), "gid").withColumn("p", F.expr(_probability("n", "total")))
    held = stored(held.withColumn("q", F.expr(_probability("n_lang", "total_lang"))).select("lid", "gid", "digest", "slot", "p", "p0", "q"), "held")
    ranked = _pairs(held, stats).select("gid", F.lit("pair").alias("part"), "item", "value").withColumn("rank", _rank("item"))
    ranked = ranked.union(_top_terms(held, names, top))
    out = ranked.join(groups.select("gid", "lang", "source"), "gid")
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def _probability(count: str, total: str) -> str:
    top = f"CAST({count} + 1 AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0))"
    return f"CASE WHEN kept > 0 THEN 1 + ({top}) DIV CAST({total} + kept AS DECIMAL(20, 0)) ELSE 0L END"


def _value(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) DIV {q}"


def _rank(item: str) -> Column:
    return F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), item))


def _pairs(held: DataFrame, stats: DataFrame) -> DataFrame:
    """``gid``, ``item``, ``value`` of every ordered pair of a language's groups."""
    x, y = stats.alias("x"), stats.alias("y")
    both = x.join(y, F.expr("x.lid = y.lid AND x.gid <> y.gid"))
    none = both.select(F.col("x.gid").alias("a"), F.col("y.gid").alias("b"),
                       F.expr(f"CASE WHEN x.kept = 0 THEN 0L ELSE (x.kept - x.own - y.own) * ({_value('x.p0', 'y.p0')}) END").alias("value"))
    spread = held.groupBy("lid", "gid", "p").agg(F.count("*").alias("k")).alias("h")
    one = spread.join(y, F.expr("h.lid = y.lid AND h.gid <> y.gid"))
    left = one.groupBy(F.col("h.gid").alias("a"), F.col("y.gid").alias("b")).agg(F.sum(F.expr(f"k * ({_value('h.p', 'y.p0')})")).alias("value"))
    right = one.groupBy(F.col("y.gid").alias("a"), F.col("h.gid").alias("b")).agg(F.sum(F.expr(f"k * ({_value('y.p0', 'h.p')})")).alias("value"))
    shared = held.groupBy("lid", "digest", "slot").agg(F.collect_list(F.struct("gid", "p", "p0")).alias("members")).where(F.size("members") > 1)
    parts = none.union(left).union(right).union(_shared_terms(shared))
    total = parts.groupBy("a", "b").agg(F.sum("value").alias("value"))
    return total.join(stats.select(F.col("gid").alias("b"), F.col("source").alias("item")), "b").select(F.col("a").alias("gid"), "item", "value")


def _top_terms(held: DataFrame, names: DataFrame, top: int) -> DataFrame:
    above = held.where("p > q").select("gid", "digest", "slot", F.expr(_value("p", "q")).alias("value"))
    # Ranks by value alone keep every tie, so that strings decide between few terms.
    near = above.withColumn("rank", F.rank().over(Window.partitionBy("gid").orderBy(F.desc("value")))).where(F.col("rank") <= top).drop("rank")
    texts = near.join(names, ["digest", "slot"]).select("gid", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    return texts.withColumn("rank", _rank("item")).where(F.col("rank") <= top)


def op12(spark, sf_dir: str) -> DataFrame:
    return source_divergence(tables(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + v) AS q
  FROM sums s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
rows AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pairs z ON z.lang = x.lang AND z.source = x.source AND z.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200
"""

QUERIES = {"op12_source_divergence": op12}
ORACLES = {"op12_source_divergence": ORACLE}
