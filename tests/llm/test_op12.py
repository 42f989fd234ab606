import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import op12_divergence as D

_UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least=3, top=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(_UPPER))) for lang, source, text in rows]
    seen, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        sources[lang].add(source)
        seen[lang].update(set(words))
        counts[lang, source].update(words)
        counts[lang].update(words)
    out = []
    for lang, own in sources.items():
        kept = [t for t, n in seen[lang].items() if n >= least]

        def p(key):
            total = sum(counts[key][t] for t in kept)
            return {t: 1 + 10**9 * (counts[key][t] + 1) // (total + len(kept)) for t in kept}
        every = {s: p((lang, s)) for s in own}
        whole = p(lang)
        for s in own:
            pair = [(sum((every[s][t] - every[o][t]) ** 2 // every[o][t] for t in kept), o) for o in own if o != s]
            term = [((every[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if counts[lang, s][t] and every[s][t] > whole[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def corpus(seed=5):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "é", "漢字", "Q", "q")] + ["w" * 100, "w" * 99 + "v", "İ", "ſ", "\x7f", "don't", "a1b"]
    rows = []
    for _ in range(220):
        lang, source = r.choice(["en", "de", None, ""]), r.choice(["s1", "s2", "s3", "s4", None])
        n = r.choice([0, 1, 5, 40])
        rows.append((lang, source, r.choice([" ", "\n", "-1-"]).join(r.choices(words, weights=range(len(words), 0, -1), k=n))))
    rows += [("en", "s1", None), ("fr", "only", "one of a kind"), ("fr", "other", None), ("xx", None, None), ("en", "void", ""), rows[0], rows[0],
             ("de", "long", "long tail " * 20_000)]
    return rows


@pytest.mark.parametrize("bits", [64, 5])
def test_matches_brute_force_also_where_digests_collide(spark, bits):
    rows = corpus()
    df = spark.createDataFrame([(*x, 1, 2, "y") for x in rows], "lang string, source string, text string, gid int, rank int, term string").repartition(4)
    got = D.source_divergence(df, digest_bits=bits)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(x) for x in got.collect()) == brute(rows)


def test_split_digests_in_blocks_and_few_ranks(spark, monkeypatch):
    monkeypatch.setattr(D, "SPLIT_BLOCK", 3)
    rows = corpus(8)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(tuple(x) for x in D.source_divergence(df, digest_bits=4, top=3).collect()) == brute(rows, top=3)


def test_empty_and_blank_tables(spark):
    kind = "lang string, source string, text string"
    assert D.source_divergence(spark.createDataFrame([], kind)).count() == 0
    rows = [("a", "x", None), ("a", "y", ""), ("b", "x", "12 34")]
    assert sorted(tuple(x) for x in D.source_divergence(spark.createDataFrame(rows, kind)).collect()) == brute(rows)


def test_differing_words():
    text = b"ab ab ac a abc ab"
    starts, ends = np.array([0, 3, 6, 9, 11, 15]), np.array([2, 5, 8, 10, 14, 17])
    got = D._differing(np.frombuffer(text, np.uint8), starts, ends, np.arange(6), np.zeros(6, np.int64))
    assert got.tolist() == [False, False, True, True, True, False]
    assert D._strings(np.frombuffer(text, np.uint8), starts, ends) == pa.array(["ab", "ab", "ac", "a", "abc", "ab"])
