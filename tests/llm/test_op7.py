import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import op7_decontaminate as D


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window):
    windows = []
    for i, t in items:
        w = words(t)
        if i is not None and w:
            n = min(window, len(w))
            windows += [(str(i), w[k:k + n]) for k in range(len(w) - n + 1)]
    out = []
    for d, t in docs:
        w = words(t)
        hit, seen = set(), set()
        for name, x in windows:
            for k in range(len(w) - len(x) + 1):
                if w[k:k + len(x)] == x:
                    hit |= set(range(k, k + len(x)))
                    seen.add(name)
        out.append((d, len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def fixture():
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ü1", "don"]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 3, 5, 9, 20])))) for i in range(25)]
    items += [(2, items[1][1]), (None, "w1"), (90, None), (91, ""), (92, "!!"), (10, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for i in range(60):
        w = r.choices(vocabulary + ["other", "more"], k=r.randrange(0, 80))
        for _ in range(r.randrange(3)):
            at = r.randrange(len(w) + 1)
            w[at:at] = (r.choice(items)[1] or "").split()
        docs.append((i, r.choice([" ", "-", "\n", " É "]).join(w).upper() if i % 5 == 0 else " ".join(w)))
    docs += [(70, None), (71, ""), (72, "..."), (None, items[0][1]), (0, docs[0][1]), (73, "w1 " * 20_000)]
    return docs, items


@pytest.mark.parametrize("block_chars", [10 ** 6, 300])
def test_hits_equal_brute_force(spark, block_chars):
    docs, items = fixture()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n_hit int, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(df, bench, window=6, block_chars=block_chars)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    rows = got.collect()
    assert sorted((tuple(r[c] for c in cols) for r in rows), key=str) == brute(docs, items, 6)
    text = {str(i): words(t) for i, t in items if t and i not in (2,)}
    for r in rows:
        if r.longest_match and r.doc_id not in (None, 0) and r.longest_match["item"] in text:
            w = words(dict(docs)[r.doc_id])[r.longest_match["start"]:][:r.longest_match["length"]]
            own = text[r.longest_match["item"]]
            assert any(own[k:k + len(w)] == w for k in range(len(own)))
    kept = D.remove_contaminated(df, bench, window=6).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "n_hit", "item_id"}
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == sorted((d, t) for (d, t), b in zip(docs, [brute([x], items, 6)[0] for x in docs]) if not b[-1] and d is not None) \
        if all(t is not None for _, t in docs) else len(kept) == sum(not brute([x], items, 6)[0][-1] for x in docs)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert [r.contaminated for r in D.find_contamination(docs, none).collect()] == [False, False]
    assert D.find_contamination(docs.limit(0), none).count() == 0


def test_suffix_array_is_sorted():
    r = np.random.default_rng(1)
    ids = r.integers(0, 4, 300)
    sa = D.suffix_array(ids, np.flatnonzero(ids), 16)
    keys = [tuple(ids[i:i + 16]) for i in sa]
    assert keys == sorted(keys) and sorted(sa) == np.flatnonzero(ids).tolist()


def test_columns_named_like_helpers(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", [7], "l", 5, "t", "dot"), (2, None, None, None, None, None, None, None)],
                                 "doc_id long, text string, _items string, _spans array<int>, _longest string, _n_words int, _text string, `a.b` string")
    items = spark.createDataFrame([("i", "b c")], "item_id string, text string")
    for block in (1 << 20, 1):
        first, second = D.find_contamination(docs, items, block_chars=block).orderBy("doc_id").collect()
        assert (first["_items"], first["_spans"], first["_longest"], first["_n_words"], first["_text"], first["a.b"]) == ("x", [7], "l", 5, "t", "dot")
        assert (first.n_words, first.n_hit, first.contaminated, second.n_words, second["_items"]) == (3, 2, True, 0, None)
        assert [r.doc_id for r in D.remove_contaminated(docs, items, block_chars=block).collect()] == [2]
    assert D.find_contamination(docs.select("text"), items).columns == ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans", "longest_match"]
