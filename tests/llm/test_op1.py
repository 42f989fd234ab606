import random
import re

import numpy as np
import pytest

from tidemark.llm import op1_jaccard as J
from tidemark.llm.components import connected_components


def brute(rows, n=4, num=85, den=100):
    sets = []
    for _, text in rows:
        w = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, groups=12):
    r, out = random.Random(seed), []
    words = [f"w{i}" for i in range(400)]
    passage = r.choices(words, k=25)
    for _ in range(groups):
        base = r.choices(words, k=r.choice([5, 12, 30, 60, 150]))
        if r.random() < .5:
            base += passage
        for _ in range(r.choice([1, 2, 5, 15])):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                own[r.randrange(len(own))] = r.choice(words)
            out.append(" ".join(own))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("block,frequent", [(400_000, 100), (150, 4)])
def test_components_equal_brute_force(spark, monkeypatch, block, frequent):
    monkeypatch.setattr(J, "FREQUENT", frequent)
    texts = corpus(block) + [None, "", " \t\n", "one", "ONE", "one two", "One\x0btwo", "É a b c d", "é a b c d", "x " * 5000, "X " * 4000]
    rows = list(enumerate(texts)) + [(3, "one"), (None, "one two"), (None, "alone in null")]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, class long, `_text` string").repartition(4)
    got = J.jaccard_components(df, block_shingles=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = J.jaccard_components(df)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_merge_skip_counts():
    r = random.Random(1)
    for _ in range(200):
        lists = [sorted(r.sample(range(30), r.randrange(0, 15))) for _ in range(r.randrange(1, 9))]
        need = r.randrange(1, 7)
        count = {}
        for x in lists:
            for d in x:
                count[d] = count.get(d, 0) + 1
        assert J.merge_skip(lists, need) == {d: c for d, c in count.items() if c >= need}


def test_signatures_meet_for_every_similar_pair():
    r = np.random.default_rng(3)
    levels = J.Levels(85, 100)
    for size in [1, 2, 6, 7, 8, 12, 13, 20, 27, 60, 200, 900]:
        for _ in range(60):
            a = np.unique(r.integers(0, 2 ** 63, size, dtype=np.uint64) * np.uint64(2))
            drop = r.integers(0, max(1, size * 15 // 100) + 1)
            b = a[r.permutation(len(a))[:max(1, len(a) - drop)]]
            b = np.unique(np.concatenate([b, r.integers(0, 2 ** 63, r.integers(0, 4), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                for often in (0, 0.1, 0.6, 1):
                    every = np.union1d(a, b)
                    frequent = every[r.random(len(every)) < often]
                    sig, who = J.signatures([a, b], levels, frequent)[:2]
                    assert set(sig[who == 0].tolist()) & set(sig[who == 1].tolist())


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(900, 901), (901, 900), (5, 5)], "a long, b long"))
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {901: 900}


@pytest.mark.parametrize("heap", [0, 400, 10 ** 9])
def test_index_finds_all_links_with_any_merge(monkeypatch, heap):
    monkeypatch.setattr(J, "HEAP_ENTRIES", heap)
    r = np.random.default_rng(heap % 97)
    base = [r.integers(0, 2 ** 62, 60, dtype=np.uint64) for _ in range(3)]
    sets = []
    for _ in range(80):
        own = base[r.integers(3)].copy()
        own[r.integers(0, 60, r.integers(0, 9))] = r.integers(0, 2 ** 62, dtype=np.uint64)
        sets.append(np.unique(own))
    index = J.InvertedIndex(sets)
    for s in sets:
        both = np.array([len(np.intersect1d(s, x)) for x in sets])
        want = np.flatnonzero(100 * both >= 85 * (len(s) + index.sizes - both))
        assert sorted(index.linked(s, 85, 100).tolist()) == want.tolist()


def test_linked_sets_share_as_many_signatures_as_they_must():
    r = np.random.default_rng(4)
    levels, none = J.Levels(80, 100), np.zeros(0, np.uint64)
    for size in (3, 9, 20, 60, 200):
        for _ in range(40):
            a = r.integers(0, 1 << 63, size, dtype=np.uint64)
            b = a.copy()
            b[r.permutation(size)[:r.integers(0, size // 8 + 1)]] = r.integers(0, 1 << 63)
            sets = [np.unique(a), np.unique(np.r_[b, r.integers(0, 1 << 63, r.integers(0, size // 10 + 1), dtype=np.uint64)])]
            both = len(np.intersect1d(*sets))
            if 100 * both < 80 * (len(sets[0]) + len(sets[1]) - both):
                continue
            sig, who, _, level, need = J.signatures(sets, levels, none)
            found = [set(zip(level[who == i].tolist(), sig[who == i].tolist())) for i in (0, 1)]
            shared = [x for x, _ in found[0] & found[1]]
            must = {x: max(need[(who == i) & (level == x)].max(initial=-99) for i in (0, 1)) for x in set(shared)}
            assert any(shared.count(x) >= must[x] for x in must)
