import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import op11_suffix as S


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, raw):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, length):
    r, out = random.Random(seed), []
    def text(n, letters="abcdefgh é漢"):
        return "".join(r.choices(letters, k=n))
    passages = [text(n) for n in (length - 1, length, length + 1, length + 40, 3 * length)]
    for _ in range(50):
        t = text(r.randrange(0, 4 * length))
        for _ in range(r.choice([0, 1, 2])):
            at = r.randrange(len(t) + 1)
            t = t[:at] + r.choice(passages) + t[at:]
        out.append(t)
    for base in r.sample(out, 10):
        for _ in range(r.choice([1, 3])):
            t = list(base)
            for _ in range(r.choice([0, 1, 3])):
                if t:
                    t[r.randrange(len(t))] = "X"
            out.append("".join(t))
    out += [passages[3] + text(30) for _ in range(25)] + [text(20) + passages[4] + text(r.randrange(60)) for _ in range(25)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("hot", [1000, 3])
def test_removes_what_brute_force_removes(spark, hot):
    length = 90
    texts = corpus(hot, length) + [None, "", "short", "z" * 700, "z" * length, "z " * 300, "ab" * 45, "é" * 200, "line of text\n" * 40]
    rows = list(enumerate(texts)) + [(1, texts[0]), (None, texts[3]), (None, None), (2, texts[2]), (2, texts[2])]
    df = spark.createDataFrame([(d, t, 3, 4) for d, t in rows], "doc_id long, text string, place int, s int").repartition(5)
    got = S.remove_repeated_bytes(df, length=length, gram=24, hot=hot, keep=("place",)).collect()
    assert sorted((tuple(x[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for x in got), key=str) == brute(rows, length)
    for x in got:
        assert hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 and x.place == 3
        assert sum(s.end - s.start for s in x.spans) == x.n_removed and len(x.spans) == x.n_spans
    assert any(0 < x.n_removed < x.n_bytes for x in got)


def test_empty_table_and_parameters(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeated_bytes(empty).count() == 0
    with pytest.raises(ValueError):
        S.remove_repeated_bytes(empty, gram=500)


def test_a_block_without_contexts():
    assert S.duplicate_starts(np.zeros(0, np.uint8), np.zeros(0, np.int64), 100).tolist() == []
    assert [x.tolist() for x in S.duplicate_spans([b"a" * 100], 100)] == [[]] and len(S.duplicate_spans([], 100)) <= 1


@pytest.mark.parametrize("frequent", [1, 5])
def test_frequent_contexts_are_looked_up_apart(spark, monkeypatch, frequent):
    monkeypatch.setattr(S, "FREQUENT", frequent)
    rows = list(enumerate(corpus(9, 90)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = S.remove_repeated_bytes(df, length=90, gram=24, hot=2, with_kept=False).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(rows, 90)


def test_difference_cover():
    cover = S.DifferenceCover(S.COVER, S.PERIOD)
    assert cover.delta.min() >= 0 and cover.delta.max() < S.PERIOD
    places = cover.places(1000)
    assert (cover.index(places) == np.arange(len(places))).all()
    with pytest.raises(ValueError):
        S.DifferenceCover((0, 1), 8)


@pytest.mark.parametrize("letters,size", [(1, 10), (2, 20), (2, 4000), (20, 64)])
def test_suffix_order_and_duplicates(letters, size):
    r = np.random.default_rng(letters * size)
    length = 100
    for _ in range(12):
        piece = r.integers(1, 1 + letters, 150).astype(np.uint8)
        parts = [r.integers(1, 1 + letters, r.integers(0, 300)).astype(np.uint8) if r.random() < 0.5 else piece[r.integers(0, 40):] for _ in range(12)]
        text = np.concatenate(parts)
        if len(text) < length + 2:
            continue
        places = np.arange(len(text) - length + 1)
        block, raw = S.SuffixBlock(text, length), text.tobytes()
        order, _ = block.sorted(places)
        windows = [raw[p:p + length] for p in order.tolist()]
        assert windows == sorted(windows) and sorted(order.tolist()) == places.tolist()
        seen = Counter(raw[p:p + length] for p in places.tolist())
        want = [p for p in places.tolist() if seen[raw[p:p + length]] > 1]
        assert S.duplicate_starts(text, places, length, size).tolist() == want


def test_sliding_least():
    r = np.random.default_rng(1)
    x = r.integers(0, 50, 103).astype(np.uint64)
    for width in (1, 7, 103):
        assert S.sliding_least(x, width).tolist() == [x[i:i + width].min() for i in range(len(x) - width + 1)]
