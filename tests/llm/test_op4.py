import hashlib
import random

import pytest

from tidemark.llm import op4_substring as S


def brute(rows, length):
    docs = [(d, (t or "").replace("\x85", "\x85").encode().split()) for d, t in rows]
    least = {}
    for d, w in docs:
        if d is not None:
            for i in range(len(w) - length + 1):
                s = tuple(w[i:i + length])
                least[s] = min(d, least.get(s, d))
    out = []
    for d, w in docs:
        gone = set()
        if d is not None:
            for i in range(len(w) - length + 1):
                if least[tuple(w[i:i + length])] < d:
                    gone |= set(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, length):
    r, out = random.Random(seed), []
    words = [f"w{i}" for i in range(60)]
    passages = [r.choices(words, k=r.choice([length - 1, length, length + 7, 3 * length])) for _ in range(5)]
    for _ in range(60):
        w = r.choices(words, k=r.randrange(0, 4 * length))
        for _ in range(r.choice([0, 1, 2])):
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice(passages)
        out.append(w)
    for base in r.sample(out, 12):
        for _ in range(r.choice([1, 4])):
            w = list(base)
            for _ in range(r.choice([0, 1, 3])):
                if w:
                    w[r.randrange(len(w))] = r.choice(words)
            out.append(w)
    r.shuffle(out)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("hot,often", [(1000, 1000), (2, 1000), (2, 1), (2, 4)])
def test_removes_what_brute_force_removes(spark, monkeypatch, hot, often):
    monkeypatch.setattr(S, "OFTEN", often)
    texts = corpus(hot, 12) + [None, "", " \n", "a b", "z " * 500, "z " * 300, "é\x85ü " * 40]
    rows = list(enumerate(texts)) + [(1, texts[0]), (None, texts[0]), (None, None), (0, texts[0]), (5, texts[6])]
    df = spark.createDataFrame([(d, t, 3, 4) for d, t in rows], "doc_id long, text string, place int, _key int").repartition(5)
    got = S.remove_shared_spans(df, length=12, gram=5, hot=hot, keep=("place",)).collect()
    assert sorted((tuple(x[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for x in got), key=str) == brute(rows, 12)
    for x in got:
        joined = b" ".join((x.kept_text or "").encode().split())
        assert hashlib.sha256(joined).hexdigest() == x.kept_sha256 and x.place == 3
    assert any(x.n_removed and x.n_removed < x.n_words for x in got)


def test_empty(spark):
    out = S.remove_shared_spans(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"] and out.count() == 0


def test_automaton_gives_matching_statistics():
    r = random.Random(7)
    for _ in range(200):
        texts = [[r.randrange(3) for _ in range(r.randrange(1, 25))] for _ in range(r.randrange(1, 4))]
        automaton = S.SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        asked = [r.randrange(3) for _ in range(40)]
        want = [max((n for n in range(e + 1) if tuple(asked[e - n:e]) in known or not n), default=0) for e in range(1, 41)]
        assert automaton.lengths(asked) == want
