import random
import re

import numpy as np
import pytest

from tidemark.llm import op9_rules as R


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def texts():
    r, out = random.Random(3), [None, "", " \t\n\x0b", "a", "a b", "a a a", "a a a a a", "x\n\n x\nx\n x", "a b c a b c a", "É😀 é b\u0085c #<>\x0b|d"]
    for _ in range(60):
        words = [r.choice(["a", "b", "c", "dé", "#$", "e|"]) for _ in range(r.randrange(0, 40))]
        out.append("".join(w + r.choice([" ", "\n", "\t", "  ", "\r\n"]) for w in words))
    return out


def test_counts_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "en", None, 7) for i, t in rows] + [(3, "a", None, "s", 1)], "doc_id long, text string, lang string, source string, n_words int")
    got = R.judge(df).collect()
    want = [(i, *brute(t)) for i, t in rows] + [(3, 1, 1, 0, 0, 0)]
    assert sorted(tuple(r)[:6] for r in got) == sorted(want)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed) and r.kept is not None


def test_empty_table_and_null_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert R.judge(df).count() == 0
    one = spark.createDataFrame([(None, None, None, None)] * 2, df.schema)
    assert [tuple(r)[:6] for r in R.judge(one).collect()] == [(None, 0, 0, 0, 0, 0)] * 2


def test_long_text_of_one_repeated_word(spark):
    df = spark.createDataFrame([(1, "word " * 200_000, "en", "s")], "doc_id long, text string, lang string, source string")
    assert R.judge(df).first().n_repeat_words == 200_000


def numpy_distance(x, steps):
    floor = np.array([R.FLOORS[c] for c in R.X])
    q = np.quantile(x, [.25, .5, .75], axis=0, method="inverted_cdf")
    mean, factor = q[1], np.diag(np.maximum((q[2] - q[0]) / 1.349, floor))
    for _ in range(steps):
        d = (np.linalg.solve(factor, (x - mean).T) ** 2).sum(0)
        near = x[d <= np.quantile(d, R.COVERAGE, method="inverted_cdf")]
        mean, factor = near.mean(0), np.linalg.cholesky(np.cov(near.T, bias=True) + np.diag(floor ** 2))
    d = (np.linalg.solve(factor, (x - mean).T) ** 2).sum(0)
    return d / max(1, np.quantile(d, .5, method="inverted_cdf") / R.CHI_MEDIAN)


def test_distances_equal_numpy_and_outliers_go(spark):
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(800)]
    rows = []
    for i in range(400):
        words = r.choices(vocabulary, k=r.randrange(80, 300))
        rows.append((i, " ".join(w + "%%%" if i % 20 == 0 else w for w in words), "en", "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = R.judge(df).orderBy("doc_id").toPandas()
    x = R.with_vector(R.with_counts(df, "text")).orderBy("doc_id").toPandas()[R.X].to_numpy()
    assert np.allclose(got.distance, numpy_distance(x, R.STEPS), rtol=1e-6)
    assert (got.kept == (got.doc_id % 20 != 0)).all()


def test_groups_have_estimates_of_their_own(spark):
    r = random.Random(2)
    rows = []
    for i in range(600):
        lang = "aa" if i % 2 else "bb"
        words = ["".join(r.choice("xyz") for _ in range(3 if lang == "aa" else 12)) + str(r.randrange(10 ** 6)) for _ in range(100)]
        rows.append((i, " ".join(words), lang, "s"))
    rows.append((1000, " ".join("q" * 12 + str(k) for k in range(100)), "aa", "s"))
    got = {x.doc_id: x.kept for x in R.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got.pop(1000) and all(got.values())


@pytest.mark.parametrize("share", [0.30, 0.45])
def test_a_group_with_much_junk_still_loses_it(spark, share):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(800)]
    rows, bad = [], int(400 * share)
    for i in range(400):
        words = r.choices(vocabulary, k=r.randrange(80, 300))
        rows.append((i, " ".join(w + r.choice(["", "", "%%", "#$%"]) for w in words) if i < bad else " ".join(words), "en", "s"))
    got = R.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(x.kept == (x.doc_id >= bad) for x in got)


def test_small_groups_are_judged_by_their_language_first(spark):
    """Short sources of a language with long words: by all languages together these would look like the others' outliers."""
    r = random.Random(6)
    rows = []
    for i in range(440):  # "aa" is small in every source, "bb" large in one, "cc" small as a whole
        lang, source = ("aa", f"s{i % 4}") if i < 200 else ("bb", "s") if i < 400 else ("bb", "t") if i < 420 else ("cc", "s")
        size = 3 if lang == "aa" else 12
        rows.append((i, " ".join("".join(r.choice("xyz") for _ in range(size)) + str(r.randrange(10 ** 6)) for _ in range(100)), lang, source))
    rows.append((1000, " ".join("q" * 12 + str(k) for k in range(100)), "aa", "s1"))
    rows.append((1001, " ".join("xyz%%%" + str(k) for k in range(100)), "bb", "t"))
    got = {x.doc_id: x.kept for x in R.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(got) == len(rows) and not got.pop(1000) and not got.pop(1001)
    assert all(kept for i, kept in got.items() if i < 420)
