import random
import zlib

import numpy as np

from tidemark.llm import op3_quality as Q


def made(n, seed=1):
    r = random.Random(seed)
    good, bad = [f"good{i}" for i in range(80)], ["buy", "now", "!!", "click", "$$$"]
    rows = []
    for i in range(n):
        y = int(r.random() < .7)
        words = [r.choice(good if r.random() < (.9 if y else .3) else bad) for _ in range(r.randrange(20, 80))]
        rows.append((i, " ".join(words), y))
    return rows


def test_held_out_rows_are_scored_well_and_calibrated(spark):
    rows = made(900)
    docs = spark.createDataFrame([(i, t, 9.0, "x") for i, t, _ in rows] + [(None, None, 0.0, None), (901, "", 0.0, None), (901, "good1 " * 3000, 0.0, None)],
                                 "doc_id long, text string, score double, _id string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, None), (5, 7), (None, 1), (7777, 1)], "doc_id long, quality int")
    out = Q.score_quality(docs.repartition(3), labels).toPandas()
    assert list(out.columns) == ["doc_id", "text", "_id", "score", "held_out", "predicted"] and len(out) == 903
    assert out.score.between(0, 1).all() and ((out.score >= .7) == (out.predicted == 1)).all()
    for r in out.dropna(subset=["doc_id"]).itertuples():
        assert r.held_out == (zlib.crc32(str(int(r.doc_id)).encode()) % 4 == 2)
    held = out[out.held_out & (out.doc_id < 900)]
    truth = held.doc_id.map({i: y for i, _, y in rows})
    assert ((held.score > .5) == (truth == 1)).mean() > .95
    again = Q.score_quality(docs.repartition(7), labels).toPandas()
    a, b = (x.sort_values(["doc_id", "text"]).score.to_numpy() for x in (out, again))
    assert np.allclose(a, b)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.score_quality(docs, none).collect()} == {0.5}
    assert Q.score_quality(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r.score for r in Q.score_quality(docs, one).collect()} == {1.0}


def test_held_out_labels_do_not_matter(spark):
    rows = made(300, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    out = [(zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows]
    a = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    b = spark.createDataFrame([(i, 1 - y if h else y) for (i, _, y), h in zip(rows, out)], "doc_id long, quality int")
    assert [r.score for r in Q.score_quality(docs, a).orderBy("doc_id").collect()] == [r.score for r in Q.score_quality(docs, b).orderBy("doc_id").collect()]


def test_context_sums_equal_a_plain_count():
    import pyarrow as pa
    bucket, first = Q.word_buckets(pa.array(["ab cd!! 12", None, "ab"]))
    assert np.diff(first).tolist() == [4, 0, 1]
    table, counts = np.zeros(Q.BUCKETS * Q.WIDTH, np.int64), np.zeros(Q.BUCKETS, np.int64)
    Q.add_contexts(table, counts, bucket, first)
    places, signs = Q.index_vectors()
    want = np.zeros((Q.BUCKETS, Q.WIDTH), np.int64)
    for i in range(4):
        for j in range(4):
            if 0 < abs(i - j) <= 2:
                for p, s in zip(places[bucket[j]], signs[bucket[j]]):
                    want[bucket[i], p] += s
    assert (table.reshape(want.shape) == want).all() and counts.sum() == 5
