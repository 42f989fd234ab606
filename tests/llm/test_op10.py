import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import op10_order as O
from tidemark.llm.tokens import ChunkEncoder, default_path


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_keyed_permutation(n):
    a = O.feistel(np.arange(n), n, 1)
    assert sorted(a.tolist()) == list(range(n))
    assert np.array_equal(a, np.concatenate([O.feistel(np.arange(i, min(i + 7, n)), n, 1) for i in range(0, n, 7)]))
    if n > 100:
        assert (a != O.feistel(np.arange(n), n, 2)).any() and abs(np.corrcoef(a, np.arange(n))[0, 1]) < .2


def test_shards_round_trip(spark, tmp_path):
    texts = ["hello big world " * k for k in range(40)] + [None, "", "x", "x", "<|endoftext|>", "w" * 3000]
    rows = [(i if i != 5 else None, t, 3) for i, t in enumerate(texts)] + [(1, texts[1], 3)]
    spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(4).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    options = dict(length=16, shard_rows=8)
    out = O.materialise(docs, f"file://{tmp_path}/out", 7, **options).collect()
    encoder = ChunkEncoder(default_path())
    want = []
    for d, t, _ in rows:
        raw = encoder.raw((t or "").encode()) + (1).to_bytes(4, "little")
        ids = np.frombuffer(raw, "<u4").tolist()
        want += [(d, p, ids[a:a + 16]) for p, a in enumerate(range(0, len(ids), 16))]
    assert sorted(r.slot for r in out) == list(range(len(want)))
    read = {r.slot: r.ids for r in O.read_slots(spark, f"{tmp_path}/out", 0, len(want), step=5, **options).collect()}
    assert sorted(((r.doc_id, r.piece, read[r.slot]) for r in out), key=str) == sorted(want, key=str)
    for r in out:
        assert (r.shard, r.place) == divmod(r.slot, 8) and r.n_tokens == len(read[r.slot])
        assert r.ids_crc32 == zlib.crc32(np.array(read[r.slot], "<u2").tobytes())
    files = sorted(f for f in os.listdir(f"{tmp_path}/out") if not f.startswith("."))
    assert files == [f"shard-{k:08d}.u16" for k in range(-(-len(want) // 8))]
    assert all(os.path.getsize(f"{tmp_path}/out/{f}") == 8 * 32 for f in files[:-1])
    some = O.read_slots(spark, f"{tmp_path}/out", 11, 30, step=4, **options).collect()  # resumed in the middle
    assert {r.slot: r.ids for r in some} == {s: read[s] for s in range(11, 30)}


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    assert O.materialise(spark.read.parquet(f"{tmp_path}/docs"), f"{tmp_path}/out", 7).count() == 0


def test_changed_splits_fail(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    count = O._count

    def count_and_change(*args):
        got = count(*args)
        for f in os.listdir(f"{tmp_path}/docs"):
            if f.endswith(".parquet"):
                spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string").coalesce(1).toPandas().to_parquet(f"{tmp_path}/docs/{f}")
        return got

    monkeypatch.setattr(O, "_count", count_and_change)
    with pytest.raises(Exception):
        O.materialise(docs, f"{tmp_path}/out", 7).collect()


def test_writes_once_whatever_is_done_with_the_manifest(spark, tmp_path):
    spark.createDataFrame([(i, "some words " * i) for i in range(50)], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    out = O.materialise(spark.read.parquet(f"{tmp_path}/docs"), f"{tmp_path}/out", 7, length=16, shard_rows=8)
    before = {f: os.stat(f"{tmp_path}/out/{f}").st_mtime_ns for f in os.listdir(f"{tmp_path}/out")}
    assert out.limit(3).count() == 3 and out.count() == out.select("slot").distinct().count()
    assert O.read_slots(spark, f"{tmp_path}/out", 0, out.count(), length=16, shard_rows=8).count() == out.count()
    assert before == {f: os.stat(f"{tmp_path}/out/{f}").st_mtime_ns for f in os.listdir(f"{tmp_path}/out")}


def test_counts_by_word_are_those_of_whole_texts(monkeypatch):
    monkeypatch.setattr(O, "MOST_WORDS", 40)
    encoder, counts = ChunkEncoder(default_path()), O.WordCounts(default_path())
    texts = [None, "", " \n", "don't stop, İstanbul! 漢字 x" * 20, "w" * 200_000, *[f"word{i} other-{i % 7} é" * (i % 5) for i in range(300)]]
    for a in range(0, len(texts), 20):
        got = counts.of(pa.array(texts[a:a + 20], pa.string()))
        assert got.tolist() == [len(encoder.raw((t or "").encode())) // 4 for t in texts[a:a + 20]]


def test_records_are_those_of_whole_texts(monkeypatch):
    encoder = ChunkEncoder(default_path())
    texts = [None, "", " \n", "don't stop, İstanbul! 漢字 x" * 20, "w" * 200_000, *[f"word{i} other-{i % 7} é" * (i % 5) for i in range(300)]]
    want = []
    for i, t in enumerate(texts):
        ids = [*np.frombuffer(encoder.raw((t or "").encode()), "<u4").tolist(), 1]
        want += [(i, p, np.array(ids[a:a + 16], "<u2").tobytes()) for p, a in enumerate(range(0, len(ids), 16))]
    plain = O.word_hashes
    # A table that begins anew in every batch, and hashes that several words share.
    for most, shift in ((2_000_000, 0), (40, 0), (2_000_000, 56)):
        monkeypatch.setattr(O, "MOST_WORDS", most)
        monkeypatch.setattr(O, "word_hashes", lambda *a, s=shift: plain(*a) >> np.uint64(s))
        words, got = O.WordCounts(default_path()), []
        for a in range(0, len(texts), 20):
            row, piece, ids = O.cut_records(*words.ids(pa.array(texts[a:a + 20], pa.string()), 1), 16)
            got += zip((row + a).tolist(), piece.tolist(), ids.to_pylist())
        assert got == want


def test_short_words_need_no_byte_by_byte_hash(monkeypatch):
    plain, hashed = O.word_hashes, []
    monkeypatch.setattr(O, "word_hashes", lambda data, starts, ends: hashed.extend((ends - starts).tolist()) or plain(data, starts, ends))
    texts = ["a ab ba aa 16-bytes-of-word 17-bytes-of-words " * 3, "é " + "x" * 40]
    counts, encoder = O.WordCounts(default_path()), ChunkEncoder(default_path())
    assert counts.of(pa.array(texts)).tolist() == [len(encoder.raw(t.encode())) // 4 for t in texts]
    assert hashed == [17, 17, 17, 40]


def test_word_keys_differ_where_words_do():
    words = sorted({bytes([*a]) for n in range(1, 4) for a in np.ndindex(*[9] * n)} | {b"a" * n for n in range(1, 60)} | {b"x" * 16 + bytes([i]) + b"y" * 16 for i in range(200)}
                   | {b"antiontiontion", b"entiontion"})
    ends = np.cumsum([len(w) for w in words])
    starts, data = ends - [len(w) for w in words], np.frombuffer(b"".join(words), np.uint8)
    assert len(set(O._keys(data, starts, ends, *O._ends(data, starts, ends)).tolist())) == len(words)


def test_words_that_share_a_key_are_told_apart(monkeypatch):
    encoder, plain = ChunkEncoder(default_path()), O._keys
    monkeypatch.setattr(O, "_keys", lambda *a: plain(*a) >> np.uint64(56))
    texts = [None, "", *[f"word{i} other-{i % 7} é {'long' * (i % 9)}" * (i % 5) for i in range(300)]]
    ids, bounds = O.WordCounts(default_path()).ids(pa.array(texts, pa.string()), 1)
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == [*np.frombuffer(encoder.raw((t or "").encode()), "<u4").tolist(), 1]


def test_chunks_encoded_together_are_those_encoded_one_by_one():
    chunks = ["a", "Word", "word,", "WORD!?", "don't", "x'", "'", "!", "--", "3", "a3", "3a", "İstanbul", "ÉTÉ.", "ſ", "ǅ", "Ⱥ;", "漢字", "ẞ", "K", "á", "a b", "a b", "\u0085", "a\u0085", "\x1c", "b\x1d.", "w" * 300 + ".", "<|endoftext|>", "\0", "_a", "a_", "×", "a÷b"]
    raw = [c.encode() for c in chunks]
    whole = ChunkEncoder(default_path())
    size, ids = ChunkEncoder(default_path()).many(raw)
    assert [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(size)[:-1])] == [whole._whole(c) for c in chunks] == [whole._chunk(c) for c in raw]
    assert [len(x) for x in whole.many([])] == [0, 0]
