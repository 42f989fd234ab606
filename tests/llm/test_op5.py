import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import op5_packing as P
from tidemark.llm.tokens import ChunkEncoder, default_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_path())


def whole(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


_encoder = ChunkEncoder(default_path())


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\x0b\x1c\x85\xa0́e'sİΣßŒǅ<|endoftext|>,.!\""))))
def test_chunked_ids_equal_whole_text_ids(text):
    from tokenizers import Tokenizer
    if not hasattr(test_chunked_ids_equal_whole_text_ids, "t"):
        test_chunked_ids_equal_whole_text_ids.t = Tokenizer.from_file(default_path())
    assert _encoder.raw(text.encode()) == whole(test_chunked_ids_equal_whole_text_ids.t, text)


TEXTS = ["Hello big world", None, "", "  \n", "a <|endoftext|> b<|startoftext|>", "word " * 9000, "x" * 5000, "Hello big world", "don't 123 ÉÉ"]


def test_pieces_round_trip(spark, tokenizer):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "n", 2)], "doc_id long, text string, length int")
    rows = P.token_pieces(df, with_ids=True).collect()
    for i, t in [*enumerate(TEXTS), (None, "n")]:
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        raw = b"".join(bytes(r.ids) for r in own)
        assert raw == whole(tokenizer, t) + b"\x01\0\0\0"
        assert [r.piece for r in own] == list(range(len(own))) and all(r.length == 4096 for r in own[:-1])
        assert all(r.start == 4096 * r.piece and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in own)


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("block_items", [4096, 60])
def test_packs_all_items_tightly(spark, block_items):
    r = random.Random(2)
    lengths = [min(100, max(1, int(r.lognormvariate(3.2, 1)))) for _ in range(900)] + [100] * 40
    df = spark.createDataFrame([(i % 300, n, "x") for i, n in enumerate(lengths)], "doc_id long, length int, x string")
    rows = P.pack(df, 100, block_items).collect()
    assert sorted((x.doc_id, x.length) for x in rows) == sorted((i % 300, n) for i, n in enumerate(lengths))
    bound = -(-sum(lengths) // 100)
    assert check_packing(rows, 100) <= bound * (1.01 if block_items > 1000 else 1.06)


def test_documents_and_edge_cases(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, offset int")
    rows = P.pack_documents(df).collect()
    check_packing(rows, 4096)
    assert P.pack_documents(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(1, 0)], "doc_id long, length int")).count()
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(1, None)], "doc_id long, length int")).count()


def test_crossover_keeps_items_and_capacity():
    rng = np.random.default_rng(0)
    for _ in range(40):
        lengths = rng.integers(1, 60, 200)
        a, b = (P.best_fit(lengths, np.full(200, -1), rng.permutation(200).tolist(), 100) for _ in range(2))
        child = P.crossover(lengths, a, b, 100, rng)
        assert child.min() >= 0 and np.bincount(child, weights=lengths).max() <= 100
        assert sorted(set(child)) == list(range(child.max() + 1))
