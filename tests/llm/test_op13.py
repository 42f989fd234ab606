import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op13_fim as M


def brute(doc, text, unit="token"):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text) if unit == "token" else list(text)
    n = len(u)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 20:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def corpus():
    r = random.Random(3)
    letters = ["a", "Z", "word", " ", "\n", "\r\n", "é", "ß", "漢", " ", "😀", "é", "<", "<P", "S>", "M>", "\x00", "1", "İ", "ſ"]
    texts = ["".join(r.choices(letters, k=r.randrange(0, 60))) for _ in range(300)]
    return texts + [None, "", "x", "é", "😀", "has <P> in it", "<M>", "z" * 50_000, "é漢 a" * 20_000, texts[0], texts[0]]


@pytest.mark.parametrize("unit", ["token", "char"])
def test_matches_brute_force_and_restores(spark, unit):
    rows = [(i, t) for i, t in enumerate(corpus())] + [(None, "null id é"), (0, "again"), (None, None)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, form string, _row int").repartition(3)
    out = M.fill_in_middle(df, unit=unit, keep=("_row",)).withColumn("back", M.restored())
    got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back", "_row").collect()
    want = [brute(d, t, unit) + (t or "",) for d, t in rows]
    assert sorted((tuple(x)[:7] for x in got), key=str) == sorted(want, key=str)
    assert {x.form for x in got} == {"plain", "psm", "spm"} and all(x._row == 1 for x in got)


def test_exception_index():
    text = "aé漢b😀cé"
    index = M.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    places = np.array([len(text[:i].encode()) for i in chars])
    assert index.to_bytes(chars).tolist() == places.tolist() and index.to_chars(places).tolist() == chars.tolist()
    assert len(index.at) == 4
    assert len(M.ExceptionIndex(np.frombuffer(b"only ascii", np.uint8)).at) == 0


def test_empty_table_and_bad_unit(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n int")
    assert M.fill_in_middle(empty).count() == 0
    with pytest.raises(ValueError):
        M.fill_in_middle(empty, unit="word")


def test_other_markers(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("one <P> two é three").alias("text"))
    marks = ("[pre]", "[suf]", "[mid]")
    out = M.fill_in_middle(df, markers=marks, plain_percent=0).withColumn("back", M.restored(markers=marks))
    assert out.where("form = 'plain' OR back <> 'one <P> two é three'").count() == 0
