"""Fill-in-middle transformation over a sparse index of multibyte characters.

A text's UTF-8 bytes are cut where they lie in the Arrow buffer. Byte places and
code-point places differ only by the excess bytes of the multibyte characters
before them, so just these characters are recorded: where each begins, in bytes
and in code points, and how many excess bytes there are up to it. A cut is
converted by one binary search among them and an addition; a span of ASCII, a
whole text of it too, costs nothing but the addition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.store import tables
from tidemark.llm.words import byte_mask, chunks, flat, out_schema

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents, so many stay as they are; of a hundred others, so many put the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
_LETTER = byte_mask(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


class ExceptionIndex:
    """Multibyte characters of ``data`` (UTF-8 bytes, from a character's first byte on).

    ``at`` are their byte places, ``char_at`` their code-point places, and
    ``excess[i]`` the excess bytes of the first i of them.
    """

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)])
        self.char_at = self.at - self.excess[:-1]

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before each byte place (a character's first byte, or the end)."""
        return places - self.excess[np.searchsorted(self.at, places)]

    def to_bytes(self, places: np.ndarray) -> np.ndarray:
        """Bytes before each code-point place."""
        return places + self.excess[np.searchsorted(self.char_at, places)]


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte place of every token ``[A-Za-z]+|[^A-Za-z]``, and for each text the index of its first (one more than texts)."""
    letter = _LETTER[data]
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[bounds[:-1][bounds[:-1] < bounds[1:]]] = True  # whatever the text before ends in
    starts = np.flatnonzero(starts)
    return starts, np.searchsorted(starts, bounds)


def _cuts(data: np.ndarray, bounds: np.ndarray, unit: str, h1: np.ndarray, h2: np.ndarray):
    """Units of each text, and its two cuts as byte and as code-point places from the chunk's start."""
    index = ExceptionIndex(data)
    if unit == "token":
        starts, first = unit_starts(data, bounds)
        n = np.diff(first)
        starts = np.append(starts, len(data))

        def place(k):  # a cut behind the last unit is the text's end
            return np.where(k == n, bounds[1:], starts[np.minimum(first[:-1] + k, len(starts) - 1)])
    else:
        chars = index.to_chars(bounds)
        n = np.diff(chars)

        def place(k):
            return index.to_bytes(chars[:-1] + k)
    a, b = h1 % (n + 1), h2 % (n + 1)
    low, high = place(np.minimum(a, b)), place(np.maximum(a, b))
    return n, low, high, index.to_chars(bounds), index.to_chars(low), index.to_chars(high)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "token", seed: int = 1,
                   markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), plain_percent: int = PLAIN_PERCENT,
                   spm_percent: int = SPM_PERCENT, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns in ``keep``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` of every row.

    ``unit``: "token" (``[A-Za-z]+|[^A-Za-z]``) or "char" (code points). The
    first four 8-digit groups of the hex sha256 of ``seed:id`` decide: two cuts
    modulo ``n`` + 1, plain or not, suffix first or not. A text that is empty or
    holds a marker stays plain. ``output`` is the text (plain), prefix, suffix,
    middle (psm) or suffix, prefix, middle (spm), each after its marker.

    A null text is empty: plain, with an empty output. A null id hashes like an
    empty one. Repeated rows and ids are rows like others, one out for each in;
    an empty table gives none. Texts of any length are cut whole. Columns of
    ``docs`` other than those named are not read, so none can clash.
    """
    if unit not in ("token", "char"):
        raise ValueError("unit must be token or char")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"_h{i + 1}") for i in range(4)]
    row = F.struct(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in keep if c != id_col]).alias("_row")
    picked = docs.select(row, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"), *groups)
    p, s, m = (x.encode() for x in markers)

    def rows(batches):
        for batch in chunks(batches, "_text"):
            h1, h2, h3, h4 = (batch.column(2 + i).to_numpy() for i in range(4))
            data, bounds = flat(batch.column(1))
            n, low, high, chars, low_chars, high_chars = _cuts(data, bounds, unit, h1, h2)
            raw, forms, outputs = data.tobytes(), [], []
            plain = (n == 0) | (h3 % 100 >= 100 - plain_percent)
            spm = h4 % 100 < spm_percent
            for r, (a, x, y, b) in enumerate(zip(bounds[:-1].tolist(), low.tolist(), high.tolist(), bounds[1:].tolist())):
                text = raw[a:b]
                if plain[r] or p in text or s in text or m in text:
                    forms.append("plain")
                    outputs.append(text)
                elif spm[r]:
                    forms.append("spm")
                    outputs.append(b"".join((s, raw[y:b], p, raw[a:x], m, raw[x:y])))
                else:
                    forms.append("psm")
                    outputs.append(b"".join((p, raw[a:x], s, raw[y:b], m, raw[x:y])))
            none = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(low_chars - chars[:-1], pa.int64(), mask=none), pa.array(high_chars - low_chars, pa.int64(), mask=none),
                 pa.array(outputs, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                names=["_row", "n", "form", "prefix_chars", "middle_chars", "output"])

    out = picked.mapInArrow(rows, out_schema("n long, form string, prefix_chars long, middle_chars long, output string", [picked.schema["_row"]]))
    return out.select("_row.*", "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: str = "output", form: str = "form", markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made of, found by its markers.

    A marker's first character occurs nowhere else in it, so neither a piece's
    end nor its start can make up a false one with the marker beside it.
    """
    whole, kind = F.col(f"`{output}`"), F.col(f"`{form}`")

    def between(left: str, right: str | None) -> Column:
        tail = F.substr(whole, F.instr(whole, left) + F.lit(len(left))) if left else whole
        return F.substring_index(tail, right, 1) if right else tail

    p, s, m = markers
    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(kind == "psm", psm).when(kind == "spm", spm).otherwise(whole)


def op13(spark, sf_dir: str) -> DataFrame:
    done = fill_in_middle(tables(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
c AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""

QUERIES = {"op13_fill_in_middle": op13}
ORACLES = {"op13_fill_in_middle": ORACLE}
