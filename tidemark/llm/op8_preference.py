"""Preference formatting: one prompt and two masked completions for each pair of conversations.

The longest common prefix of turns of the chosen and the rejected conversation
is rendered once as the prompt, what follows on either side as its completion.
One row is one rendered turn, so that a conversation may be of any length: the
split point is an aggregate of the pair's turns, not a walk over them in one
task. Loss is taken on the assistant's turns of completions: the content and the
mark that ends it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import tables

BEGIN, END = "<|im_start|>", "<|im_end|>"
_FIRST = -(1 << 63)


def format_preferences(turns: DataFrame, pair_col: str = "pair_id", chosen_col: str = "chosen", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text", trained_role: str = "assistant", rejected_col: str | None = None) -> DataFrame:
    """``pair_id``, ``part``, ``turn``, ``role``, ``segment``, ``mask_start``, ``mask_end``, one row for each rendered turn.

    ``turns`` has a pair's turns with a boolean: of the chosen or the rejected
    conversation. With ``rejected_col`` that column says whether a turn is the
    rejected one's, so that a turn of both needs one row only. ``part`` is ``prompt``, ``chosen`` or ``rejected``; segments of
    a part in order of turn (then role and segment, should a number repeat) make
    up its text. ``mask_start`` to ``mask_end`` (code points of the segment) is
    what the loss is taken on; both are 0 where there is none.

    Turns agree if role and text do; a null is an empty string. A null turn
    comes first. Equal rows count once. Equal conversations are all prompt. Where
    a side is missing, or the pair or the boolean is null, the rows come out as
    ``unpaired``, so none is lost. An empty table gives an empty result. Other
    columns are not read.
    """
    empty = F.lit("")
    side = F.col(f"`{chosen_col}`")
    other = F.col(f"`{rejected_col}`") if rejected_col else ~side
    rows = turns.select(F.col(f"`{pair_col}`").alias("pair_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), empty).alias("role"),
                        F.coalesce(F.col(f"`{text_col}`"), empty).alias("text"), F.coalesce(side, F.lit(False)).alias("c"), F.coalesce(other, F.lit(False)).alias("r"))
    rows = rows.groupBy("pair_id", "turn", "role", "text").agg(F.max("c").alias("c"), F.max("r").alias("r"))
    at = F.coalesce("turn", F.lit(_FIRST))
    pairs = rows.groupBy(F.col("pair_id").alias("_pair")).agg((F.max("c") & F.max("r") & F.col("_pair").isNotNull()).alias("whole"),
                                                             F.min(F.when(~(F.col("c") & F.col("r")), at)).alias("split"))
    joined = rows.join(pairs, F.col("pair_id").eqNullSafe(F.col("_pair")))
    parts = (F.when(~F.col("whole"), F.array(F.lit("unpaired"))).when(F.col("split").isNull() | (at < F.col("split")), F.array(F.lit("prompt")))
             .otherwise(F.array_compact(F.array(F.when(F.col("c"), "chosen"), F.when(F.col("r"), "rejected")))))
    head = F.concat(F.lit(BEGIN), "role", F.lit("\n"))
    out = joined.withColumn("part", F.explode(parts)).withColumn("segment", F.concat(head, "text", F.lit(END + "\n")))
    trained = (F.col("role") == trained_role) & F.col("part").isin("chosen", "rejected")
    mask = lambda x: F.when(trained, x).otherwise(0).cast("long")
    return out.select("pair_id", "part", "turn", "role", "segment", mask(F.length(head)).alias("mask_start"), mask(F.length("segment") - 1).alias("mask_end"))


def with_swapped_replies(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv_id``, ``turn``, ``role``, ``text``) as pairs: ``pair_id``, ``chosen``, ``rejected``, ``turn``, ``role``, ``text``.

    The chosen side is the conversation. The rejected one is the same up to its
    last assistant turn, which is replaced by the last assistant turn of
    conversation ``conv_id`` XOR 1 (2n and 2n + 1 lend each other theirs), so
    both sides share all turns before it. A conversation without an assistant's turn,
    or whose partner is missing or has none, has a chosen side only, and so has a
    null ``conv_id``. Of several last turns with one number the greatest text
    counts; a null text is empty and an assistant turn without a number is never the last.
    """
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    said = (turns.where("role = 'assistant' AND turn IS NOT NULL AND conv_id IS NOT NULL").groupBy(F.col("conv_id").alias("conv"))
            .agg(F.max(F.struct("turn", "text")).alias("last")))
    lent = said.select(F.col("conv").bitwiseXOR(F.lit(1)).alias("conv"), F.col("last.text").alias("reply"))
    swaps = said.select("conv", F.col("last.turn").alias("last_turn")).join(lent, "conv")
    both = F.col("conv").isNotNull() & (F.col("turn").isNull() | (F.col("turn") < F.col("last_turn")))
    own = turns.join(swaps, F.col("conv_id") == F.col("conv"), "left").select(F.col("conv_id").alias("pair_id"), F.lit(True).alias("chosen"), both.alias("rejected"), "turn", "role", "text")
    return own.union(swaps.select("conv", F.lit(False), F.lit(True), "last_turn", F.lit("assistant"), "reply"))


def op8(spark, sf_dir: str) -> DataFrame:
    """Every conversation, paired with itself ending in another one's last answer."""
    return format_preferences(with_swapped_replies(tables(spark, sf_dir, "conversations")), rejected_col="rejected")


ORACLE = f"""
WITH c AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
a AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS n FROM c WHERE role = 'assistant' AND turn IS NOT NULL AND conv_id IS NOT NULL),
w AS (SELECT x.conv_id, x.turn AS last_turn, y.text AS reply FROM a x JOIN a y ON y.conv_id = xor(x.conv_id, 1) WHERE x.n = 1 AND y.n = 1),
t AS (SELECT conv_id AS pair_id, turn, role, text, true AS chosen FROM c
      UNION ALL SELECT c.conv_id, turn, role, text, false FROM c JOIN w ON c.conv_id = w.conv_id WHERE turn IS NULL OR turn < last_turn
      UNION ALL SELECT conv_id, last_turn, 'assistant', reply, false FROM w),
u AS (SELECT pair_id, turn, role, text, bool_or(chosen) AS c, bool_or(NOT chosen) AS r, coalesce(turn, {_FIRST}) AS k FROM t GROUP BY ALL),
p AS (SELECT pair_id, bool_or(c) AND bool_or(r) AND pair_id IS NOT NULL AS whole, min(k) FILTER (NOT (c AND r)) AS split FROM u GROUP BY pair_id),
j AS (SELECT u.*, CASE WHEN NOT whole THEN 'unpaired' WHEN split IS NULL OR k < split THEN 'prompt' END AS alone FROM u JOIN p ON u.pair_id IS NOT DISTINCT FROM p.pair_id),
s AS (SELECT *, alone AS part FROM j WHERE alone IS NOT NULL UNION ALL SELECT *, 'chosen' FROM j WHERE alone IS NULL AND c UNION ALL SELECT *, 'rejected' FROM j WHERE alone IS NULL AND r),
m AS (SELECT *, role = 'assistant' AND part IN ('chosen', 'rejected') AS trained, '{BEGIN}' || role || chr(10) AS head FROM s)
SELECT pair_id, part, turn, role, head || text || '{END}' || chr(10) AS segment,
  CAST(CASE WHEN trained THEN length(head) ELSE 0 END AS BIGINT) AS mask_start, CAST(CASE WHEN trained THEN length(head || text || '{END}') ELSE 0 END AS BIGINT) AS mask_end
FROM m
"""

QUERIES = {"op8_preference_format": op8}
ORACLES = {"op8_preference_format": ORACLE}
