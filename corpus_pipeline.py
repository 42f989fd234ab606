"""Corpus pipeline: five stages over ``documents``, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. ``run`` writes every stage's rows as Parquet in the shared folder that
``spark.checkpoint.dir`` names and reads them back as the next one's documents.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.op1_jaccard import jaccard_components
from tidemark.llm.op3_quality import score_quality
from tidemark.llm.op4_substring import remove_shared_spans
from tidemark.llm.op5_packing import pack_documents
from tidemark.llm.op7_decontaminate import remove_contaminated
from tidemark.llm.store import stored, tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates: five-word shingles, similarity of 0.8 or more.
NEAR = {"n": 5, "num": 80, "den": 100}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    docs = docs.select(*COLUMNS)
    return score_quality(docs, tables(spark, sf_dir, "labels")).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the smallest id.

    Near are texts whose sets of ``NEAR["n"]``-word shingles have ``NEAR["num"] /
    NEAR["den"]`` of Jaccard similarity or more (``op1_jaccard_join`` has a rule of its own).
    Documents with a null id stay, and texts that share an id without being near
    duplicates; rows of one id and text count once.
    """
    docs = docs.select(*COLUMNS)
    heads = jaccard_components(docs, **NEAR).where("component_id = doc_id OR doc_id IS NULL").groupBy("doc_id").agg(F.count("*").alias("_rows"))
    kept = docs.join(heads.where("doc_id IS NOT NULL"), "doc_id")
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    repeated = kept.where("_rows > 1").groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("_rest")).select("doc_id", "text", "_rest.*")
    return kept.where("_rows = 1").select(*COLUMNS).union(repeated).union(docs.where("doc_id IS NULL"))


def shared_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without spans of 50 words or more that an earlier document has. Texts of which nothing is left go."""
    cut = remove_shared_spans(docs.select(*COLUMNS), keep=("lang", "source", "n_chars")).where("n_removed = 0 OR n_removed < n_words")
    changed = F.col("n_removed") > 0
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                      F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return remove_contaminated(docs.select(*COLUMNS), tables(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its sequence of at most 4096 tokens."""
    return pack_documents(docs.select(*COLUMNS))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("shared_substrings", shared_substrings),
          ("decontaminated", decontaminated), ("packed", packed)]

#: SQL can express neither the classifier nor the packing; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
