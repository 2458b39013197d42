"""Corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``; other columns are left behind.
Rows with nulls anywhere pass through unless a stage's own rule rejects them,
and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm import decontaminate, language, line_dedup, near_dup, packing
from churnkit.llm.common import Scratch, read_table
from churnkit.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose language has less than this probability is rejected.
MIN_LANGUAGE_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known well enough; those without a letter go."""
    out = language.identify(docs, language.fit(docs), keep=COLUMNS)
    return out.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that stand earlier in the corpus; documents of which nothing is left go."""
    out = line_dedup.dedup_lines(docs, Scratch(spark), keep=COLUMNS)
    left = (F.size("dropped") == 0) | (F.trim("clean_text") != "")
    size = F.when(F.size("dropped") == 0, F.col("n_chars")).otherwise(F.length("clean_text"))
    return out.where(left).select("doc_id", F.col("clean_text").alias("text"), "lang", "source", size.cast("long").alias("n_chars"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group, once."""
    found = near_dup.near_duplicates(docs, shingle=5, percent=80)
    gone = found.where("NOT kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone.hint("merge"), "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.flag(docs, items, keep=COLUMNS).where("NOT contaminated").select(*COLUMNS)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontaminate", decontaminate_documents),
    ("pack", pack_documents),
]

#: Networks, MinHash, tiling and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.release()
    return scratch.result(STAGES[-1][1](spark, docs, sf_dir))
