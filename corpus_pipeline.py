"""Corpus pipeline: stages that each call one operator of ``footfall.llm``.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame``.  Its result is
written as Parquet and read back as the next stage's ``docs``.  Every stage takes null
ids and texts, empty and very long texts, repeated rows and ids, an empty table and
columns of any name; the defined results are in the docstrings of the operators.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from footfall.llm import byte_bpe, decontaminate, line_dedup, simhash_dedup, toxicity  # noqa: E402
from footfall.llm.queries import BPE_RANKS  # noqa: E402
from footfall.llm.stages import free_name, restage, stage_count  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; a null or empty text has
    the score of a text without terms, and every row counts for itself."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "_toxicity")
    return toxicity.score_documents(docs, model, name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat across them; ``n_chars`` follows the text.
    A null text stays null with its ``n_chars``; a text that loses all lines stays, empty."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars").cast("long")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the smallest doc_id; texts without words are
    near copies of each other."""
    return simhash_dedup.one_per_group(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; null and empty texts contain none."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return byte_bpe.round_trip(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE", tokenise),
]

#: Stages learn a model, fingerprint with XXH64 and encode by a vocabulary: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole ``documents`` table.

    When a stage has been written, its own intermediate tables and the result of the stage
    before it are deleted; the result reads only the last written one."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), stage_count()
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = restage(docs, f"pipeline-{k}", since)
    return docs
