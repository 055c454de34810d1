"""A corpus made ready for training: quality rules, near-dedup, substring dedup, packing.

Each stage works on all that the stage before it kept; all but the last return the columns of
``documents``. ``run`` writes every stage's result to the shared scratch folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tableflow.llm import packing, quality, relative, simhash
from tableflow.scratch import handed_out, written_last


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go, and those of hosts that do."""
    return quality.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (fingerprints of 3-word shingles that differ in 2 bits or
    fewer) the least id stays."""
    return simhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the document with the least id only."""
    return relative.cleaned(docs, length="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full sequences, each mixed from all sources."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [("quality rules", quality_rules), ("near-dedup", near_dedup),
          ("substring dedup", substring_dedup), ("packing", pack)]

#: SQL has no tokenizer and no connected components; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder.

    What a stage wrote on its way goes as soon as its result is written, and so do the documents
    that it worked on.
    """
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), handed_out()
    for name, stage in STAGES:
        docs = written_last(stage(spark, docs, sf_dir), name.replace(" ", "_"), since)
    return docs
