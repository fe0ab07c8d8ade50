"""Corpus pipeline: documents through five corpus operators, one written stage each.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: the rows that the
stage keeps, with the columns of ``documents``; the last one returns the digest of
the token store written from what its predecessors kept. Empty inputs pass through
as empty outputs; the operators' docstrings say what nulls, ties and repeated rows do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jornada.llm import decontaminate, mixing, near_dup, quality_rules, token_store
from jornada.llm.common import table, written
from jornada.session import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: links at 0.8 on shingles of five words."""
    return near_dup.deduplicate(docs, shingle=5).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as the source targets ask for."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token store of the mixed corpus, written and read back."""
    path = scratch_dir(spark, "pipeline-tokens")
    token_store.write_tokens(docs, path)
    return token_store.read_documents(spark, path)


STAGES = [("quality_rules", quality), ("near_dup", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixture), ("token_store", tokens)]

# Tokenizer ids, edit matching and sketches are beyond SQL; tests/llm checks run()
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
