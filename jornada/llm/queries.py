"""Registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (conversation_repair, decontaminate, html_extract, jaccard_join, katz, language_id,
               lexical_search, mixing, near_dup, pii, quality_rules, rule_ensemble, token_store)
from .common import id_bucket, table, written


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule ledger of every document, with the verdict of the current policy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality_rules.apply_policy(quality_rules.ledger(docs))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept", "n_lines", "n_upper", "fail_bits")


def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systematic sample of every document: words taken against its source's target."""
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token store of every document, written and read back."""
    path = scratch_dir(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_store.read_documents(spark, path)


def op1_edit_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair within the item's edit budget."""
    return decontaminate.matches(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op5_setsketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learns from the rows that are not held out."""
    held_out = id_bucket(F.col("doc_id"), 5) == 0
    stats = written(rule_ensemble.statistics(table(spark, sf_dir, "documents")), "quality-stats")
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = rule_ensemble.train(stats.where(~held_out), labels)
    return rule_ensemble.predict(stats, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learns from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    model = language_id.train(docs.where(~held_out).select("doc_id", "text", "lang"))
    return language_id.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_max_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, with weights counted on the labelled pages."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract_pages(pages, html_extract.train(pages))


def op7_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, with potentials counted on all documents."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op3_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz log-probability of every document; learns from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 10) == 0
    return katz.score(docs.select("doc_id", "text", held_out.alias("held_out")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the contract's damage."""
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_conversations(rows, conversation_repair.damage(rows))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of five-word shingle sets."""
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_edit_matches": op1_edit_matches,
    "op2_token_store": op2_token_store,
    "op3_katz_backoff": op3_katz_backoff,
    "op4_rule_ensemble": op4_rule_ensemble,
    "op5_setsketch_near_dup": op5_setsketch_near_dup,
    "op6_max_subsequence": op6_max_subsequence,
    "op7_skip_chain_pii": op7_skip_chain_pii,
    "op8_systematic_mix": op8_systematic_mix,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lexical_search": op12_lexical_search,
    "op13_jaccard_join": op13_jaccard_join,
}
