"""Registered queries of the training-data operators (one per operator) and
their DuckDB oracles, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import (chat, decontaminate, exact_dedup, jaccard_join, lexical_search, license_scan, line_dedup, merkle, mixing,
                          ngram_lm, quality, token_counts, url_filter)
from wardflow.llm.shared import prepare
from wardflow.sources.tables import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(prepare(spark), sf_dir, name)


@query("op1_poisson_mix", mixing.mix_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated to square-root source weights, globally shuffled."""
    return mixing.poisson_mix(table(spark, sf_dir, "documents"))


@query("op2_line_dedup", line_dedup.line_dedup_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated runs of lines."""
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_lines", F.array_join(F.col("deleted").cast("array<string>"), ",").alias("deleted"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op4_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "class_size")


@query("op5_decontaminate", decontaminate.overlaps_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of a document with a benchmark item."""
    out = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("at").alias("start"), "n_words", "n_match", "share")


@query("op6_preference_format", chat.CHAT_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of every conversation against the same
    conversation with its neighbour's last reply."""
    out = chat.preference_format(chat.neighbour_pairs(table(spark, sf_dir, "conversations")))
    return out.withColumns({c: chat.spans_text(out[c]) for c in ("chosen_spans", "rejected_spans")})


@query("op7_lm_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return ngram_lm.score_corpus(table(spark, sf_dir, "documents"))


@query("op8_url_filter")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page url: rules first, else the n-gram model."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.labelled_urls(spark))


@query("op9_exact_dedup", exact_dedup.EXACT_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_license_scan")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, tags and labels of every document."""
    return license_scan.license_report(table(spark, sf_dir, "documents"))


@query("op12_lexical_search", lexical_search.SEARCH_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_merkle_manifest", merkle.merkle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and check of every document."""
    return merkle.verify(merkle.manifest(table(spark, sf_dir, "documents"), merkle.lowered_text()))
