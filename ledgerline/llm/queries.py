"""Registered queries of the operators: thin forms over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import chat, decontaminate, ngram_join, packing, quality, secrets, spelling, substring_dedup, token_store, toxicity, url_filter, warc, whitening
from ledgerline.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.digests(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents")).drop("root", "row")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.round_trip(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digests(table(spark, sf_dir, "embeddings"))


def url_filter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op4 that the rules alone decide."""
    return url_filter.judged_by_rules(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5 that the base counts alone decide."""
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return quality.verdicts(table(spark, sf_dir, "documents")).select("doc_id", *base)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return own | {"url_filter_rules": url_filter_rules, "quality_base": quality_base}
