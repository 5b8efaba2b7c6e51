"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.llm import (chat, exact_dedup, fim, lexical_search, mixing, near_dedup, packing, pii, quality, substring_dedup,
                           suffix_dedup, toxicity, url_filter)

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.learn(docs, labels, toxicity.crc_held_out))
    return scored.select("doc_id", toxicity.crc_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_report(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.fit_and_judge(docs, table(spark, sf_dir, "labels")).drop("score")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path()))


def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_pairs(chat.all_answer_pairs(table(spark, sf_dir, "conversations")))


SURROGATE_KEY = b"surrogates-1"       # a deployment passes its own secret


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, SURROGATE_KEY)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark")).drop("qkey")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_report(table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_source_mixing": op7_source_mixing,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_preference_format": op9_preference_format,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_ranked_search": op11_ranked_search,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_suffix_dedup": op13_suffix_dedup,
}
