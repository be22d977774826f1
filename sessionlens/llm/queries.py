"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm import (
    attention_quality,
    divergence,
    imatch,
    jaccard_join,
    language_id,
    lexical_search,
    line_dedup,
    mixing,
    oracles,
    perplexity,
    pieces,
    token_counts,
    toxicity,
    urls,
)
from sessionlens.llm.texts import id_remainder

#: The operators take the path of a tokenizer as a parameter.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")

URL_RULES = (
    urls.Rule(urls.ALLOW, "com", "/"),
    urls.Rule(urls.BLOCK, "example.com", "/en/"),
    urls.Rule(urls.ALLOW, "www.example.com", "/en/"),
    urls.Rule(urls.BLOCK, "net", "/es/"),
    urls.Rule(urls.BLOCK, "net", "/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "n_strict", "n_soft", "verdict")


def piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = pieces.encode_and_decode(docs, PIECE_MODEL, keep=["doc_id"])
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_chunks", "n_removed", "text")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select(
        "doc_id",
        (id_remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
    )


def language_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(3) == 1
    model = language_id.fit(docs, ~held_out)
    named = language_id.with_language(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = attention_quality.fit(docs, table(spark, sf_dir, "labels"))
    return attention_quality.score(docs, model).select(
        "doc_id",
        (id_remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= attention_quality.GOOD).cast("int").alias("predicted"),
    )


def perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.judge(table(spark, sf_dir, "documents"))


#: As many tokens as there are; the entropy of the weights at 98 percent of its maximum.
MIX_TARGET = mixing.Target(entropy=0.98, max_repeats=2.0, min_passes=0.0)


def temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, MIX_TARGET)
    return mixed.select(
        "doc_id", "source", mixing.word_tokens().alias("tokens"), "mix_pass", "mix_block"
    )


def lexical_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark"))


def whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.with_token_counts(docs, BYTE_MODEL, keep=["doc_id"])


def quadtree_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_chunks": line_chunks,
        "op2_imatch_fingerprints": imatch_fingerprints,
        "op3_language_family": language_family,
        "op4_perplexity_rules": perplexity_rules,
        "op5_url_vocabulary": url_vocabulary,
        "op6_toxicity": toxicity_scores,
        "op7_piece_encoding": piece_encoding,
        "op8_temperature_mix": temperature_mix,
        "op9_attention_quality": attention_scores,
        "op10_jaccard_classes": jaccard_classes,
        "op11_blocked_search": lexical_ranking,
        "op12_whole_token_counts": whole_token_counts,
        "op13_quadtree_divergence": quadtree_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_chunks": oracles.line_chunks(line_dedup.LEAST_LINES, line_dedup.LEAST_CHARS),
        "op2_imatch_fingerprints": oracles.imatch_fingerprints(
            imatch.LEAST_SHARE, imatch.MOST_SHARE
        ),
        "op8_temperature_mix": oracles.temperature_mix(MIX_TARGET),
        "op10_jaccard_classes": oracles.jaccard_classes(
            jaccard_join.THRESHOLD, jaccard_join.WIDTH
        ),
        "op11_blocked_search": oracles.lexical_search(lexical_search.TOP),
        "op13_quadtree_divergence": oracles.divergence(
            divergence.LEAST_DOCUMENTS, divergence.TOP_TERMS
        ),
        "op5_url_vocabulary": oracles.url_rules(URL_RULES, urls.DEFAULT_VOCABULARY),
    }
