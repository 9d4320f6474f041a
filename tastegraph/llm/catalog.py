"""The queries of this subpackage: ``queries()`` and ``oracle_sql()`` by name.

Each ``opN_`` query applies operator N, with its production parameters, to the
whole of its table. ``pipeline`` runs the stages of ``corpus_pipeline``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tastegraph.llm import (
    fim,
    hamming,
    jaccard,
    langid,
    linededup,
    mixing,
    oracle,
    pieces,
    quality,
    substrings,
    topk,
    toxicity,
    urls,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_quality_rules", oracle.QUALITY_RULES)
def op1(spark, sf_dir):
    out = quality.quality_rules(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@register("op2_jaccard_join")
def op2(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_language_id")
def op3(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@register("op4_exact_top_k", oracle.EXACT_TOP_K)
def op4(spark, sf_dir):
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


@register("op5_substring_dedup")
def op5(spark, sf_dir):
    return substrings.repeated_words(table(spark, sf_dir, "documents"))


@register("op6_source_mix")
def op6(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@register("op7_line_dedup")
def op7(spark, sf_dir):
    return linededup.line_report(table(spark, sf_dir, "documents"))


@register("op8_toxicity")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@register("op9_url_filters", oracle.URL_FILTERS)
def op9(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"), urls.demo_rules(spark))


@register("op10_sentencepiece")
def op10(spark, sf_dir):
    return pieces.digests(pieces.encode(table(spark, sf_dir, "documents")))


@register("op11_minhash_near_dedup", oracle.NEAR_DEDUP)
def op11(spark, sf_dir):
    return hamming.near_duplicates(table(spark, sf_dir, "documents"))


@register("op12_fill_in_middle", oracle.FILL_IN_MIDDLE)
def op12(spark, sf_dir):
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


@register("op13_embedding_whitening")
def op13(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
