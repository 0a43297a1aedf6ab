"""Registered queries of the operators in this folder, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe,
    decontamination,
    language_id,
    line_dedup,
    minhash,
    oracle,
    pii,
    quality,
    rank_bpe,
    sharding,
    spelling,
    token_alignment,
    toxicity,
    url_filters,
)
from .common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary, as its package names it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def rank_pattern() -> str:
    """The pattern that belongs to the public rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


@_query
def op4_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = documents.withColumn("held_out", fold("doc_id", 5) == 0)
    model = language_id.fit(rows.filter(~F.col("held_out") & language_id.known_language()))
    found = language_id.predict(rows.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@_query
def op7_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learned = documents.join(labels.filter(fold("doc_id", 3) != 1), "doc_id")
    model = toxicity.fit(learned)
    rows = documents.withColumn("held_out", fold("doc_id", 3) == 1)
    return toxicity.score(rows, model).select("doc_id", "held_out", "score", "predicted")


@_query
def op8_bpe(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(documents, vocabulary_path()).drop("text")


@_query
def op9_quality_rules(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.apply(documents, quality.fit(documents)).drop("text", "lang")


@_query
def op6_minhash(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(documents)


@_query
def op5_line_dedup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(documents)


@_query
def op3_decontamination(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark(documents, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


@_query
def op1_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


# On a real corpus the key is a secret of its owner; the operator takes it as an argument.
PSEUDONYM_KEY = "a key for the synthetic tables"


@_query
def op10_pii(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(documents, PSEUDONYM_KEY)


# The rules of the filter, and how its pages are labelled.
URL_RULES = (
    url_filters.Rule("net/", "block"),
    url_filters.Rule("example.net/en/", "allow"),
    url_filters.Rule("example.com/de/", "block"),
    url_filters.Rule("org/fr/", "allow"),
)


@_query
def op2_url_filters(spark, sf_dir):
    """A page counts as bad when the label of the document with its id has quality 0."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad")
    )
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), labels, URL_RULES)


_ORACLE["op2_url_filters"] = oracle.url_filters(URL_RULES, url_filters.Settings())


@_query
def op11_rank_bpe(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = vocabulary_path("byte_bpe_50k.tiktoken")
    return rank_bpe.round_trip(documents, ranks, rank_pattern()).drop("text")


# One run in so many loses a code point: the variants that the synthetic tables lack.
PLANTED_ONE_IN = 97


@_query
def op12_spelling_variants(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(documents, one_in=PLANTED_ONE_IN))


@_query
def op13_token_alignment(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = vocabulary_path("piece_bpe_32k.model")
    return token_alignment.align(documents, vocabulary_path(), pieces)
