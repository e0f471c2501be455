"""The registered queries of the training-data operators: thin digests of what they return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeseam.llm import (bloom_lm, decontaminate, divergence, jaccard, lexicon, line_dedup, merkle, permutation, preference,
                          quality, token_file, toxicity, unigram)
from lodeseam.llm.common import held_out, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _scored(docs: DataFrame, score, threshold: float) -> DataFrame:
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, quality.score(model, F.col("text")), 0.3)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, toxicity.score(model, F.col("text")), 0.5)


@query
def op7_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_file.new_folder(spark)
    token_file.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return token_file.digests(spark, folder)


@query
def op5_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_later_copies(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "n_lines", "n_deleted", "row.text")


@query
def op6_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op9_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = stored(preference.conversations_of(table(spark, sf_dir, "conversations")))
    # the table holds no verdicts: conversations with the same opening, and neighbours, make the pairs
    pairs = preference.same_opening(conversations).union(preference.neighbours(conversations)).distinct()
    return preference.completions(conversations, pairs)


ORACLES["op9_preference"] = preference.SQL


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


ORACLES["op12_merkle"] = merkle.SQL


@query
def op13_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.learned_and_scored(table(spark, sf_dir, "documents"))


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op11_divergence"] = divergence.SQL
