"""Registered queries of this package: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm import (
    exact_dedup,
    language_id,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    page_text,
    pieces,
    prefix_trie,
    token_counts,
    token_files,
    turn_repair,
    vector_dedup,
)
from orderwell.llm.shipping import ship
from orderwell.sources.tables import scratch_path

WORD_FILE, PIECE_FILE = "word_bpe_49k.json", "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = language_id.held_out()
    model = language_id.train(docs.filter(~fold))
    found = language_id.predict(docs, model)
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score", "rejected")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(documents(spark, sf_dir))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(documents(spark, sf_dir))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.index(documents(spark, sf_dir), public_tokenizers.path(WORD_FILE))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(documents(spark, sf_dir), public_tokenizers.path(PIECE_FILE))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(documents(spark, sf_dir), public_tokenizers.path(PIECE_FILE))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    index = line_dedup.LineIndex(spark, scratch_path(spark, "line-index"))
    index.insert(docs)
    return index.rewrite(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return vector_dedup.near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(conversations(spark, sf_dir), prefix_trie.Lending())


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return page_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = conversations(spark, sf_dir)
    return turn_repair.repair(turn_repair.damage(whole), known=whole)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_mixing, op3_exact_dedup, op4_near_dedup, op5_token_files,
        op6_pieces, op7_token_counts, op8_line_dedup, op9_lm_scoring, op10_vector_dedup,
        op11_prefix_trie, op12_page_text, op13_turn_repair,
    )
}
