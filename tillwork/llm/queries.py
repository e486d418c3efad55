"""The corpus operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwork.llm import bpe, chat, langid, licenses, lines, lm, merkle, mixing, quality, sharding, simhash, trie, vectors
from tillwork.llm.common import table
from tillwork.llm.oracle import ORACLE  # noqa: F401  (registered beside the queries)

Query = Callable[[SparkSession, str], DataFrame]


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.dedup(table(spark, sf_dir, "documents")))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenize(table(spark, sf_dir, "documents"))


def op6_vector_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near(table(spark, sf_dir, "embeddings"))


def op7_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.render(turns.union(chat.probe(spark))))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_source_mix, op2_divergence, op3_license_scan, op4_line_templates, op5_byte_bpe, op6_vector_graphs,
    op7_backoff_automaton, op8_hash_tree, op9_simhash, op10_language_id, op11_prefix_trie, op12_merkle_manifest,
    op13_chat_template)}

