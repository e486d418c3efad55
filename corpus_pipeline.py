"""The corpus pipeline: documents through five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwork.llm import bpe, langid, lines, mixing, simhash
from tillwork.llm.common import settle, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: without letters, or torn between languages."""
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes recurring lines out of the texts, all but the first; ``n_chars`` follows the text."""
    return lines.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents until sources have their shares of the words."""
    return mixing.apply_mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text that is left, repeats included, and decodes it again."""
    return bpe.tokenize(docs)


STAGES = [("language ID", language_id), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup),
          ("source mix", source_mix), ("byte-level BPE", byte_bpe)]

#: Fitted models, connected components and a tokenizer: not for SQL. Tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is stored and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
