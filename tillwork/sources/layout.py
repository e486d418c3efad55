"""Storing the sales tables so that their joins need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Saves a table hashed and sorted on its join key.

    Sales and sale lines bucketed alike on the sale id join, and aggregate per sale, where
    they lie. Aim at a few hundred megabytes per bucket.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def read_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.table(table) for name, table in names.items()}
