"""Keeping joins splittable when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def own_exchange(df: DataFrame, *keys: str) -> DataFrame:
    """Gives the reduced side of a join an exchange of its own on ``keys``.

    Adaptive execution splits a hot key only where a join reads two plain exchanges. A side
    that was just aggregated, or joined, on the same key is already partitioned on it, so
    Spark joins it in place and the hot partition of the other side stays whole. Recomputing
    the key makes Spark shuffle this side once more: it has one row per key, so that is the
    cheap side, and in return the big side can be cut up.
    """
    kinds = dict(df.dtypes)
    for key in keys:
        col = F.col(key)
        # expressions that leave the value alone and that the optimiser does not see through
        kind, _, collation = kinds[key].partition(" collate ")
        same = F.concat(col, F.lit("")) if kind == "string" else col.bitwiseOR(F.lit(0).cast(kind))
        same = F.collate(same, collation) if collation else same
        df = df.withColumn(key, same)
    return df
