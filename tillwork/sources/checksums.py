"""Snapshots in key buckets, with a tree of checksums that tells which buckets differ.

A row's checksum covers all its columns; a bucket's adds up its rows', so it does not depend on their
order, and a node's adds up its children's. Two trees are compared from the root down: equal
nodes are left, so what is read of two snapshots follows from what changed between them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillwork.session import settle
from tillwork.sources.storage import exists, remove

BUCKET, DELETED = "_cubo", "_borrada"
_SUMS = ["filas", "suma_a", "suma_b", "mezcla"]
_LOW = 0xFFFFFFFF


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row; a null is told from every value and from its neighbour."""
    parts = [p for c in columns for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(*parts), F.xxhash64(F.lit("mezcla"), *parts)


def totals(columns: list[str]) -> list[Column]:
    """Rows and their order-free checksum, as aggregates that combine before a shuffle."""
    one, other = row_hashes(columns)
    high, low = F.shiftrightunsigned(one, 32), one.bitwiseAND(F.lit(_LOW))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return [F.count(F.lit(1)).alias("filas"), zero(F.sum(high)).alias("suma_a"), zero(F.sum(low)).alias("suma_b"),
            zero(F.bit_xor(other)).alias("mezcla")]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def checksum_tree(df: DataFrame, key: str, buckets: int, fan: int = 32) -> DataFrame:
    """(nivel, nodo, checksum): buckets at level 0, above them the sums of ``fan`` nodes each, one root.

    One pass over the rows, combined by bucket before the shuffle; the rest is at most ``buckets`` rows.
    """
    columns = [c for c in df.columns if c != BUCKET]
    level = df.groupBy(bucket_of(key, buckets).alias("nodo")).agg(*totals(columns))
    return _levels(settle(level, "checksums"), buckets, fan)


def _levels(level: DataFrame, buckets: int, fan: int) -> DataFrame:
    add = [F.sum("filas").alias("filas"), *[F.sum(F.col(c).bitwiseAND(F.lit(_LOW))).alias(c) for c in ("suma_a", "suma_b")],
           F.bit_xor("mezcla").alias("mezcla")]
    out, nodes, number = [], buckets, 0
    while True:
        out.append(level.select(F.lit(number).alias("nivel"), F.col("nodo").cast("int").alias("nodo"), *_SUMS))
        if nodes == 1:
            return reduce(DataFrame.unionByName, out)
        level = level.groupBy(F.floor(F.col("nodo") / fan).alias("nodo")).agg(*add)
        nodes, number = -(-nodes // fan), number + 1


def changed_buckets(a: DataFrame, b: DataFrame, fan: int = 32) -> list[int]:
    """The buckets in which two trees over as many buckets differ, from the root down.

    A level looks only below nodes that differ. What reaches the driver is bucket numbers.
    """
    top = a.unionByName(b).agg(F.max("nivel")).first()[0]
    suspects = [0]
    for level in range(top if top is not None else -1, -1, -1):
        here = lambda t: t.where((F.col("nivel") == level) & F.col("nodo").isin(suspects)).drop("nivel")
        left, right = here(a), here(b).select(F.col("nodo").alias("_nodo"), *[F.col(c).alias(f"_{c}") for c in _SUMS])
        same = reduce(lambda x, c: x & F.col(c).eqNullSafe(F.col(f"_{c}")), _SUMS, F.lit(True))
        found = left.join(right, F.col("nodo") == F.col("_nodo"), "full").where(~same)
        differ = sorted(r[0] for r in found.select(F.coalesce("nodo", "_nodo")).collect())
        if not differ or level == 0:
            return differ
        suspects = [n * fan + k for n in differ for k in range(fan)]
    return []


class BucketSnapshot:
    """A table below ``path``: rows by bucket of their key, and their checksum tree.

    Keys are unique and not null. Aim at some hundred megabytes a bucket: a bucket is what a merge rewrites.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType, buckets: int = 64):
        self.spark, self.path, self.key, self.schema, self.buckets = spark, path.rstrip("/"), key, schema, buckets

    def write(self, df: DataFrame) -> None:
        """The whole table; a bucket's rows are shuffled together once. The tree comes last."""
        rows = df.select(*self.schema.names).withColumn(BUCKET, bucket_of(self.key, self.buckets))
        rows.repartition(self.buckets, BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/filas")
        self._store(checksum_tree(self.rows(), self.key, self.buckets))

    def _store(self, tree: DataFrame) -> None:
        settle(tree, "tree").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/arbol")

    def tree(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/arbol/_SUCCESS"):
            raise ValueError(f"{self.path} has no checksum tree: it was not finished")
        return self.spark.read.parquet(f"{self.path}/arbol")

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets: the folders of others are not listed as input."""
        kind = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        found = self.spark.read.schema(kind).parquet(f"{self.path}/filas")
        return (found if buckets is None else found.where(F.col(BUCKET).isin(buckets))).drop(BUCKET)

    def changes_to(self, current: DataFrame | BucketSnapshot) -> DataFrame:
        """What makes this snapshot the ``current`` table: new and changed rows, and deleted keys.

        Needs no column that says when a row changed. A deleted row has its key and ``_borrada``; of this
        snapshot only buckets that differ are read. A table is read once for its tree and its rows of
        these buckets are picked; of another snapshot the buckets are read.
        """
        stored = isinstance(current, BucketSnapshot)
        other = current.tree() if stored else settle(checksum_tree(current.select(*self.schema.names), self.key, self.buckets), "tree")
        differ = changed_buckets(self.tree(), other)
        old = self.rows(differ)
        new = current.rows(differ) if stored else current.select(*self.schema.names).where(bucket_of(self.key, self.buckets).isin(differ))
        one, two = row_hashes(self.schema.names)
        before = old.select(F.col(self.key).alias("_clave"), one.alias("_a"), two.alias("_b"))
        after = new.withColumns({"_uno": one, "_dos": two})
        joined = after.join(before, F.col(self.key) == F.col("_clave"), "full")
        gone = F.col(self.key).isNull()
        same = F.col("_uno").eqNullSafe(F.col("_a")) & F.col("_dos").eqNullSafe(F.col("_b"))
        return joined.where(~same).select(
            F.coalesce(self.key, "_clave").alias(self.key), *[c for c in self.schema.names if c != self.key],
            gone.alias(DELETED)).select(*self.schema.names, DELETED)

    def differing_rows(self, other: BucketSnapshot) -> DataFrame:
        """Rows that only one of two snapshots has, counted, from the buckets that differ."""
        differ = changed_buckets(self.tree(), other.tree())
        a, b = self.rows(differ), other.rows(differ)
        count = lambda df, name: df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        return count(a.exceptAll(b), "solo_a").unionByName(count(b.exceptAll(a), "solo_b"))

    def apply(self, changes: DataFrame | list[DataFrame]) -> None:
        """Merges change sets, oldest first, rewriting only the buckets they touch.

        The newest row of a key wins, a deletion included, found by an aggregate that combines before it
        shuffles. New buckets are stored apart first, then each replaces its old folder; files of
        other buckets stay as they are. Applying the same changes again changes nothing.
        """
        changes = changes if isinstance(changes, list) else [changes]
        numbered = [c.select(*self.schema.names, DELETED).withColumn("_orden", F.lit(k)) for k, c in enumerate(changes)]
        names = [*self.schema.names, DELETED]
        newest = (reduce(DataFrame.unionByName, numbered).groupBy(self.key)
                  .agg(F.max_by(F.struct(*names), "_orden").alias("_r")).select("_r.*"))
        newest = settle(newest, "newest")
        touched = sorted(r[0] for r in newest.select(bucket_of(self.key, self.buckets)).distinct().collect())
        if not touched:
            return
        kept = self.rows(touched).join(newest.select(self.key), self.key, "left_anti").select(*self.schema.names)
        merged = kept.unionByName(newest.where(~F.col(DELETED)).drop(DELETED)).withColumn(BUCKET, bucket_of(self.key, self.buckets))
        merged = settle(merged.repartition(self.buckets, BUCKET), "merged")
        leaves = self.tree().where("nivel = 0").where(~F.col("nodo").isin(touched)).select("nodo", *_SUMS)
        fresh = merged.groupBy(F.col(BUCKET).alias("nodo")).agg(*totals(self.schema.names))
        tree = settle(_levels(settle(leaves.unionByName(fresh), "checksums"), self.buckets, 32), "tree")
        (merged.repartition(self.buckets, BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(f"{self.path}/filas"))
        emptied = set(touched) - {r[0] for r in merged.select(BUCKET).distinct().collect()}
        for bucket in sorted(emptied):  # an overwrite leaves partitions alone that have no row left
            remove(self.spark, f"{self.path}/filas/{BUCKET}={bucket}")
        self._store(tree)
