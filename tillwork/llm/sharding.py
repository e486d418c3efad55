"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

#: region -> rack -> shard -> weight. Names are part of the draws, so they must stay as they are
#: when the tree grows.
Tree = dict[str, dict[str, dict[int, float]]]

#: The production tree: two regions of two racks of two equal shards.
EIGHT: Tree = {f"r{r}": {f"k{k}": {4 * r + 2 * k + s: 1.0 for s in range(2)} for k in range(2)} for r in range(2)}


def with_region(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, alone in a region of its own.

    At the region level only draws for the new region are added, and that region has a single
    path, so rows move into the new shard and nowhere else. (A shard added inside a rack moves
    rows into that rack's region, where the draws below it spread them.)
    """
    return {**tree, f"r{len(tree)}": {"k0": {shard: weight}}}


def _draw(key: Column, path: Column, children: Column) -> Column:
    """The child with the smallest weighted draw: -ln(u) / weight, u hashed from key and child.

    The chance of a child is its share of the weights. Raising one child's weight changes that
    child's draw alone, so keys only move to it; lowering it moves only its own keys.
    """
    bits = lambda c: F.conv(F.substring(F.md5(F.concat(key, path, F.lit("/"), c["id"])), 1, 13), 16, 10)
    unit = lambda c: (bits(c).cast("double") + 0.5) / F.lit(2.0 ** 52)
    scores = F.transform(children, lambda c: F.struct((-F.ln(unit(c)) / c["w"]).alias("score"), c["id"].alias("id")))
    return F.array_min(scores)["id"]


def _weighted(pairs: list[tuple[str, float]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("w")) for i, w in pairs if w > 0])


def _lookup(entries: dict[str, Column]) -> Column:
    return F.create_map(*[x for name, value in entries.items() for x in (F.lit(name), value)])


def assign(df: DataFrame, key: Column, tree: Tree, name: str) -> DataFrame:
    """Adds the shard that ``key`` (text) reaches by descending the tree."""
    total = lambda node: sum(node.values()) if all(not isinstance(v, dict) for v in node.values()) else sum(map(total, node.values()))  # noqa: E731,E501
    regions = _weighted([(r, total(v)) for r, v in tree.items()])
    racks = _lookup({r: _weighted([(k, total(v)) for k, v in ks.items()]) for r, ks in tree.items()})
    shards = _lookup({f"{r}/{k}": _weighted([(str(s), w) for s, w in ss.items()])
                      for r, ks in tree.items() for k, ss in ks.items()})
    df = df.withColumn("_region", _draw(key, F.lit(""), regions))
    df = df.withColumn("_rack", F.concat("_region", F.lit("/"),
                                         _draw(key, F.concat(F.lit("/"), F.col("_region")), racks[F.col("_region")])))
    shard = _draw(key, F.concat(F.lit("/"), F.col("_rack")), shards[F.col("_rack")])
    return df.withColumn(name, shard.cast("int")).drop("_region", "_rack")


def place(docs: DataFrame, tree: Tree | None = None, rows_per_chunk: int = 500) -> DataFrame:
    """Every document's shard, its slot there, and its shard once the tree has one more.

    Law ``key``: doc_id and the tree alone decide. A null doc_id counts as the text ``null``;
    repeated ids share a shard. ``size`` is the text's UTF-8 bytes plus 1 and ``text_crc32`` the
    checksum of these bytes, a null text having none. Slots run from 0 without gaps in the
    order of md5(doc_id), size, checksum; equal rows share their slots in any order. An empty
    table gives an empty result.

    Slots are numbered per chunk, a prefix of the md5, and the number of rows in earlier
    chunks is added, so no task holds a shard; prefixes are longer the more rows there are.
    """
    tree = tree or EIGHT
    count = docs.count()
    shards = [s for ks in tree.values() for ss in ks.values() for s in ss]
    digits = max(0, math.ceil(math.log(max(1, count / len(shards) / rows_per_chunk), 16)))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select("doc_id", key.alias("_key"), F.md5(key).alias("_order"), F.coalesce("text", F.lit("")).alias("_text"))
    rows = rows.select("doc_id", "_key", "_order", F.substring("_order", 1, digits).alias("_chunk"),
                       (F.octet_length("_text") + 1).cast("bigint").alias("size"), F.crc32("_text").alias("text_crc32"))
    rows = assign(assign(rows, F.col("_key"), tree, "shard"), F.col("_key"), with_region(tree, len(shards)), "grown_shard")

    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "_chunk").agg(F.count("*").alias("_n"))
    offsets = offsets.select("shard", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("shard", "_chunk").orderBy("_order", "size", "text_crc32")
    numbered = rows.withColumn("_local", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "_chunk"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_local") + F.col("_offset")).cast("bigint").alias("slot"), "grown_shard")
