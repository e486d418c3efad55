"""Embedding near-dedup: a navigable small-world graph per shard, every shard asked by every vector."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwork.llm import hnsw
from tillwork.llm.common import settle
from tillwork.llm.components import components, forest
from tillwork.operators.skew import own_exchange


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # so that no square runs out of range
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def shard_graphs(heads: DataFrame, shard_rows: int, least_shards: int) -> tuple[DataFrame, int]:
    """(dim, shard, keys, sizes, vectors, graph): the distinct vectors of a shard and its graph, as stored rows."""
    shards = max(least_shards, math.ceil(heads.count() / shard_rows))
    single = heads.schema["embedding"].dataType.elementType.typeName() == "float"

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_key", ignore_index=True)
        given = np.stack(rows["embedding"].to_numpy()).astype(np.float32 if single else np.float64)
        graph = hnsw.build(_unit(given), seed=int(key[1]))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "keys": [rows["_key"].tolist()],
                             "sizes": [rows["_size"].tolist()], "vectors": [given.tobytes()], "graph": [graph.dump()]})

    cut = heads.select("_key", "_size", "embedding", F.size("embedding").alias("dim"),
                       F.pmod(F.xxhash64(F.lit("shard"), "_key"), F.lit(shards)).cast("int").alias("shard"))
    return settle(cut.groupBy("dim", "shard").applyInPandas(
        one, "dim int, shard int, keys array<bigint>, sizes array<bigint>, vectors binary, graph binary"), "graphs"), shards


def _ask(least: float, recall: float, single: bool):
    """Rows of two shards, each two once, to (node, n, root): how many vectors a node of either links with
    in the other, and a spanning forest of these links. Links are folded as they are found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                unit = lambda raw: _unit(np.frombuffer(raw, np.float32 if single else np.float64).reshape(-1, pair["dim"]))
                mine, keys = np.array(pair["asking_keys"]), np.array(pair["keys"])
                my_sizes, sizes = np.array(pair["asking_sizes"], np.int64), np.array(pair["sizes"], np.int64)
                same = pair["asking_shard"] == pair["shard"]
                graph = hnsw.Graph.load(unit(pair["vectors"]), pair["graph"])
                found = (hnsw.links_within(graph, least, recall) if same
                         else hnsw.links_between(graph, unit(pair["asking"]), least, recall))
                mine_n, n = np.zeros(len(mine), np.int64), np.zeros(len(keys), np.int64)
                tree = np.array([], np.int64), np.array([], np.int64)
                for q, r in found:
                    np.add.at(mine_n, q, sizes[r])
                    if not same:
                        np.add.at(n, r, my_sizes[q])
                    nodes, roots = forest(np.concatenate([tree[0], mine[q]]), np.concatenate([tree[1], keys[r]]))
                    tree = nodes[nodes != roots], roots[nodes != roots]
                counted = [(mine[mine_n > 0], mine_n[mine_n > 0]), (keys[n > 0], n[n > 0])]
                node = np.concatenate([*[k for k, _ in counted], tree[0]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(np.concatenate([*[c for _, c in counted], np.zeros(len(tree[0]), np.int64)])),
                     pa.array(np.concatenate([*[k for k, _ in counted], tree[1]]))], names=["node", "n", "root"])
    return run


def near(vectors: DataFrame, least: float = 0.9, recall: float = 0.99, shard_rows: int = 100_000,
         least_shards: int = 8) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector, linked at a cosine of ``least`` or more.

    Equal vectors are one node with a size, so a group of copies is one node. Nodes are dealt to
    shards by hash; each shard's graph is built in a task and stored. Then every two shards meet once,
    the vectors of one asking the other's graph: beams widen until an audit against all its nodes reaches
    ``recall``, and where a neighbourhood fills the beam it is followed along the graph. Each pair of vectors is
    verified in double precision and counts for both ends. A task hands on counts
    and a spanning forest of its links, not the links, so a dense group costs a row per vector.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing,
    not even copies; vectors link only with those of as many components. ``component_id`` is the
    smallest vec_id reachable, its own without links; a null vec_id can be no component's id.
    Repeated rows are copies. Labels and other columns are not read.
    """
    rows = vectors.select("vec_id", "embedding")
    fine = (F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("embedding", lambda x: x != 0))
    rows = rows.withColumn("_fine", F.coalesce(fine, F.lit(False)))
    heads = settle(rows.where("_fine").groupBy("embedding").agg(
        F.count("*").alias("_size"), F.min("vec_id").alias("_first")).withColumn("_key", F.xxhash64("embedding")), "vectors")
    graphs, shards = shard_graphs(heads, shard_rows, least_shards)
    # a shard asks itself and half of the others, counted on from it, so that all have the same to ask
    ahead = F.sequence(F.lit(0), F.lit(shards // 2))
    asking = graphs.select("dim", F.col("shard").alias("asking_shard"), F.col("keys").alias("asking_keys"),
                           F.col("sizes").alias("asking_sizes"), F.col("vectors").alias("asking"), F.explode(ahead).alias("_on"))
    if shards % 2 == 0:  # two that are half a round apart would meet twice
        asking = asking.where((F.col("_on") < shards // 2) | (F.col("asking_shard") < shards // 2))
    asking = asking.withColumn("shard", F.pmod(F.col("asking_shard") + F.col("_on"), F.lit(shards))).drop("_on")
    pairs = asking.join(graphs, ["dim", "shard"]).repartition(shards * (shards // 2 + 1))
    single = heads.schema["embedding"].dataType.elementType.typeName() == "float"
    found = settle(pairs.mapInArrow(_ask(least, recall, single), "node bigint, n bigint, root bigint"), "vector-links")

    counts = found.groupBy("node").agg(F.sum("n").alias("_others"))
    roots = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (heads.join(counts, heads["_key"] == counts["node"], "left").drop("node")
             .join(roots, F.col("_key") == roots["node"], "left")
             .select("embedding", "_key", "_size", "_first", "_others", F.coalesce("root", "_key").alias("_root")))
    smallest = known.groupBy("_root").agg(F.min("_first").alias("_component"))
    known = settle(known.join(smallest, "_root").select(
        F.col("embedding").alias("_of"), F.col("_key").alias("_k"),
        (F.col("_size") - 1 + F.coalesce("_others", F.lit(0))).alias("_links"), "_component"), "vector-heads")
    at = F.when(F.col("_fine"), F.xxhash64("embedding"))
    joined = rows.withColumn("_key", at).join(own_exchange(known, "_k"), F.col("_key") == F.col("_k"), "left")
    joined = joined.where(F.col("_k").isNull() | (F.col("embedding") == F.col("_of")))
    component = F.when(F.col("_k").isNull(), F.col("vec_id")).otherwise(F.col("_component"))
    return joined.select("vec_id", F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
