"""A Merkle manifest of a dataset, level by level, by self-joins on computed sibling indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwork.llm.common import positions, ranged, settle

#: Digests are stored as 32 bytes and hashed as hex text.
_NODE = "binary"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _hash(*texts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*texts), 256))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    return _hash(*map(_field, fields))


def _count(n: Column, arity: int, level: int) -> Column:
    """How many nodes a tree of n leaves has at a level."""
    return F.call_function("div", n + F.lit(arity ** level - 1), F.lit(arity ** level))


def _parent(arity: int) -> Column:
    return F.call_function("div", F.col("idx"), F.lit(arity))


def with_siblings(nodes: DataFrame, arity: int = 2) -> DataFrame:
    """Adds ``run``: the digests of a node's run by slot, its own empty, absent ones null.

    Siblings come by equijoins of the level with itself on (tree, index): the index's lowest bit
    flipped for two slots, otherwise one join for each offset around the run. Indices are unique
    in a tree, so no key is hot.
    """
    slot = F.pmod(F.col("idx"), F.lit(arity))
    other = nodes.select("tree", "idx", "node")
    joined = nodes
    for offset in range(1, arity):
        if arity == 2:
            there = F.col("idx").bitwiseXOR(F.lit(1).cast("bigint"))
        else:  # where the row that is ``offset`` slots before this one, around the run, looks
            there = F.col("idx") - slot + F.pmod(slot - offset, F.lit(arity))
        found = other.select("tree", there.alias("idx"), F.col("node").alias(f"_s{offset}"))
        joined = joined.join(found, ["tree", "idx"], "left")
    around = [F.unhex(F.lit("")), *[F.col(f"_s{o}") for o in range(1, arity)]]
    at = lambda s: F.element_at(F.array(*around), (F.pmod(F.lit(s) - slot, F.lit(arity)) + 1).cast("int"))
    return joined.select(*nodes.columns, F.array(*[at(s) for s in range(arity)]).alias("run"))


def _joined(run: Column, own: Column, arity: int) -> Column:
    """A run's digests as hex text from left to right, ``own`` (hex) in the empty slot."""
    return F.concat(*[F.when(F.length(run[s]) == 0, own).otherwise(F.coalesce(_hex(run[s]), F.lit(""))) for s in range(arity)])


def climb(nodes: DataFrame, levels: int, arity: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels with their runs, lowest first, and (tree, node) of the roots.

    ``nodes`` has tree, idx (from 0, no gaps), n (leaves of the tree) and node. Each level is stored;
    the rows in slot zero of a run emit the parents. A tree leaves where it has one node left.
    """
    stored, roots = [], nodes.where("n = 1").select("tree", "node")
    for level in range(levels):
        here = settle(with_siblings(nodes.where(_count(F.col("n"), arity, level) > 1), arity), f"{label}-{level}")
        stored.append(here)
        up = here.where(F.pmod(F.col("idx"), F.lit(arity)) == 0)
        nodes = up.select("tree", _parent(arity).alias("idx"), "n",
                          F.unhex(F.sha2(_joined(F.col("run"), _hex(F.col("node")), arity), 256)).alias("node"))
        roots = roots.union(nodes.where(_count(F.col("n"), arity, level + 1) == 1).select("tree", "node"))
    return stored, roots


def descend(stored: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """For the parents of the lowest level: tree, up (their index), path and what ``tops`` carries.

    ``tops`` has a row per tree: tree, n, path (the runs above its root) and more. From the top
    level down every node takes its parent's path behind its own run, by one join a level, so a
    level ships as many paths as it has parents.
    """
    extra = [c for c in tops.columns if c not in ("tree", "n", "path")]
    ends = lambda level: tops.where(  # noqa: E731  (trees whose single node stands here; below it, of one leaf too)
        (_count(F.col("n"), arity, level) == 1) & ((_count(F.col("n"), arity, level - 1) > 1) | F.lit(level == 1))
    ).select("tree", F.lit(0).cast("bigint").alias("up"), "path", *extra)
    above = ends(max(len(stored), 1))
    for level in range(len(stored) - 1, 0, -1):
        here = stored[level].select("tree", F.col("idx").alias("_idx"), "run", _parent(arity).alias("up"))
        below = here.join(above, ["tree", "up"]).select(
            "tree", F.col("_idx").alias("up"), F.concat("run", "path").alias("path"), *extra)
        above = below.union(ends(level))
    return above


def fold(leaf: Column, path: Column, arity: int) -> Column:
    """The root, as hex text, that a leaf (hex) and the runs above it lead to."""
    steps = F.call_function("div", F.size(path), F.lit(arity)).cast("int")
    levels = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))
    def step(digest: Column, level: Column) -> Column:
        return F.sha2(_joined(F.slice(path, level * arity + 1, F.lit(arity)), digest, arity), 256)

    return F.aggregate(levels, leaf, step)


def _levels(n: int | None, arity: int) -> int:
    levels = 0
    while n is not None and n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def manifest(docs: DataFrame, arity: int = 2) -> DataFrame:
    """Every document's leaf, its tree's and the dataset's root, its proof, and a check against tampering.

    A leaf hashes doc_id, source, lang, n_chars and text. Leaves of a language ascend by doc_id and
    make its subroot; subroots, ordered by language, make the root. ``proof_sha256`` hashes a leaf's
    siblings from the bottom to the root. Where 7 divides the CRC-32 of doc_id a tampered copy of the row has
    n_chars one higher; ``folded_root`` is what the row as it then is folds up to, ``verified`` whether that is the root.

    A null language is a language, before all others; a null doc_id comes first in its language and is
    never tampered with, nor is a null n_chars. Rows that share a doc_id ascend by leaf; equal rows
    share their places in any order. A lone document is subroot, and root if it is the only one: its proof hashes
    nothing. Texts are hashed whole, where they lie. No rows give no rows; other columns are not read.
    """
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    fields = {c: F.col(c) for c in columns}
    forged = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    hashed = settle(docs.select("lang", "doc_id", leaf_of(list(fields.values())).alias("node"),
                                F.when(hit, leaf_of(list(forged.values()))).alias("forged")), "leaves")
    placed = positions(ranged(hashed, ["lang"], ["doc_id", "node"], "ordered-leaves"), ["lang"], "idx")

    langs = positions(ranged(placed.groupBy("lang").agg(F.max("_n").alias("n")), [], ["lang"], "languages"), [], "tree")
    langs = settle(langs, "trees")
    most, trees = langs.agg(F.max("n"), F.max("_n")).first()
    leaves = placed.join(langs.select(F.col("lang").alias("_lang"), "tree", "n"), F.col("lang").eqNullSafe(F.col("_lang")))
    leaves = settle(leaves.select("tree", "idx", "n", "node", "doc_id", "forged"), "placed-leaves")

    stored, subroots = climb(leaves, _levels(most, arity), arity, "level")
    subroots = settle(subroots.join(langs, "tree").select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"),
                                                          F.col("_n").alias("n"), "node", F.col("n").alias("leaves")), "subroots")
    joined, root = climb(subroots, _levels(trees, arity), arity, "subroot-level")
    none = F.array().cast(f"array<{_NODE}>")
    top = root.select("tree", F.lit(trees or 0).cast("bigint").alias("n"), none.alias("path"), F.col("node").alias("root"))
    tops = _paths(subroots, joined, top, arity).select(
        F.col("idx").alias("tree"), F.col("leaves").alias("n"), "path", F.col("node").alias("subroot"), "root")

    found = _paths(leaves, stored, settle(tops, "subroot-paths"), arity)
    leaf, path = _hex(F.col("node")), F.col("path")
    proof = F.sha2(F.array_join(F.transform(path, _hex), ""), 256)
    result = found.select("doc_id", leaf.alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
                          proof.alias("proof_sha256"),
                          fold(_hex(F.coalesce("forged", "node")), path, arity).alias("folded_root"))
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))


def _paths(nodes: DataFrame, stored: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The nodes with the runs from theirs up to the root, and what ``tops`` carries.

    A lone node has no run of its own, only what is above its tree.
    """
    above = descend(stored, tops, arity)
    alone = nodes.where("n = 1").withColumn("run", F.array().cast(f"array<{_NODE}>"))
    lowest = stored[0].select(*alone.columns).union(alone) if stored else alone
    return (lowest.withColumn("up", _parent(arity)).join(above, ["tree", "up"])
            .withColumn("path", F.concat("run", "path")).drop("run", "up"))
