"""The prefix trie of conversations: a count-min screen, then exact grouping of what may be shared."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillwork.llm.common import positions, ranged, running_sums, settle, turn_digest
from tillwork.operators.skew import own_exchange

_DEPTHS = 4          # hash rows of the sketch: the four 32-bit parts of a prefix digest
_BLOCK = 1 << 16     # cells of a sketch row that are merged together
_LOW = 0xFFFFFFFF
_NONE = hashlib.sha256(b"").hexdigest()


def rebuild(conversations: DataFrame) -> DataFrame:
    """(conv, depth, digest, bytes, len): every turn of every rebuilt conversation, texts as digests.

    Positions come from a range split by (conversation, turn, digest), so no task has to hold a
    conversation; at most eight turns of a base conversation go to the others of its five.
    """
    turns = settle(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("_turn"), turn_digest().alias("digest"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("bytes")), "turns")
    placed = settle(positions(ranged(turns, ["conv"], ["_turn", "digest"], "ordered-turns"), ["conv"], "pos"), "placed-turns")
    head = F.crc32(F.col("conv").cast("string")) % 9
    base = F.col("conv") - F.col("conv") % 5
    convs = placed.where("pos = 0").select("conv", "_n", head.alias("_h"), base.alias("_b"))
    bases = convs.select(F.col("conv").alias("_b"), F.col("_n").alias("_base"))
    taken = F.least("_h", F.coalesce("_base", F.lit(0)))
    convs = settle(convs.join(bases, "_b", "left").select(
        "conv", "_b", "_h", taken.alias("_taken"), (taken + F.greatest(F.col("_n") - F.col("_h"), F.lit(0))).alias("len")), "conversations")
    heads = placed.where("pos < 8").select(F.col("conv").alias("_b"), "pos", "digest", "bytes")
    first = (convs.join(heads, "_b").where("pos < _h")
             .select("conv", (F.col("pos") + 1).alias("depth"), "digest", "bytes", "len"))
    own = (placed.join(convs, "conv").where("pos >= _h")
           .select("conv", (F.col("pos") - F.col("_h") + F.col("_taken") + 1).alias("depth"), "digest", "bytes", "len"))
    turnless = convs.where("len = 0").select("conv", F.lit(0).cast("bigint").alias("depth"),
                                             F.lit(None).cast("string").alias("digest"), F.lit(0).cast("bigint").alias("bytes"), "len")
    return first.unionByName(own).unionByName(turnless)


def _parts(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(_DEPTHS)]


def prefixes(turns: DataFrame) -> DataFrame:
    """Adds the digest of the prefix that ends at each turn (``a``, ``b``) and of the one before (``pa``, ``pb``).

    A prefix's digest is the sum of its turns' 128-bit digests, each taken with its place, so it comes
    from running sums and a conversation of any length is cut into chunks. The empty prefix is 0, 0.
    """
    placed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")))
    terms = turns.withColumns({f"_t{i}": F.coalesce(p, F.lit(0)) for i, p in enumerate(_parts(placed))})
    summed = running_sums(terms, "conv", "depth", {f"_s{i}": F.col(f"_t{i}") for i in range(_DEPTHS)})
    low = lambda c: c.bitwiseAND(F.lit(_LOW))
    pair = lambda x, y: F.shiftleft(low(x), 32).bitwiseOR(low(y))
    now, before = ([F.col(f"_s{i}") - (F.col(f"_t{i}") if back else F.lit(0)) for i in range(_DEPTHS)] for back in (False, True))
    return summed.select("conv", "depth", "bytes", "len", pair(now[0], now[1]).alias("a"), pair(now[2], now[3]).alias("b"),
                         pair(before[0], before[1]).alias("pa"), pair(before[2], before[3]).alias("pb"))


def _cells(a: np.ndarray, b: np.ndarray, width: int) -> list[np.ndarray]:
    a, b = a.view(np.uint64), b.view(np.uint64)
    return [(x & np.uint64(width - 1)).astype(np.int64) for x in (a >> np.uint64(32), a, b >> np.uint64(32), b)]


def _numpy(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


class Sketch:
    """A count-min sketch whose counters stop at two: two bits a cell, ``_DEPTHS`` rows of ``width`` cells."""

    def __init__(self, width: int, blocks: dict[int, tuple[bytes, bytes]]):
        size = width // 8
        self.width = width
        self.bits = []
        for row in range(_DEPTHS):
            twice = np.zeros(size, np.uint8)
            for k in range(width // _BLOCK):
                found = blocks.get(row * (width // _BLOCK) + k)
                if found:
                    twice[k * _BLOCK // 8:(k + 1) * _BLOCK // 8] = np.frombuffer(zlib.decompress(found[1]), np.uint8)
            self.bits.append(twice)

    def alone(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether some counter of a prefix that was counted says one: it then has one member."""
        many = np.ones(len(a), bool)
        for bits, cell in zip(self.bits, _cells(a, b, self.width), strict=True):
            many &= (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return ~many


def sketch(found: DataFrame, most_cells: int = 1 << 25) -> Sketch:
    """Counts all prefixes. Every task counts its own rows; equal blocks of cells are then merged.

    A row has four cells a prefix, ``most_cells`` at most, so what reaches the driver and is sent to
    the tasks has at most most_cells bytes (two bits in four rows). Beyond that more prefixes look
    shared and are grouped exactly; results stay the same.
    """
    rows, width = found.count(), _BLOCK
    while width < min(4 * rows, most_cells):
        width *= 2
    per_row = width // _BLOCK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = {}, {}
        for batch in batches:
            a, b = _numpy(batch, "a", "b")
            for row, cell in enumerate(_cells(a, b, width)):
                cells, n = np.unique(cell, return_counts=True)
                block = cells // _BLOCK
                for k in np.unique(block):
                    at, key = block == k, row * per_row + int(k)
                    if key not in once:
                        once[key], twice[key] = np.zeros(_BLOCK, bool), np.zeros(_BLOCK, bool)
                    inside = cells[at] % _BLOCK
                    twice[key][inside] |= (n[at] > 1) | once[key][inside]
                    once[key][inside] = True
        yield _blocks(once, twice)

    def _blocks(once: dict, twice: dict) -> pa.RecordBatch:
        pack = lambda bits: zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
        keys = list(once)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([pack(once[k]) for k in keys], pa.binary()),
                                           pa.array([pack(twice[k]) for k in keys], pa.binary())], names=["block", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = {}, {}
        unpack = lambda raw: np.unpackbits(np.frombuffer(zlib.decompress(raw), np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            for key, o, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                o, t = unpack(o), unpack(t)
                if key in once:
                    t |= twice[key] | (o & once[key])
                    o |= once[key]
                once[key], twice[key] = o, t
        yield _blocks(once, twice)

    kind = "block long, once binary, twice binary"
    merged = found.where("depth > 0").select("a", "b").mapInArrow(count, kind).repartition("block").mapInArrow(merge, kind)
    return Sketch(width, {r["block"]: (r["once"], r["twice"]) for r in merged.collect()})


def screen(found: DataFrame, seen: Sketch) -> DataFrame:
    """Adds ``alone``: this prefix has one member for certain; ``after``: so has the one before it."""
    shared = found.sparkSession.sparkContext.broadcast(seen)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, pa_, pb, depth = _numpy(batch, "a", "b", "pa", "pb", "depth")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shared.value.alone(a, b) & (depth > 0)), pa.array(shared.value.alone(pa_, pb) & (depth > 1))],
                names=[*batch.schema.names, "alone", "after"])

    flags = [T.StructField(name, T.BooleanType()) for name in ("alone", "after")]
    return found.mapInArrow(work, T.StructType([*found.schema.fields, *flags]))


def member_digests(ends: DataFrame, chars: int = 1 << 20) -> DataFrame:
    """(a, b, ends_sha256): the hash of each node's members (``conv``), ascending and comma-joined.

    Members are ordered by a range split, so a node with very many is spread over tasks; each writes
    its stretch as texts of about ``chars`` characters, and these go through the hash one by one.
    """
    placed = ranged(ends.select("a", "b", "conv"), ["a", "b"], ["conv"], "ends")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
                                               pa.array([first], pa.int64()), pa.array([",".join(ids)])], names=["a", "b", "first", "ids"])

        for batch in batches:
            for a, b, part, conv in zip(*[batch.column(n).to_pylist() for n in ("a", "b", "_part", "conv")], strict=True):
                # a task may read several parts, and another task those between them
                if key != (a, b, part) or size >= chars:
                    if ids:
                        yield piece()
                    key, first, ids, size = (a, b, part), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for batch in batches:
            for a, b, ids in zip(*[batch.column(n).to_pylist() for n in ("a", "b", "ids")], strict=True):
                if key != (a, b):
                    if key:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if len(done) > 10_000:
                yield _members(done)
                done = []
        if key:
            done.append((*key, digest.hexdigest()))
        yield _members(done)

    pieces = (placed.sortWithinPartitions("_at").select("a", "b", "_part", "conv")
              .mapInArrow(join, "a long, b long, first long, ids string"))
    return (pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first")
            .mapInArrow(fold, "a long, b long, ends_sha256 string"))


def _members(done: list[tuple]) -> pa.RecordBatch:
    a, b, digests = zip(*done) if done else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digests, pa.string())],
                                      names=["a", "b", "ends_sha256"])


def nodes(conversations: DataFrame, most_cells: int = 1 << 25) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; (conv_id, depth) names a node.

    Each conversation c takes the first crc32(c) % 9 turns of conversation c - c % 5, then its own after as many.
    Prefixes that the sketch proves to have one member are result rows where they lie, without a
    shuffle of theirs; the others are grouped by digest. A node's subtree is summed along conversations: its
    smallest member carries what is below it, so every leaf and saving is counted once in each node above it.

    Turns go by turn, null first, then by the digest of role and text; a null role or text is empty,
    repeated rows are turns of their own. Rows without conv_id belong to no conversation. No conversations, no
    rows: not even the root. Prefixes are told apart by 128-bit digests. Other columns are not read.
    """
    found = settle(prefixes(rebuild(conversations)), "prefixes")
    flagged = settle(screen(found, sketch(found, most_cells)), "screened")
    total, low = flagged.where("depth = 1 OR len = 0").agg(F.count("*"), F.min("conv")).first()
    alone, shared = flagged.where("alone"), flagged.where("depth > 0 AND NOT alone")

    ending = F.col("depth") == F.col("len")
    exact = settle(shared.groupBy("a", "b").agg(
        F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.min("bytes").alias("bytes"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb")), "shared-nodes")
    children = settle(exact.select("pa", "pb").union(alone.where("NOT after").select("pa", "pb"))
                      .groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children")), "children")
    exact = settle(exact.join(children, ["a", "b"], "left").na.fill(0, ["n_children"]), "shared-nodes")
    members = settle(member_digests(flagged.where("depth = len AND NOT alone")), "members")

    # what a node adds to itself and all above it, at its smallest member
    adds = exact.select("conv", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                        (F.col("n_children") == 0).cast("bigint").alias("leaf")).where("saved > 0 OR leaf > 0")
    adds = adds.union(alone.where(ending).select("conv", "depth", F.lit(0).cast("bigint"), F.lit(1).cast("bigint")))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    along = adds.withColumns({"a": none, "b": none}).unionByName(
        shared.select("conv", "depth", zero.alias("saved"), zero.alias("leaf"), "a", "b"))
    below = running_sums(along.withColumn("_up", -F.col("depth")), "conv", "_up",
                         {"saved_tokens": F.col("saved"), "n_leaves": F.col("leaf")})
    below = (below.where("a IS NOT NULL AND (saved_tokens > 0 OR n_leaves > 0)").groupBy("a", "b")
             .agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves")))

    parents = exact.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("_parent"))
    with_parent = lambda rows: rows.join(own_exchange(parents, "pa", "pb"), ["pa", "pb"], "left")
    root = F.when(F.col("depth") == 1, F.lit(low))
    empty = F.lit(_NONE)
    one = lambda rows, parent: rows.select(
        F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
        (~ending).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(ending, F.sha2(F.col("conv").cast("string"), 256)).otherwise(empty).alias("ends_sha256"))
    tails = one(alone.where("after OR depth = 1"), F.coalesce(root, F.col("conv")))
    forks = one(with_parent(alone.where("NOT after AND depth > 1")), F.col("_parent"))
    # below a prefix proven to have one member there is no shared parent: that member is the parent's too
    grouped = (with_parent(exact).join(below, ["a", "b"], "left").join(members, ["a", "b"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.coalesce(root, F.col("_parent"), F.col("conv")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256")))
    result = tails.union(forks).union(grouped)
    if not total:
        return result

    leaves, saved = adds.agg(F.sum("leaf"), F.sum("saved")).first()
    kids = children.where("a = 0 AND b = 0").first()
    turnless = members.where("a = 0 AND b = 0").first()
    top = conversations.sparkSession.createDataFrame(
        [(low, 0, None, total, kids["n_children"] if kids else 0, leaves or 1, saved or 0,
          turnless["ends_sha256"] if turnless else _NONE)], result.schema)
    return result.union(top)
