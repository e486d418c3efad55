"""Mixing sources to target weights: equal blocks of words apportioned by highest quotients."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwork.llm.common import packed, settle, source_key, unpacked, with_columns


def _sizes(found: list[str]) -> list[int]:
    return [len(t.encode().split()) for t in found]


def sized(rows: DataFrame) -> DataFrame:
    """``packed`` rows and ``size``, the number of words of each text (null: 0)."""
    return with_columns(rows, {"size": ("long", pa.int64(), _sizes)})


def apportion(parties: DataFrame, keys: list[str], party: str, votes: str, seats: str, name: str) -> DataFrame:
    """Adds Sainte-Lague seats: each next seat goes to the highest votes / (2 * held + 1).

    Within each ``keys`` group; ``seats`` holds the group's total in every row. Starts from the
    rounded exact shares, which are the right seats but for a few, and settles the difference
    by ranking the quotients that could be next. Lowering the divisor until the missing e
    seats are given adds at most votes * (e + n) / total + 1 to a party of n, so that many
    candidates each are enough. Ties fall by ``party``.
    """
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    start = (parties.withColumn("_all", F.sum(votes).over(group))
             .withColumn("_q", F.coalesce(F.floor(F.try_divide(F.col(votes) * F.col(seats), F.col("_all")) + 0.5),
                                          F.lit(0)).cast("bigint"))
             .withColumn("_e", F.when(F.col("_all") > 0, F.col(seats) - F.sum("_q").over(group)).otherwise(F.lit(0)))
             .withColumn("_n", F.count("*").over(group)))
    reach = (F.ceil(F.try_divide(F.col(votes) * (F.abs("_e") + F.col("_n")), F.col("_all"))) + 1).cast("int")
    more = start.where(F.col("_e") != 0).withColumn("_j", F.explode(F.sequence(F.lit(1), reach)))
    seat = F.when(F.col("_e") > 0, F.col("_q") + F.col("_j")).otherwise(F.col("_q") - F.col("_j") + 1)
    more = more.withColumn("_seat", seat).where("_seat >= 1")
    quotient = F.col(votes) / (2 * F.col("_seat") - 1) * F.signum(F.col("_e"))
    ranks = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ranked = more.withColumn("_rank", F.row_number().over(ranks.orderBy(
        F.desc(quotient), F.when(F.col("_e") > 0, F.col(party)).asc(), F.when(F.col("_e") < 0, F.col(party)).desc())))
    change = (ranked.where(F.col("_rank") <= F.abs("_e")).groupBy(*keys, party)
              .agg(F.sum(F.signum("_e")).cast("bigint").alias("_change")))
    return (start.join(change, [*keys, party], "left")
            .withColumn(name, F.col("_q") + F.coalesce("_change", F.lit(0)))
            .drop("_all", "_q", "_e", "_n", "_change"))


def targets(sources: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """Adds ``target``: shares of all words by weight, none above ``repeats`` times its source.

    Sources take the weights in turn, in code point order with null last. Resharing what
    capped sources leave until none is above its cap ends at one level: everybody gets
    min(cap, weight * level). Sorted by cap / weight the capped ones come first, so the level
    follows from running sums. The windows hold one row per source.
    """
    one = Window.partitionBy(F.lit(0))
    turn = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1
    at = F.pmod(turn, F.lit(len(weights))).cast("int") + 1
    s = (sources.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at))
         .withColumn("_cap", F.col("source_size") * F.lit(float(repeats))))
    ratio = F.col("_cap") / F.col("_w")
    earlier = one.orderBy(ratio, "_key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(one) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))
    open_w = F.sum("_w").over(one) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0))
    s = s.withColumn("_ratio", ratio).withColumn("_level", left / open_w)
    level = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_level"))).over(one)["_level"]
    return (s.withColumn("target", F.least("_cap", F.col("_w") * F.coalesce(level, F.lit(0.0))))
            .drop("_w", "_cap", "_ratio", "_level"))


def _overlap(start: Column, end: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, hi) - F.greatest(start, lo))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3, seed: int = 17,
        docs_per_shard: int = 1000, largest_block: int = 256) -> DataFrame:
    """How many words of each document a mix of the sources by weight takes.

    Returns doc_id, source, size, source_size, target, source_blocks, block_words, taken: one row
    per document. The whole mix has as many words as the table. It is given out in equal blocks
    of words: first to the sources, then each source's blocks to its shards, both by highest
    quotients. A shard's documents stand in seeded order as one ring of words cut into blocks;
    its quota takes full rounds of the ring, then the blocks that follow a seeded one. A block
    that straddles documents takes a part of each.

    Shards hold about ``docs_per_shard`` documents each, so a source with a third of all rows
    is many shards. A block is a 64th of the smallest target, at least 1 and at most
    ``largest_block`` words, so every source comes within about a block of its target.

    Null source: a source of its own. Null or empty text: size 0, nothing taken. Null or
    repeated ids are rows like others. Without any word all targets and takings are 0.
    """
    words = sized(packed(docs.select("doc_id", "source", "text"))).select("row.doc_id", "row.source", "size")
    words = settle(words.withColumn("_key", source_key("source")), "mix-words")
    sources = (words.groupBy("_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"),
                                         F.count("*").alias("_docs")))
    sources = targets(sources, weights, repeats)
    one = Window.partitionBy(F.lit(0))
    block = F.greatest(F.lit(1), F.least(F.lit(largest_block), F.floor(F.min(F.when(
        F.col("target") >= 1, F.col("target"))).over(one) / 64))).cast("bigint")
    sources = sources.withColumn("block_words", F.coalesce(block, F.lit(1)))
    sources = sources.withColumn("_seats", F.round(F.sum("target").over(one) / F.col("block_words")).cast("bigint"))
    sources = apportion(sources, [], "_key", "target", "_seats", "source_blocks").drop("_seats")
    sources = sources.withColumn("_shards", F.ceil(F.col("_docs") / docs_per_shard).cast("bigint"))
    sources = settle(sources, "mix-sources")

    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    placed = (words.drop("source").join(sources, "_key")
              .withColumn("_draw", draw).withColumn("_shard", F.pmod("_draw", F.col("_shards"))))
    shards = placed.groupBy("_key", "_shard").agg(
        F.sum("size").alias("_ring"), F.first("source_blocks").alias("source_blocks"),
        F.first("block_words").alias("block_words"))
    shards = apportion(shards, ["_key"], "_shard", "_ring", "source_blocks", "_blocks")
    quota = F.least(F.col("_blocks") * F.col("block_words"), F.lit(repeats) * F.col("_ring"))
    first = F.pmod(F.xxhash64(F.lit(seed), "_key", "_shard"),
                   F.greatest(F.lit(1), F.call_function("div", F.col("_ring"), F.col("block_words"))))
    shards = shards.select("_key", "_shard", "_ring", quota.alias("_quota"),
                           (first * F.col("block_words")).alias("_lo"))

    ring = Window.partitionBy("_key", "_shard").orderBy("_draw", "doc_id", "size")
    placed = placed.withColumn("_end", F.sum("size").over(ring.rowsBetween(Window.unboundedPreceding, 0)))
    joined = placed.join(shards, ["_key", "_shard"])
    rounds = F.coalesce(F.try_divide(F.col("_quota") - F.col("_quota") % F.col("_ring"), F.col("_ring")), F.lit(0))
    start, end = F.col("_end") - F.col("size"), F.col("_end")
    hi = F.col("_lo") + F.when(F.col("_ring") > 0, F.col("_quota") % F.col("_ring")).otherwise(F.lit(0))
    taken = (rounds * F.col("size") + _overlap(start, end, F.col("_lo"), F.least(hi, F.col("_ring")))
             + _overlap(start, end, F.lit(0), hi - F.col("_ring")))
    return joined.select("doc_id", "source", "size", "source_size", "target", "source_blocks", "block_words",
                         taken.cast("bigint").alias("taken"))


def apply_mix(docs: DataFrame, **how) -> DataFrame:
    """The documents as often as the mix takes them: taken / size times, rounded.

    Only documents at the two ends of a shard's run of blocks are taken in part, so rounding
    moves a source by less than a document per shard. A document without words has nothing
    to mix and stays once. Copies are equal rows. Columns are those of ``docs``.
    """
    takings = (mix(docs, **how).groupBy(F.col("doc_id").alias("_id"), source_key("source").alias("_k"),
                                        F.col("size").alias("_size"))
               .agg(F.avg("taken").alias("_taken")))
    on = [F.col("row.doc_id").eqNullSafe(F.col("_id")), source_key("row.source") == F.col("_k"),
          F.col("size") == F.col("_size")]
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.round(F.col("_taken") / F.col("size"))).cast("int")
    many = sized(packed(docs)).join(takings, on).withColumn("_times", times).where("_times > 0")
    return unpacked(many.select("row", F.explode(F.sequence(F.lit(1), F.col("_times")))))
