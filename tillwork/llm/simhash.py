"""SimHash near-dedup: fingerprints, then a generalised pigeonhole join on Hamming distance."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.common import LOWER, packed, settle, unpacked, with_columns
from tillwork.llm.components import components


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """64 bits, each set if set in more than half of the shingles' hashes; 0 without words."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(itertools.accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    if len(words) <= shingle:
        hashes = [hashed(joined, seed)]
    else:
        hashes = [hashed(joined[a:b - 1], seed) for a, b in zip(starts, ends[shingle - 1:])]
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_ = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(set_, bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``packed`` rows and ``_fp``, the fingerprint as a signed 64-bit number."""
    return with_columns(packed(docs), {"_fp": ("long", pa.int64(), lambda found: [_signed(fingerprint(t)) for t in found])})


@dataclass(frozen=True)
class Part:
    """A group of bits, and how many of them may differ for a candidate."""
    mask: int
    threshold: int

    def flips(self) -> list[int]:
        """What to xor with a value to reach every value within the threshold."""
        bits = [1 << b for b in range(64) if self.mask >> b & 1]
        return [_signed(sum(c)) for t in range(self.threshold + 1) for c in itertools.combinations(bits, t)]


def _bit_counts(fps: DataFrame) -> np.ndarray:
    """How often bits i and j are both set, over all fingerprints: 64 x 64 sums."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("_fp").to_numpy(zero_copy_only=False)).view(np.uint8)
            x = np.unpackbits(raw.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel())], names=["cell", "n"])

    out = np.zeros(4096)
    for cell, n in fps.select("_fp").mapInArrow(work, "cell long, n double").groupBy("cell").agg(F.sum("n")).collect():
        out[cell] = n
    return out.reshape(64, 64)


def _groups(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m groups of bits: each starts from the most correlated pair left and takes the closest bit until full."""
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    like = np.abs(both / n - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = set(range(64)), []
    for width in [64 // m + (k < 64 % m) for k in range(m)]:
        a, b = max(itertools.combinations(sorted(left), 2), key=lambda ab: like[ab]) if width > 1 else (min(left),) * 2
        group = list(dict.fromkeys((a, b)))
        left -= set(group)
        while len(group) < width:
            group.append(max(sorted(left), key=lambda x: like[x, group].mean()))
            left.remove(group[-1])
        groups.append(group)
    return groups


def plan(both: np.ndarray, n: int, most: int = 4, compared: float = 0.05) -> list[Part]:
    """The partitions and thresholds with the least estimated work per fingerprint.

    Pigeonhole: if the thresholds of m parts add up to most - m + 1, two fingerprints that differ
    in at most ``most`` bits are within the threshold in some part (-1 leaves a part out). The work
    of a part is its rows in the index, its probes, and ``compared`` times its candidates, whose
    number follows from how often each bit differs between two fingerprints. Dynamic programming
    over the parts shares the thresholds out; the number of parts with the least total wins.
    """
    best: tuple[float, list[Part]] | None = None
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    for m in range(2, most + 2):
        groups, total = _groups(both, max(n, 1), m), most - m + 1
        costs = []
        for group in groups:
            chance = np.array([1.0])
            for b in group:  # of the number of bits that differ
                chance = np.convolve(chance, [1 - differ[b], differ[b]])
            probes = np.cumsum([float(len(list(itertools.combinations(group, t)))) if t < 3 else np.inf
                                for t in range(most + 1)])
            costs.append([0.0, *(1 + probes[t] + compared * n * chance[:t + 1].sum() for t in range(most + 1))])
        # least work of the first parts by the sum of their thresholds, each from -1 to most
        sums: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            nxt: dict[int, tuple[float, list[int]]] = {}
            for s, (w, ts) in sums.items():
                for t in range(-1, most + 1):
                    if s + t not in nxt or w + cost[t + 1] < nxt[s + t][0]:
                        nxt[s + t] = (w + cost[t + 1], [*ts, t])
            sums = nxt
        work, ts = sums[total]
        if best is None or work < best[0]:
            masks = [sum(1 << b for b in g) for g in groups]
            best = work, [Part(mask, t) for mask, t in zip(masks, ts, strict=True) if t >= 0]
    return best[1]


def close_pairs(fps: DataFrame, most: int = 4) -> DataFrame:
    """All pairs a < b of the distinct ``_fp`` values that differ in at most ``most`` bits, each once."""
    parts = plan(_bit_counts(fps), fps.count(), most)
    number = lambda x: F.lit(_signed(x)).cast("bigint")
    index = fps.select(F.col("_fp").alias("b"), F.posexplode(F.array(
        *[F.col("_fp").bitwiseAND(number(p.mask)) for p in parts])).alias("_part", "_value"))
    def near(p: Part):
        flips = F.array(*[F.lit(f).cast("bigint") for f in p.flips()])
        return F.transform(flips, lambda f: F.col("_fp").bitwiseAND(number(p.mask)).bitwiseXOR(f))

    probes = fps.select(F.col("_fp").alias("a"), F.posexplode(F.array(*map(near, parts))).alias("_part", "_values"))
    probes = probes.select("a", "_part", F.explode("_values").alias("_value"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    # a pair may meet in several parts: the first one that it meets in has it
    first = F.coalesce(*[F.when(F.bit_count(differ.bitwiseAND(number(p.mask))) <= p.threshold, F.lit(i))
                         for i, p in enumerate(parts)])
    on = [index["_part"] == probes["_part"], index["_value"] == probes["_value"],
          F.col("a") < F.col("b"), F.bit_count(differ) <= most, probes["_part"] == first]
    return probes.join(index, on).select("a", "b")


def classes(docs: DataFrame, most: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable by links.

    Fingerprints that differ in at most ``most`` bits link. Equal fingerprints are one row of the
    join, so a group of copies costs one row. A null or empty text has fingerprint 0, linked
    like any other. A null doc_id is a row like others but never a component's id, unless the
    component has no other (then null). Repeated rows each come back. Other columns are not read.
    """
    rows = settle(with_fingerprints(docs.select("doc_id", "text")).select("row.doc_id", "_fp"), "fingerprints")
    heads = settle(rows.groupBy("_fp").agg(F.min("doc_id").alias("_first")), "fingerprint-heads")
    roots = components(close_pairs(heads, most))
    rooted = heads.join(roots, heads["_fp"] == roots["node"], "left").select(
        "_fp", "_first", F.coalesce("root", "_fp").alias("_root"))
    smallest = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    by_print = settle(rooted.join(smallest, "_root").select("_fp", "component_id"), "fingerprint-components")
    return rows.join(by_print, "_fp").select(
        "doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, most: int = 4) -> DataFrame:
    """The documents without near copies: of each component the row with its smallest doc_id.

    Of repeated rows with that id one stays: that with the smallest fingerprint, any of equal
    ones. Rows with a null doc_id stay only where their component has no other, one for each
    fingerprint. Columns are those of ``docs``.
    """
    found = classes(docs, most).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = settle(found.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_n")), "kept-ids")
    single = unpacked(packed(docs).join(kept.where("_n = 1 AND _id IS NOT NULL"), F.col("row.doc_id") == F.col("_id"),
                                        "left_semi"))
    rest = kept.where("_n > 1 OR _id IS NULL")
    if not rest.limit(1).count():
        return single
    prints = found.groupBy(F.col("doc_id").alias("_id"), F.when(F.col("doc_id").isNull(), F.col("fingerprint"))).agg(
        F.min("fingerprint").alias("_print")).select("_id", "_print")
    prints = prints.join(rest.select(F.col("_id").alias("_rest")), F.col("_id").eqNullSafe(F.col("_rest")), "left_semi")
    hexed = F.lpad(F.lower(F.hex("_fp")), 16, "0")
    repeated = (with_fingerprints(docs)
                .join(prints, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (hexed == F.col("_print")))
                .dropDuplicates(["_id", "_print"]))
    return single.union(unpacked(repeated))
