"""What a running import has accepted so far: keys in Parquet segments, each with a Bloom filter."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillwork.functions.text import match_key
from tillwork.sources.storage import exists, remove

Segment = tuple[int, int]  # batches from, up to but without
BASE: Segment = (-1, 0)    # what was there before the first batch

_FILTER = T.StructType([T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])


def live(batches: int, fan: int) -> list[Segment]:
    """The segments that hold batches 0 to batches - 1: sizes are powers of ``fan``, the largest first.

    It follows from the number alone, so a batch that is replayed finds, and merges, what it did before.
    """
    size, start, out = 1, 0, []
    while size * fan <= batches:
        size *= fan
    while size:
        while batches - start >= size:
            out.append((start, start + size))
            start += size
        size //= fan
    return out


class KeyIndex:
    """Keys of earlier batches below ``path``: one row (clave, valor) per key.

    A batch writes one segment, sorted by key and never changed; when ``fan`` segments of one size are
    there, they and the batch become one of the next size. n batches leave at most (fan - 1) * log(n)
    segments and write each key log(n) times. Beside its keys a segment has a Bloom filter, words of 64
    bits, about ``bits`` bits a key; a lookup joins its keys with the words they hash to, and reads
    the keys of only those segments whose words have all their bits. ``canon`` is the text that
    equal keys share.
    """

    def __init__(self, spark: SparkSession, path: str, canon: Callable[[Column], Column] = match_key,
                 fan: int = 4, bits: int = 16):
        self.spark, self.path, self.canon, self.fan, self.bits = spark, path.rstrip("/"), canon, fan, bits
        self.kind = T.StructType([T.StructField("clave", T.StringType()), T.StructField("valor", T.StringType())])
        self._words: dict[Segment, int] = {}
        self.probed: list[Segment] = []  # segments whose keys the last lookup read

    def _folder(self, segment: Segment, part: str) -> str:
        return f"{self.path}/{segment[0]}-{segment[1]}/{part}"

    def _keys(self, segments: list[Segment]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.kind)
        return self.spark.read.schema(self.kind).parquet(*[self._folder(s, "keys") for s in segments])

    def _width(self, segment: Segment) -> int:
        """Words of a segment's filter; 0 if the segment is not there (a batch without rows writes none)."""
        if segment not in self._words:
            if not exists(self.spark, self._folder(segment, "filter/_SUCCESS")):
                return 0
            head = self.spark.read.schema(_FILTER).parquet(self._folder(segment, "filter")).where("word = -1").first()
            self._words[segment] = head["bits"]
        return self._words[segment]

    def _there(self, segment: Segment) -> list[Segment]:
        """The segment, or what there is of it: a batch without rows never ran, so it merged nothing."""
        if self._width(segment):
            return [segment]
        step = (segment[1] - segment[0]) // self.fan
        return [s for a in range(segment[0], segment[1], step) for s in self._there((a, a + step))] if step else []

    @staticmethod
    def _place(key: Column, words: Column | int) -> Column:
        return F.pmod(F.xxhash64(key), words if isinstance(words, Column) else F.lit(words))

    @staticmethod
    def _mask(key: Column) -> Column:
        """Four bits of a word, from a second hash."""
        other = F.xxhash64(key, F.lit(1))
        six = [F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
        return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("bigint"), s) for s in six])

    def seed(self, values: DataFrame) -> None:
        """The keys that were there before; written once."""
        if not exists(self.spark, self._folder(BASE, "filter/_SUCCESS")):
            self._write(BASE, self._canonical(values))

    def _canonical(self, values: DataFrame) -> DataFrame:
        value = F.col(values.columns[0])
        return values.select(self.canon(value).cast("string").alias("clave"), value.alias("valor")).where("clave IS NOT NULL")

    def _write(self, segment: Segment, keys: DataFrame) -> None:
        folder = self._folder(segment, "keys")
        (keys.groupBy("clave").agg(F.min("valor").alias("valor")).repartitionByRange("clave").sortWithinPartitions("clave")
         .write.mode("overwrite").parquet(folder))
        stored = self._keys([segment])
        words = max(1, -(-stored.count() * self.bits // 64))
        key = F.col("clave")
        bits = stored.select(self._place(key, words).alias("word"), self._mask(key).alias("m")).groupBy("word").agg(F.bit_or("m").alias("bits"))
        head = self.spark.createDataFrame([(-1, words)], _FILTER)
        bits.unionByName(head).write.mode("overwrite").parquet(self._folder(segment, "filter"))
        self._words[segment] = words

    def add(self, batch_id: int, values: DataFrame) -> None:
        """Stores a batch's keys, merged with the segments that they complete a larger one with."""
        segment = live(batch_id + 1, self.fan)[-1]
        parts = [p for s in live(batch_id, self.fan) if s[0] >= segment[0] for p in self._there(s)]
        keys = self._canonical(values)
        self._write(segment, keys.unionByName(self._keys(parts)) if parts else keys)

    def lookup(self, values: DataFrame, batch_id: int) -> DataFrame:
        """Those of the stored values whose key one of ``values`` has, from the batches before this one."""
        segments = [p for s in (BASE, *live(batch_id, self.fan)) for p in self._there(s)]
        wanted = self._canonical(values).select("clave").distinct()
        if not segments:
            return self._keys([]).select("valor")
        # one row per key and segment, met by the one word that all of the key's bits are in
        at = F.explode(F.array(*[F.struct(F.lit(k).alias("s"), F.lit(self._width(s)).cast("bigint").alias("w"))
                                 for k, s in enumerate(segments)])).alias("at")
        probes = wanted.select("clave", at).select("clave", "at.s", self._place(F.col("clave"), F.col("at.w")).alias("word"),
                                                   self._mask(F.col("clave")).alias("m"))
        words = reduce(DataFrame.unionByName, [
            self.spark.read.schema(_FILTER).parquet(self._folder(s, "filter")).where("word >= 0").withColumn("s", F.lit(k))
            for k, s in enumerate(segments)])
        held = probes.join(words, ["s", "word"]).where(F.col("bits").bitwiseAND(F.col("m")) == F.col("m"))
        self.probed = [segments[r["s"]] for r in held.select("s").distinct().collect()]
        return self._keys(self.probed).join(wanted, "clave", "left_semi").select("valor")

    def drop_merged(self, batch_id: int) -> None:
        """Removes segments that the batch before this one merged; call it when that batch is committed."""
        if not batch_id or not self._width(live(batch_id, self.fan)[-1]):
            return
        start, end = live(batch_id, self.fan)[-1]
        step = (end - start) // self.fan
        for a in range(start, end, step) if step else ():
            for old in self._there((a, a + step)):
                remove(self.spark, f"{self.path}/{old[0]}-{old[1]}")
                self._words.pop(old, None)
