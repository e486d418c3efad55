"""What several corpus operators share: tables, stored intermediates, word rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tillwork.session import settle  # noqa: F401  (stored intermediates, read back; used by the operators)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle_and_free(df: DataFrame, label: str) -> DataFrame:
    """``settle``, and the files of the exchanges behind it go at once, not when the driver's memory runs low.

    For results whose exchanges are as large as the input: nothing reads them once the result is stored.
    """
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        return settle(df, label)
    finally:
        spark.conf.set(name, before)


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A function on one Arrow batch as a function on a partition's batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield work(batch)
    return run


_held: dict[str, object] = {}


def held(key: str, make: Callable[[], object]):
    """What a worker process keeps from one task to the next: one thing at a time, the latest asked for.

    Workers are used again by later stages; what an earlier one remembered must not stay beside.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts, a missing one as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def blocks(found: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Runs of texts, as start and end, of about so many characters; a text is never cut."""
    start = size = 0
    for k, t in enumerate(found):
        size += len(t)
        if size >= chars:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(found):
        yield start, len(found)


def packed(docs: DataFrame) -> DataFrame:
    """All columns as one, ``row``, so that whatever an operator adds beside it has a name of its own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def with_columns(rows: DataFrame, added: dict[str, tuple[str, pa.DataType, Callable[[list[str]], list]]]) -> DataFrame:
    """``packed`` rows with columns worked out from the batch's texts: name -> (Spark type, Arrow type, work)."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row = batch.column("row")
        found = [t or "" for t in row.field("text").to_pylist()]
        return pa.RecordBatch.from_arrays([row, *(pa.array(f(found), kind) for _, kind, f in added.values())],
                                          names=["row", *added])

    schema = T.StructType([rows.schema["row"]])
    for name, (kind, _, _) in added.items():
        schema = schema.add(name, kind)
    return rows.mapInArrow(per_batch(work), schema)


#: A-Z to a-z on UTF-8 bytes; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# bytes.split() cuts at exactly the six bytes 0x20 and 0x09-0x0D, so it finds the words
# [^\x20\x09-\x0D]+ of a UTF-8 text; no byte of a longer character is among them.


def source_key(column: str) -> Column:
    """A text that names a value of a nullable column, null apart from every value."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column)))


def ranged(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """Stores rows sorted by ``group`` and ``order`` (nulls first) with their place: ``_part``, ``_at``.

    Places within a part follow the order, and so do parts. A range split by all these columns
    cuts a group of any size over tasks; rows that agree in all of them may change places.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    placed = (rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("_at", F.monotonically_increasing_id()))
    return settle(placed.withColumn("_part", F.shiftright("_at", 33)), label)


def positions(placed: DataFrame, group: list[str], name: str) -> DataFrame:
    """``ranged`` rows numbered from 0 within their group, and ``_n``, the rows of the group.

    One row per group and part goes through a window, never the rows themselves.
    """
    by = Window.partitionBy(*group)
    runs = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(by.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"), "_first",
                       before.alias("_before"), F.sum("_rows").over(by).alias("_n"))
    on = placed["_part"] == runs["_p"]
    for i, g in enumerate(group):
        on = on & placed[g].eqNullSafe(runs[f"_g{i}"])
    return (placed.join(runs, on).withColumn(name, F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_part", "_at", "_p", "_first", "_before", *[f"_g{i}" for i in range(len(group))]))


def running_sums(rows: DataFrame, key: str, place: str, sums: dict[str, Column], chunk: int = 4096) -> DataFrame:
    """Sums of each ``key``'s values up to and with each ``place``, a whole number that may repeat.

    A key is cut into chunks of places: one window per chunk, one over the chunks' totals, so no
    task has to hold a key. Places of one key should lie close together.
    """
    cut = rows.withColumns({"_chunk": F.floor(F.col(place) / chunk), **{f"_v_{n}": v for n, v in sums.items()}})
    totals = cut.groupBy(key, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_c_{n}") for n in sums])
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col(key).alias("_k"), F.col("_chunk").alias("_kc"),
                          *[F.sum(f"_c_{n}").over(earlier).alias(f"_c_{n}") for n in sums])
    # a key's first chunk has nothing before it, and most keys have no other
    carry = carry.where(F.col(f"_c_{next(iter(sums))}").isNotNull())
    local = Window.partitionBy(key, "_chunk").orderBy(place).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = cut.withColumns({f"_v_{n}": F.sum(f"_v_{n}").over(local) for n in sums})
    joined = inside.join(carry, (F.col(key) == F.col("_k")) & (F.col("_chunk") == F.col("_kc")), "left")
    return (joined.withColumns({n: F.col(f"_v_{n}") + F.coalesce(f"_c_{n}", F.lit(0)) for n in sums})
            .drop("_chunk", "_k", "_kc", *[f"_{x}_{n}" for n in sums for x in "vc"]))


#: A turn's role and text, null as empty, as one digest that no other pair shares.
def turn_digest() -> Column:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
