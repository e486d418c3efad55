"""Ordered computations that no single task has to hold.

A window over a whole table, or over one hot key, lands in one task. The helpers here
cut such a sequence into chunks by a fixed rule on the ordering value, solve each chunk
on its own, and carry a small per-chunk summary across. The chunk of a row depends on
that row only, so a recomputed task lands on the same chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwork.session import settle

_CHUNK = "_chunk"


def in_stretches(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stores the rows cut into stretches of about equal size along keys and order: ``_chunk``, ascending.

    The cuts are quantiles of a sample of (keys, order), so a key of any share is cut as often as its
    rows need, even if all of them have the same time; only rows that agree in the whole
    order stay together. Stored, because what reads it twice has to see the same cuts.
    """
    cut = df.repartitionByRange(*keys, *order).withColumn(_CHUNK, F.spark_partition_id())
    return settle(cut, "stretches")


def _cut(df: DataFrame, keys: list[str], order: list[str], chunk: Column | None) -> DataFrame:
    return in_stretches(df, keys, order) if chunk is None else df.withColumn(_CHUNK, chunk)


def _before(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Per (keys, chunk), what all earlier chunks of the same keys add up to."""
    w = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_carry", F.coalesce(F.sum(amount).over(w), F.lit(0))).drop(amount)


def number_rows(df: DataFrame, key: str, name: str, start: int | Column = 0, block: int = 100_000) -> DataFrame:
    """Dense numbers from start+1 in the order of a unique integer key.

    Rows are cut twice: into stretches of the key's range, one for every ``block`` rows, and
    within a stretch into blocks of key values, of at most ``block`` rows each. Dense keys fill
    the blocks, sparse ones (hashes) the stretches. What is counted per block is ordered within
    its stretch, and only one count per stretch is ordered globally. Rows and key range are asked for
    once, when this is called: as part of the plan they would be computed wherever it uses them.
    """
    rows, lo, hi = df.agg(F.count("*"), F.min(key).cast("double"), F.max(key).cast("double")).first()
    width = max(1.0, ((hi or 0.0) - (lo or 0.0) + 1) / max(1, -(-rows // block)))
    cut = (df.withColumn("_stretch", F.floor((F.col(key).cast("double") - F.lit(lo or 0.0)) / F.lit(width)).cast("bigint"))
           .withColumn(_CHUNK, F.call_function("div", F.col(key), F.lit(block))))
    counts = cut.groupBy("_stretch", _CHUNK).agg(F.count("*").alias("_n"))
    far = (counts.groupBy("_stretch").agg(F.sum("_n").alias("_n")).withColumn(
        "_far", F.coalesce(F.sum("_n").over(Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_n"))
    carry = _before(counts, ["_stretch"], "_n").join(far, "_stretch")
    local = F.row_number().over(Window.partitionBy("_stretch", _CHUNK).orderBy(key))
    first = start if isinstance(start, Column) else F.lit(start)
    return (cut.withColumn("_local", local).join(carry, ["_stretch", _CHUNK])
            .withColumn(name, (F.col("_local") + F.col("_carry") + F.col("_far") + first).cast("bigint"))
            .drop(_CHUNK, "_stretch", "_local", "_carry", "_far"))


def _descending_chunk(value: Column) -> Column:
    """Small integers that fall as the value grows: 256 logarithmic steps per doubling."""
    size = F.floor(F.log2(F.abs(value).cast("double") + 1) * 256).cast("int")
    return F.when(value < 0, size).otherwise(-size)


def value_ladder(df: DataFrame, value: str) -> DataFrame:
    """Per distinct value: rows strictly above it, and the sum of all values down to it.

    Equal rows are folded before anything is ordered, so a value shared by a third of
    the table costs one row here.
    """
    steps = (df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
             .withColumn(_CHUNK, _descending_chunk(F.col(value)))
             .withColumn("_s", F.col(value).cast("decimal(28,2)") * F.col("_n").cast("decimal(10,0)")))
    totals = steps.groupBy(_CHUNK).agg(F.sum("_n").alias("_cn"), F.sum("_s").alias("_cs"))
    wide = Window.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        _CHUNK,
        F.coalesce(F.sum("_cn").over(wide), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_cs").over(wide), F.lit(0)).alias("_s0"),
    )
    local = (Window.partitionBy(_CHUNK).orderBy(F.desc(value))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (steps.withColumn("_nl", F.sum("_n").over(local)).withColumn("_sl", F.sum("_s").over(local))
            .join(carry, _CHUNK)
            .select(value,
                    (F.col("_n0") + F.col("_nl") - F.col("_n")).alias("_above"),
                    (F.col("_s0") + F.col("_sl")).alias("_running")))


def rank_by(df: DataFrame, value: str, name: str = "ranking") -> DataFrame:
    """RANK() OVER (ORDER BY value DESC) without gathering the table; NULL values rank last."""
    ladder = value_ladder(df, value).select(value, "_above")
    present = df.agg(F.count(value)).scalar()
    rank = F.coalesce(F.col("_above"), present) + 1
    return df.join(ladder, value, "left").withColumn(name, rank.cast("bigint")).drop("_above")


def running_total(df: DataFrame, keys: list[str], order: list[str], chunk: Column | None, value: Column,
                  name: str) -> DataFrame:
    """SUM(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING).

    ``chunk`` must not fall along ``order`` (an hour number for a timestamp order, say); without it
    rows are cut into stretches of equal size.
    """
    return running_totals(_cut(df, keys, order, chunk), keys, order, {name: value}).drop(_CHUNK)


def running_totals(cut: DataFrame, keys: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """Several running totals over rows that ``in_stretches`` stored."""
    cut = cut.withColumns({f"_v_{n}": v for n, v in values.items()})
    totals = cut.groupBy(*keys, _CHUNK).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    w = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, _CHUNK, *[F.coalesce(F.sum(f"_t_{n}").over(w), F.lit(0)).alias(f"_t_{n}") for n in values])
    local = (Window.partitionBy(*keys, _CHUNK).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = cut.withColumns({f"_v_{n}": F.sum(f"_v_{n}").over(local) for n in values})
    return (inside.join(carry, [*keys, _CHUNK]).withColumns({n: F.col(f"_v_{n}") + F.col(f"_t_{n}") for n in values})
            .drop(*[f"_{x}_{n}" for n in values for x in "vt"]))


def previous_value(df: DataFrame, keys: list[str], order: list[str], chunk: Column | None, value: str,
                   name: str) -> DataFrame:
    """LAG(value) OVER (PARTITION BY keys ORDER BY order), keys split by chunk."""
    cut = _cut(df, keys, order, chunk)
    last = cut.groupBy(*keys, _CHUNK).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_last"))
    by_key = Window.partitionBy(*keys).orderBy(_CHUNK)
    carry = last.withColumn("_carry", F.lag("_last").over(by_key)).drop("_last")
    local = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    inside = F.lag(F.struct(F.col(value).alias("v"))).over(local)
    return (cut.withColumn("_inside", inside).join(carry, [*keys, _CHUNK])
            .withColumn(name, F.coalesce("_inside", "_carry")["v"]).drop(_CHUNK, "_inside", "_carry"))


def streak(df: DataFrame, keys: list[str], order: list[str], chunk: Column | None, counts: Column, resets: Column,
           name: str) -> DataFrame:
    """How many rows matched ``counts`` since the last row that matched ``resets``."""
    cut = (_cut(df, keys, order, chunk)
           .withColumn("_c", F.coalesce(counts, F.lit(False)).cast("int"))
           .withColumn("_r", F.coalesce(resets, F.lit(False)).cast("int")))
    local = (Window.partitionBy(*keys, _CHUNK).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = cut.withColumn("_run", F.sum("_r").over(local))
    run = (Window.partitionBy(*keys, _CHUNK, "_run").orderBy(*order)
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = inside.withColumn("_local", F.sum("_c").over(run))

    # A chunk hands on the matches after its last reset; without a reset, all of them
    # plus whatever it was handed itself.
    ending = (inside.groupBy(*keys, _CHUNK)
              .agg(F.max("_r").alias("_has"), F.max_by("_local", F.struct(*order)).alias("_end")))
    by_key = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ending = ending.withColumn("_group", F.sum("_has").over(by_key))
    prior = (Window.partitionBy(*keys, "_group").orderBy(_CHUNK)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ending = ending.withColumn("_total", F.sum("_end").over(prior))
    handed = F.coalesce(F.lag("_total").over(Window.partitionBy(*keys).orderBy(_CHUNK)), F.lit(0))
    carry = ending.withColumn("_carry", handed).select(*keys, _CHUNK, "_carry")
    total = F.col("_local") + F.when(F.col("_run") == 0, F.col("_carry")).otherwise(F.lit(0))
    return (inside.join(carry, [*keys, _CHUNK]).withColumn(name, total)
            .drop(_CHUNK, "_c", "_r", "_run", "_local", "_carry"))
