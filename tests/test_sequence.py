"""The chunked forms against the plain windows they stand for."""
import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import rows
from tillwork.operators import sequence as Q


def events(spark):
    """One key owns most rows, many of them at the same moment."""
    base = spark.range(600).select(
        F.col("id"), F.when(F.col("id") % 5 < 3, 0).otherwise(F.col("id") % 7).alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") * 37 / 3) * 60 % 90000).cast("timestamp_ntz").alias("ts"),
        (F.hash("id") % 4).alias("v"))
    return base


def chunk():
    from tillwork.functions.dates import hour_slice
    return hour_slice(F.col("ts"))


@pytest.fixture(params=["hour", "stretch"])
def cut(request):
    return chunk() if request.param == "hour" else None


def test_running_total(spark, cut):
    df = events(spark)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = Q.running_total(df, ["k"], ["ts", "id"], cut, F.col("v"), "t").select("id", "t")
    want = df.withColumn("t", F.sum("v").over(w)).select("id", "t")
    assert sorted(rows(got)) == sorted(rows(want))


def test_previous_value(spark, cut):
    df = events(spark).withColumn("v", F.when(F.col("v") != 2, F.col("v")))
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("ts", "id"))).select("id", "p")
    got = Q.previous_value(df, ["k"], ["ts", "id"], cut, "v", "p").select("id", "p")
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_streak(spark, cut):
    df = events(spark).withColumn("bad", F.abs("v") < 3)
    got = dict(rows(Q.streak(df, ["k"], ["ts", "id"], cut, F.col("bad"), ~F.col("bad"), "s").select("id", "s")))
    run, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.ts, r.id)):
        run[r.k] = run.get(r.k, 0) + 1 if r.bad else 0
        want[r.id] = run[r.k]
    assert got == want


def test_a_hot_key_at_one_moment_is_cut_evenly(spark):
    """A third of the rows have one key and one time; no stretch is much larger than the others."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
                                        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("ts"))
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        cut = Q.in_stretches(df, ["k"], ["ts", "id"])
        sizes = [n for _, n in rows(cut.groupBy("_chunk").count())]
        hot = [n for _, n in rows(cut.where("k = -1").groupBy("_chunk").count())]
        assert len(sizes) == 12 and max(sizes) < 1.5 * 30_000 / 12 and len(hot) >= 4
        got = Q.running_total(df, ["k"], ["ts", "id"], None, F.lit(1), "n").where("k = -1 AND n <> id / 3 + 1")
        assert got.count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rank(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.hash("id") % 1000 * 17)
                                 .cast("decimal(18,2)").alias("v"))
    want = df.withColumn("r", F.rank().over(Window.orderBy(F.desc("v")))).select("id", "r")
    assert sorted(rows(Q.rank_by(df, "v", "r").select("id", "r"))) == sorted(rows(want))


def test_rank_puts_null_last(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9), (4, None)], "id int, v int")
    assert sorted(rows(Q.rank_by(df, "v", "r").select("id", "r"))) == [(1, 2), (2, 3), (3, 1), (4, 3)]


def test_ladder_running_sum(spark):
    df = spark.range(300).select("id", (F.hash("id") % 500).cast("decimal(18,2)").alias("v"))
    want = df.withColumn("s", F.sum("v").over(Window.orderBy(F.desc("v")))).select("id", "s")
    got = df.join(Q.value_ladder(df, "v"), "v").select("id", F.col("_running").alias("s"))
    assert sorted(rows(got)) == sorted(rows(want))


def test_number_rows(spark):
    df = spark.range(0, 900, 3).select((F.col("id") - 300).alias("id"))
    got = sorted(rows(Q.number_rows(df, "id", "n", start=10, block=50).select("id", "n")))
    assert got == [(k, 10 + i) for i, k in enumerate(range(-300, 600, 3), 1)]


def test_no_whole_table_window(spark):
    """Every window over raw rows is partitioned; only chunk summaries are gathered."""
    df = events(spark)
    plan = Q.rank_by(df, "v", "r")._jdf.queryExecution().executedPlan().toString()
    before_single = plan.split("SinglePartition")
    assert "Window [rank" not in plan and len(before_single) >= 2


def test_numbers_of_sparse_and_dense_keys(spark):
    """Random 64-bit ids, a dense run and an outlier: dense numbers, and no window above a few blocks."""
    import random
    rnd = random.Random(3)
    ids = {rnd.getrandbits(64) - 2 ** 63 for _ in range(3000)} | set(range(10 ** 6, 10 ** 6 + 2000)) | {2 ** 63 - 1, -2 ** 63}
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = Q.number_rows(df, "id", "n", start=5, block=100)
    assert [n for _, n in sorted(map(tuple, got.collect()))] == list(range(6, 6 + len(ids)))
    assert Q.number_rows(df.limit(0), "id", "n").count() == 0
