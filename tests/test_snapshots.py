import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwork import schema as S, shared_folder
from tillwork.sources import layout, snapshots as N
from tillwork.sources.checksums import BucketSnapshot, bucket_of, changed_buckets, checksum_tree
from tillwork.sources.storage import files_below

T0 = dt.datetime(2025, 1, 1, 10)


def test_csv_round_trip(spark, tmp_path):
    data = [(1, 'a "quoted", text', "line\nbreak", Decimal("1.50"), T0), (2, "", None, None, None),
            (3, "back\\slash", "N", Decimal("0"), T0 + dt.timedelta(microseconds=7)),
            (4, "\\N", "end\\", None, None), (5, 'q\\"x', " lead ", None, None), (6, "\\\\N", ",", None, None)]
    df = spark.createDataFrame(data, "id int, a string, b string, c decimal(10,2), t timestamp_ntz")
    N.snapshot_full(df, str(tmp_path / "f"))
    back = N.read_snapshot(spark, str(tmp_path / "f"), df.schema)
    assert rows(N.differing_rows(df, back)) == [("solo_a", 0), ("solo_b", 0)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_snapshot_cut_short_is_refused(spark, tmp_path, fmt):
    df = spark.range(100).selectExpr("id", "concat('a', id) AS t").repartition(4)
    path = str(tmp_path / "f")
    N.snapshot_full(df, path, fmt)
    assert N.read_snapshot(spark, path, df.schema, fmt, verify=True).count() == 100
    files = sorted(p for p in (tmp_path / "f").iterdir() if p.name.startswith("part-"))
    saved = files[0].read_bytes()
    files[0].unlink()
    with pytest.raises(N.IncompleteSnapshot, match=files[0].name):
        N.read_snapshot(spark, path, df.schema, fmt)
    files[0].write_bytes(saved[:-1])
    with pytest.raises(N.IncompleteSnapshot):
        N.read_snapshot(spark, path, df.schema, fmt)
    if fmt == "csv":
        files[0].write_bytes(saved.replace(b"a", b"b", 1))
        (tmp_path / "f" / f".{files[0].name}.crc").unlink()
        assert N.read_snapshot(spark, path, df.schema, fmt).count() == 100
        with pytest.raises(N.IncompleteSnapshot, match="rows differ"):
            N.read_snapshot(spark, path, df.schema, fmt, verify=True)
    df.write.parquet(str(tmp_path / "other"))
    with pytest.raises(N.IncompleteSnapshot, match="no manifest"):
        N.read_snapshot(spark, str(tmp_path / "other"), df.schema, "parquet")


def test_an_empty_snapshot(spark, tmp_path):
    df = spark.range(0)
    N.snapshot_full(df, str(tmp_path / "f"))
    assert N.read_snapshot(spark, str(tmp_path / "f"), df.schema, verify=True).count() == 0


KEPT = "id long, a string, b string, n decimal(10,2)"


def table(spark, data):
    return spark.createDataFrame([(i, a, b, None if n is None else Decimal(n)) for i, a, b, n in data], KEPT)


def test_checksums_tell_rows_apart(spark):
    tree = lambda data, n=40: checksum_tree(table(spark, data), "id", n, fan=3)
    base = [(i, f"a{i}", None, i) for i in range(200)]
    assert changed_buckets(tree(base), tree(base[::-1]), 3) == []
    for other in ([(0, None, "a0", 0), *base[1:]], base[:-1], [*base, (900, None, None, None)], [(0, "a0", None, None), *base[1:]]):
        assert len(changed_buckets(tree(base), tree(other), 3)) == 1
    assert len(changed_buckets(tree(base), tree([]), 3)) == 40 == len(changed_buckets(tree([]), tree(base), 3))
    assert changed_buckets(tree([], 1), tree([], 1), 3) == []


def test_changes_and_merge(spark, tmp_path):
    base = {i: (i, f"a{i}", "x", i) for i in range(300)}
    snapshot = BucketSnapshot(spark, str(tmp_path / "s"), "id", table(spark, []).schema, buckets=32)
    snapshot.write(table(spark, base.values()))
    now = {**base, 7: (7, None, "x", 7), 1000: (1000, "new", None, None)}
    del now[9]
    changes = snapshot.changes_to(table(spark, now.values()))
    assert sorted(rows(changes, "id", "a", "_borrada")) == [(7, None, False), (9, None, True), (1000, "new", False)]
    before = files_below(spark, f"{tmp_path}/s/filas")
    # only buckets that differ are scanned
    touched = changed_buckets(snapshot.tree(), checksum_tree(table(spark, now.values()), "id", 32))
    assert len(touched) <= 3
    plan = snapshot.rows(touched)._jdf.queryExecution().executedPlan()
    assert "_cubo" in plan.toString().split("PartitionFilters: [")[1].split("]")[0]
    read = {f.split("_cubo=")[1].split("/")[0] for f, in rows(snapshot.rows(touched).select(F.input_file_name()).distinct())}
    assert read == {str(b) for b in touched}
    stored = spark.createDataFrame(changes.collect(), changes.schema)
    snapshot.apply(stored)
    assert sorted(rows(snapshot.rows()), key=lambda r: r[0]) == sorted(now.values(), key=lambda r: r[0])
    after = files_below(spark, f"{tmp_path}/s/filas")
    touched = {bucket for bucket, in rows(stored.select(bucket_of("id", 32)).distinct())}
    same = {f for f in before if int(f.split("=")[1].split("/")[0]) not in touched}
    assert same <= set(after) and not (set(before) - same) & set(after)
    assert snapshot.changes_to(table(spark, now.values())).count() == 0
    snapshot.apply(stored)  # once more
    assert snapshot.changes_to(table(spark, now.values())).count() == 0


def test_merge_of_several_differentials(spark, tmp_path):
    kind = table(spark, []).schema
    snapshot = BucketSnapshot(spark, str(tmp_path / "s"), "id", kind, buckets=4)
    snapshot.write(table(spark, [(1, "one", None, 1), (2, "two", None, 2)]))
    sets = [[(2, "2b", None, 2, False), (3, "three", None, 3, False)], [(2, None, None, None, True), (1, None, None, None, True)],
            [(1, "back", None, 1, False), (3, "3c", None, 3, False)]]
    snapshot.apply([spark.createDataFrame([(i, a, b, None if n is None else Decimal(n), d) for i, a, b, n, d in s], KEPT + ", _borrada boolean")
                    for s in sets])
    assert sorted(rows(snapshot.rows(), "id", "a")) == [(1, "back"), (3, "3c")]
    other = BucketSnapshot(spark, str(tmp_path / "o"), "id", kind, buckets=4)
    other.write(table(spark, [(1, "back", None, 1), (5, "five", None, 5)]))
    assert rows(snapshot.differing_rows(other)) == [("solo_a", 1), ("solo_b", 1)]
    assert sorted(rows(snapshot.changes_to(other), "id", "_borrada")) == [(3, True), (5, False)]
    # a bucket whose rows all go is empty, in the rows and in the tree
    snapshot.apply(snapshot.changes_to(spark.createDataFrame([], kind)))
    assert snapshot.rows().count() == 0 and snapshot.changes_to(spark.createDataFrame([], kind)).count() == 0


def test_drill(spark, seed, tmp_path):
    live = seed["productos"].withColumn("fecha_modificacion", F.lit(T0).cast("timestamp_ntz"))
    mark = F.lit(T0 + dt.timedelta(minutes=5)).cast("timestamp_ntz")
    N.snapshot_full(live, str(tmp_path / "full"))
    log = N.log_snapshot(live, N.FULL, "Productos", "full", mark)
    later = F.lit(T0 + dt.timedelta(minutes=9)).cast("timestamp_ntz")
    changed = (live.withColumn("fecha_modificacion", F.when(F.col("id_producto") == 3, later).otherwise(F.col("fecha_modificacion")))
               .withColumn("stock", F.when(F.col("id_producto") == 3, 1).otherwise(F.col("stock"))))
    extra = spark.createDataFrame([(12, 1, "demo", None, Decimal(9999), 10, True, T0 + dt.timedelta(minutes=8))], live.schema)
    current = changed.unionByName(extra)
    diff = N.snapshot_diff(current, log, "Productos", "fecha_modificacion")
    assert sorted(rows(diff, "id_producto")) == [(3,), (12,)]
    full = N.read_snapshot(spark, str(tmp_path / "full"), live.schema)
    assert {n for _, n in rows(N.differing_rows(N.restore(full, diff, "id_producto"), current))} == {0}
    log = log.unionByName(N.log_snapshot(diff, N.DIFFERENTIAL, "Productos", "diff", later))
    assert rows(N.snapshot_report(log), "tipo", "filas_respaldadas") == [("FULL", 11), ("DIFERENCIAL", 2)]
    gone = spark.createDataFrame([(1,)], "id_producto int")
    assert N.restore(full, diff, "id_producto", deleted=gone).count() == 11
    newer = diff.withColumn("stock", F.lit(77)).withColumn("fecha_modificacion", F.lit(T0 + dt.timedelta(hours=9)).cast("timestamp_ntz"))
    both = N.restore(full, [newer, diff], "id_producto", "fecha_modificacion")
    assert dict(rows(both, "id_producto", "stock"))[3] == 77 and both.count() == 12


def test_no_full_snapshot_means_no_difference(spark, seed):
    log = spark.createDataFrame([], S.SNAPSHOT_LOG)
    live = seed["productos"].withColumn("m", F.lit(T0).cast("timestamp_ntz"))
    assert N.snapshot_diff(live, log, "Productos", "m").count() == 0


def test_row_counts(seed):
    assert rows(N.row_counts({"a": seed["productos"], "b": seed["ventas"]})) == [("a", 11), ("b", 8)]


def test_shared_folder_is_fresh(spark):
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert a != b and a.startswith(base.rstrip("/"))


def test_bucketed_sales_join_without_shuffle(spark, seed, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_lines"), spark.sql("DROP TABLE IF EXISTS t_sales")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS buckets LOCATION '{tmp_path}'")
    layout.write_bucketed(seed["detalle_ventas"], "buckets.t_lines", "id_venta", 4)
    layout.write_bucketed(seed["ventas"], "buckets.t_sales", "id_venta", 4)
    t = layout.read_tables(spark, {"l": "buckets.t_lines", "v": "buckets.t_sales"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = t["l"].join(t["v"], "id_venta").groupBy("id_venta").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE buckets CASCADE")
