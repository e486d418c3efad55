import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwork import schema as S
from tillwork.plans import imports as I
from tillwork.sources import files
from tillwork.streaming.imports import import_stream, incoming
from tillwork.streaming.keyindex import BASE, KeyIndex, live
from tillwork.streaming.prices import STATE_STORE, price_change_batches, price_change_stream

HEAD = "id_categoria,nombre,descripcion,precio,stock,activo\n"


def test_continuous_import(spark, seed, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda name, text: (tmp_path / "in" / name).write_text(HEAD + text, encoding="utf-8")
    put("a.csv", "1,Nuevo,x,10.00,1,1\n1,Remera básica,x,10.00,1,1\n")
    stream = incoming(spark, str(tmp_path / "in"), S.STAGING_PRODUCTOS, files_per_trigger=1)
    check = lambda rows_, existing: I.validate_products(rows_, seed["categorias"], existing, I.LENIENT)
    run = lambda: import_stream(stream, check, seed["productos"], "nombre", S.NUEVO_PRODUCTO, str(tmp_path / "out"),
                                str(tmp_path / "cp")).start().awaitTermination()
    run()
    put("b.csv", "1,NUEVO,x,10.00,1,1\n2,Otro,x,\"1,5\",1,1\n2,Largo,x,1,1,1,sobra\n2,Corto,x,7\n")
    run()
    put("c.csv", "1,otro ,x,10.00,1,1\n1,Nuevo,x,10.00,1,1\n")
    run()
    accepted = spark.read.parquet(str(tmp_path / "out/accepted"))
    assert sorted(rows(accepted, "nombre", "precio", "batch")) == [("Corto", 7, 1), ("Nuevo", 10, 0), ("Otro", 1.5, 1)]
    rejected = spark.read.parquet(str(tmp_path / "out/rejected"))
    why = F.element_at("issues", -1)
    got = sorted(rows(rejected.select("batch", why["regla"].alias("r"), why["valor"].alias("v"), "observacion")))
    assert [r[:3] for r in got] == [(0, "duplicado", "Remera básica"), (1, "archivo_malformado", "2,Largo,x,1,1,1,sobra"),
                                    (1, "duplicado", "NUEVO"), (2, "duplicado", "Nuevo"), (2, "duplicado", "otro ")]
    assert all(r[3] for r in got)


@pytest.mark.parametrize("text", ['1,"a ""b"" c",x,1,1,1\n', "1,corta\n", "1,larga,x,1,1,1,1\n", '1,"con, coma",x,"1,5",1,1\n', ",,,,,\n"])
def test_stream_and_batch_read_alike(spark, tmp_path, text):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEAD + text, encoding="utf-8")
    stream = incoming(spark, str(tmp_path / "in"), S.STAGING_PRODUCTOS)
    (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
     .trigger(availableNow=True).start().awaitTermination())
    batch = files.read_products_csv(spark, str(tmp_path / "in")).drop("fila")
    assert rows(spark.read.schema(batch.schema).parquet(str(tmp_path / "out"))) == rows(batch)


@pytest.mark.parametrize("fan", [2, 3, 4])
def test_segments_cover_all_batches(fan):
    """Each batch stands in one segment, a batch ends one segment, and few are ever alive."""
    for n in range(1, 700):
        segments = live(n, fan)
        assert [b for a, z in segments for b in range(a, z)] == list(range(n))
        assert len(segments) <= (fan - 1) * (n.bit_length() + 1)
        new, before = segments[-1], live(n - 1, fan)
        assert new[1] == n and segments[:-1] == [s for s in before if s[0] < new[0]]


def names(*values):
    return [(v,) for v in values]


def test_index_finds_every_key_and_reads_few_segments(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), fan=3)
    frame = lambda values: spark.createDataFrame(names(*values), "nombre string")
    index.seed(frame(["Catálogo", None]))
    for b in range(14):
        index.drop_merged(b)
        if b == 5:  # a batch that had no rows at all
            continue
        index.add(b, frame([f"Nombre {b} {i}" for i in range(20)]))
        if b in (3, 9):  # a replayed batch finds what it found, and leaves the same
            index = KeyIndex(spark, str(tmp_path / "i"), fan=3)
            index.drop_merged(b)
            index.add(b, frame([f"Nombre {b} {i}" for i in range(20)]))
    wanted = frame(["CATÁLOGO", "nombre 0 3", " Nombre 13 19", "Nombre 5 0", "nada", None])
    assert sorted(rows(index.lookup(wanted, 14))) == names("Catálogo", "Nombre 0 3", "Nombre 13 19")
    assert rows(index.lookup(wanted, 13).where("valor LIKE '%13%'")) == []  # a batch does not see itself
    every = frame([f"nombre {b} {i}" for b in range(14) for i in range(20)])
    assert index.lookup(every, 14).count() == 13 * 20
    index.lookup(frame([f"otro {i}" for i in range(5)]), 14).count()
    assert not index.probed  # keys that nobody has: no segment's keys are read
    index.lookup(frame(["nombre 2 2"]), 14).count()
    assert index.probed == [(0, 9)]  # merged whole, though a batch in it never ran
    left = {p.name for p in (tmp_path / "i").iterdir()}
    assert left == {f"{a}-{z}" for a, z in [BASE, *live(14, 3)]}


KIND = "id bigint, k int, precio decimal(10,2), ts timestamp_ntz"
PARTS = ([(1, 1, 10), (2, 1, 11), (3, 2, 5)], [(4, 1, 11), (5, 1, 12), (10, None, 1)], [(6, 3, 1), (11, 4, None)], [(7, 2, 6), (8, 1, 12)],
         [(9, 3, 2), (12, 4, 3), (13, 4, 4), (14, None, 2)])


@pytest.mark.parametrize("form", ["state", "batches"])
def test_price_stream(spark, tmp_path, form):
    """Each part is a run of its own, from the checkpoint of the one before."""
    t0 = dt.datetime(2025, 1, 1)
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    src = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(src)
    args = (stream, "k", "ts", "id", "precio", str(tmp_path / "out"), str(tmp_path / "cp"))
    for data in PARTS:
        price = lambda p: None if p is None else Decimal(p)
        (spark.createDataFrame([(i, k, price(p), t0 + dt.timedelta(hours=i)) for i, k, p in data], KIND)
         .coalesce(1).write.mode("append").parquet(src))
        (price_change_stream(*args) if form == "state" else price_change_batches(*args, compact_every=2)).start().awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out/changes")).orderBy("id")
    got = rows(found, "id", "precio_anterior", "precio_nuevo", "diferencia")
    assert got == [(2, 10, 11, 1), (5, 11, 12, 1), (7, 5, 6, 1), (9, 1, 2, 1), (13, 3, 4, 1)]
