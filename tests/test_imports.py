import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwork import schema as S
from tillwork.functions.text import accent_free_key
from tillwork.operators import validation as V
from tillwork.plans import imports as I
from tillwork.sources import files

PRODUCTS = '''id_categoria,nombre,descripcion,precio,stock,activo
5,"Botella 3/4"" acero",Acero 750 ml,4100.00,35,1
3,CAFÉ MOLIDO 500G,otro paquete,2750.00,12,1
9,Cuaderno rayado,Tapa dura,950.50,80,1
4,Perchero de pie,Madera,21000,8,1
,Silla ergonómica,sin categoría,45000.00,3,1
2,Gorro de lana,-,-1200.75,22,1
1,Cable USB-C 2 m,"trenzado, negro",1999.99,300,0
5,  ,sin nombre,100.00,1,1
2,Remera Básica,talle S,gratis,10,1
3,Té verde 50 saquitos,En hebras,1340.00,64,1
4,Lámpara LED,12 W,8700.00,90,1
1,Webcam 1080p,Con micrófono,15999.00,41,1
5,Mochila deportiva,20 l,9800.00,5,1
2,Medias cortas x3,Algodón,2100.00,150,1
'''
CLIENTS = '''[
{"nombre":"Julieta","apellido":"Paz","email":"jpaz@correo.test","telefono":"n/d","direccion":"Ruta 5 km 3","fecha_registro":"2024-12-02"},
{"nombre":"Sofi","apellido":"L.","email":"SOFIA.lopez@Email.com","telefono":"9","direccion":null,"fecha_registro":"2024-12-02"},
{"nombre":"Hugo","apellido":"Ledesma","email":"hugo@correo.test","telefono":"12","direccion":"-","fecha_registro":"2025-13-41"},
{"nombre":"Irene","apellido":"Bravo","email":"irene en correo","telefono":"12","direccion":"-","fecha_registro":"2024-12-04"},
{"nombre":"Pilar","apellido":" ","email":"pilar@correo.test","telefono":"13","direccion":"-","fecha_registro":"2024-12-05"},
{"nombre":"Ramiro","apellido":"Sosa","email":"rsosa@correo.test","telefono":"","direccion":"-","fecha_registro":"2024-12-06"},
{"nombre":"Noelia","apellido":"Quiroga","email":"noelia@correo.test","telefono":"15","direccion":"-","fecha_registro":"2024-12-07"},
{"nombre":"Iván","apellido":"Ferreyra","email":"ivan@correo.test","telefono":"16","direccion":"-","fecha_registro":"2024-12-08"}
]'''
RUN = dt.date(2025, 6, 1)


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    (folder / "p.csv").write_text(PRODUCTS, encoding="utf-8")
    (folder / "c.json").write_text(CLIENTS, encoding="utf-8")
    p, _ = files.split_corrupt(files.read_products_csv(spark, str(folder / "p.csv")), "Productos")
    c, _ = files.split_corrupt(files.read_clients_json(spark, str(folder / "c.json")), "Clientes")
    return p, c


def by_state(df):
    return dict(rows(df.groupBy("estado").count()))


def reasons(df):
    return dict(rows(df.where("estado = 'error'").select("fila", F.element_at("issues", -1)["regla"])))


def test_reads_text_only(staged):
    p, c = staged
    assert {k for _, k in p.drop("fila").dtypes} == {"string"} and p.count() == 14 and c.count() == 8
    first = p.orderBy("fila").first()
    assert (first.fila, first.nombre) == (2, 'Botella 3/4" acero')


def test_products_strict(staged, seed):
    v = I.validate_products(staged[0], seed["categorias"], seed["productos"])
    assert by_state(v) == {"ok": 6, "corregido": 1, "error": 7}
    assert reasons(v) == {3: "duplicado", 12: "duplicado", 14: "duplicado", 4: "clave_foranea",
                          6: "clave_invalida", 10: "no_numerico", 9: "obligatorio"}
    fixed = v.where("estado = 'corregido'").first()
    assert fixed.precio == Decimal("0.00") and fixed.observacion == "precio negativo (-1200.75) corregido a 0.00 – viola CHECK (precio >= 0)"


def test_products_lenient(staged, seed):
    v = I.validate_products(staged[0], seed["categorias"], seed["productos"], I.LENIENT)
    assert by_state(v) == {"ok": 6, "corregido": 1, "error": 7}
    assert reasons(v) == {3: "duplicado", 12: "duplicado", 14: "duplicado", 6: "duplicado", 10: "duplicado",
                          4: "clave_foranea", 9: "obligatorio"}


def test_clients_both_policies(staged, seed):
    strict = I.validate_clients(staged[1], seed["clientes"], RUN)
    assert by_state(strict) == {"ok": 4, "corregido": 1, "error": 3}
    assert reasons(strict) == {2: "duplicado", 4: "formato_email", 3: "fecha_invalida"}
    lenient = I.validate_clients(staged[1], seed["clientes"], RUN, I.LENIENT)
    assert by_state(lenient) == {"ok": 4, "corregido": 2, "error": 2}
    got = dict(rows(lenient.where("estado = 'corregido'").select("nombre", "fecha_registro")))
    assert got == {"Pilar": dt.date(2024, 12, 5), "Hugo": dt.date(2025, 6, 1)}
    assert lenient.where("nombre = 'Pilar'").first().apellido == S.NO_SURNAME


def test_load_valid(staged, seed):
    v = I.validate_products(staged[0], seed["categorias"], seed["productos"])
    loaded = V.load_valid(v, S.NUEVO_PRODUCTO)
    assert loaded.schema.simpleString() == S.NUEVO_PRODUCTO.simpleString() and loaded.count() == 7
    c = V.load_valid(I.validate_clients(staged[1], seed["clientes"], RUN), S.NUEVO_CLIENTE)
    assert c.count() == 5 and c.where("nombre = 'Ramiro'").first().telefono is None


def test_reports(staged, seed):
    p = I.validate_products(staged[0], seed["categorias"], seed["productos"])
    c = I.validate_clients(staged[1], seed["clientes"], RUN)
    out = I.import_reports(p, c)
    assert rows(out["resumen"].where("entidad = 'Clientes'"), "estado", "cantidad") == [("ok", 4), ("corregido", 1), ("error", 3)]
    named = {}
    for state, name in rows(out["registros"].where("entidad = 'Clientes'"), "estado", "registro"):
        named.setdefault(state, []).append(name)
    assert named == {"ok": ["Julieta Paz", "Ramiro Sosa", "Noelia Quiroga", "Iván Ferreyra"],
                     "corregido": ["Pilar (sin apellido)"], "error": ["Sofi L.", "Hugo Ledesma", "Irene Bravo"]}
    assert rows(out["contadores"], "entidad", "leidos", "insertados", "descartados", "corregidos") == [
        ("Productos", 14, 7, 7, 1), ("Clientes", 8, 5, 3, 1)]
    assert rows(out["totales"]) == [(10, 2)]
    assert out["problemas"].count() == 12
    assert rows(out["tasa_error"]) == [("Productos", 14, 7, 50.0, True), ("Clientes", 8, 3, 37.5, True)]
    kinds = {(e, r): n for e, r, _, n in rows(out["tipos"])}
    assert kinds[("Productos", "duplicado")] == 3 and kinds[("Clientes", "fecha_invalida")] == 1


def test_summary_has_one_shape(staged, seed):
    v = I.validate_products(staged[0], seed["categorias"], seed["productos"])
    counts = dict(rows(V.status_counts(v, "Productos"), "estado", "cantidad"))
    named = rows(V.status_names(v, "Productos", I.product_label()), "fila", "estado", "registro")
    assert counts["ok"] == 6 and sum(counts.values()) == len(named) == 14
    assert [f for f, _, _ in named] == sorted(f for f, _, _ in named)
    assert sum(e == "ok" for _, e, _ in named) == 6


def product(spark, *data):
    cols = "fila bigint, id_categoria string, nombre string, descripcion string, precio string, stock string, activo string"
    return spark.createDataFrame(data, cols)


def test_repairs(spark, seed):
    raw = product(spark, (1, "1", "Coma", None, "12,50", "4", "true"), (2, "1", "Stock", None, "1", "n/a", "FALSE"),
                  (3, "1", "Negativo", None, "1", "-4", None), (4, "1", "Bool", None, "1", None, "si"),
                  (5, "1", "Doble", None, "-1,5", "1", "0"))
    v = I.validate_products(raw, seed["categorias"], seed["productos"], I.LENIENT).orderBy("fila")
    got = rows(v, "precio", "stock", "activo", "estado")
    assert got == [(12.5, 4, True, "corregido"), (1, 0, False, "corregido"), (1, 0, True, "corregido"),
                   (1, 0, True, "corregido"), (0, 1, False, "corregido")]
    assert [len(r.issues) for r in v.collect()] == [1, 1, 1, 2, 2]


def test_lenient_numbers(spark, seed):
    texts = ["+5", ".5", "5.", "1e3", "-1E1", "1,5e1", " 7 ", "1 2", "e3", ".", "1.2.3", "0x10", "", "9e99"]
    raw = product(spark, *[(i, "1", f"N{i}", None, t, "1", "1") for i, t in enumerate(texts)])
    got = dict(rows(I.validate_products(raw, seed["categorias"], seed["productos"], I.LENIENT).where("estado <> 'error'"), "fila", "precio"))
    assert got == {0: 5, 1: 0.5, 2: 5, 3: 1000, 4: 0, 5: 15, 6: 7}
    strict = I.validate_products(raw, seed["categorias"], seed["productos"])
    assert sorted(r.fila for r in strict.where("estado <> 'error'").collect()) == [6]


def test_batch_duplicates_first_accepted_wins(spark, seed):
    raw = product(spark, (1, "9", "Nuevo", None, "1", "1", "1"), (2, "1", "nuevo ", None, "1", "1", "1"),
                  (3, "1", "NUEVO", None, "1", "1", "1"), (4, "9", "Nuevo", None, "1", "1", "1"),
                  (5, "1", None, None, "1", "1", "1"), (6, "1", None, None, "1", "1", "1"))
    v = I.validate_products(raw, seed["categorias"], seed["productos"], I.LENIENT)
    assert reasons(v) == {1: "clave_foranea", 3: "duplicado_lote", 4: "duplicado_lote", 5: "obligatorio",
                          6: "obligatorio"}


def test_accents_count_for_the_lenient_policy_only(spark, seed):
    raw = product(spark, (1, "3", "CAFE MOLIDO 500G", None, "1", "1", "1"), (2, "3", "CAFÉ molido 500g", None, "1", "1", "1"))
    strict = I.validate_products(raw, seed["categorias"], seed["productos"])
    assert reasons(strict) == {1: "duplicado", 2: "duplicado"}
    lenient = I.validate_products(raw, seed["categorias"], seed["productos"], I.LENIENT)
    assert reasons(lenient) == {2: "duplicado"}


def test_key_folds_any_letter(spark):
    df = spark.createDataFrame([("Škoda", " skoda"), ("Ýr", "yr"), ("Ñandú", "NANDU")], "a string, b string")
    assert df.where(accent_free_key(F.col("a")) == accent_free_key(F.col("b"))).count() == 3


def test_short_rows_are_read(spark, tmp_path):
    (tmp_path / "p.csv").write_text(PRODUCTS.splitlines()[0] + '\n1,"Short, name",d,1.00\n1,Long,d,1.00,2,1,extra\n1,Full,d,1.00,2,0\n')
    good, bad = files.split_corrupt(files.read_products_csv(spark, str(tmp_path / "p.csv")), "Productos")
    assert sorted(rows(good, "nombre", "stock", "activo")) == [("Full", "2", "0"), ("Short, name", None, None)]
    assert rows(bad, "valor") == [("1,Long,d,1.00,2,1,extra",)]


def test_missing_price_is_rejected(spark, seed):
    raw = product(spark, (1, "1", "A", None, None, "1", "1"), (2, "x", "B", None, "1", "1", "1"))
    assert reasons(I.validate_products(raw, seed["categorias"], seed["productos"])) == {
        1: "no_numerico", 2: "clave_invalida"}


def client(spark, *data):
    cols = "fila bigint, nombre string, apellido string, email string, telefono string, direccion string, fecha_registro string"
    return spark.createDataFrame(data, cols)


def test_dates(spark, seed):
    texts = ["2024-1-2", "1/2/2024", "12/25/2024", "20240315", "2999-01-01", "", None, "31/12/2024"]
    raw = client(spark, *[(i, "N", "A", f"m{i}@x.com", None, None, t) for i, t in enumerate(texts)])
    v = I.validate_clients(raw, seed["clientes"], RUN, I.LENIENT).orderBy("fila")
    got = rows(v, "fecha_registro", "estado")
    run = dt.date(2025, 6, 1)
    assert got == [(dt.date(2024, 1, 2), "ok"), (dt.date(2024, 2, 1), "corregido"),
                   (dt.date(2024, 12, 25), "corregido"), (dt.date(2024, 3, 15), "corregido"), (run, "corregido"),
                   (run, "corregido"), (run, "corregido"), (dt.date(2024, 12, 31), "corregido")]


def test_warnings_before_a_rejection_are_reported(spark, seed):
    raw = client(spark, (1, "N", "", "bad", None, None, "2024-01-01"))
    row = I.validate_clients(raw, seed["clientes"], RUN, I.LENIENT).first()
    assert row.estado == "error" and [i.severidad for i in row.issues] == ["warning", "error"]


def test_empty_email(spark, seed):
    raw = client(spark, (1, "N", "A", " ", None, None, "2024-01-01"), (2, "N", "A", None, None, None, "2024-01-01"))
    assert reasons(I.validate_clients(raw, seed["clientes"], RUN, I.LENIENT)) == {1: "obligatorio", 2: "obligatorio"}


def test_revalidate_rejects(staged, seed):
    first = I.validate_products(staged[0], seed["categorias"], seed["productos"])
    spark = staged[0].sparkSession
    more = seed["categorias"].unionByName(spark.createDataFrame([(9, "Papelería", None)], S.CATEGORIAS))
    again = V.revalidate(first, lambda df: I.validate_products(df, more, seed["productos"]))
    assert by_state(again) == {"ok": 1, "error": 6}
    assert again.where("estado = 'ok'").first().precio == Decimal("950.50")


def test_malformed_json(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"nombre": "x", ')
    good, bad = files.split_corrupt(files.read_clients_json(spark, str(tmp_path / "bad.json")), "Clientes")
    assert good.count() == 0 and rows(bad, "regla") == [("archivo_malformado",)]


def test_row_number_from_the_file(spark, tmp_path):
    (tmp_path / "p.csv").write_text("n," + PRODUCTS.splitlines()[0] + "\n77,1,A,B,1,1,1\n")
    assert files.read_products_csv(spark, str(tmp_path / "p.csv"), row_id="n").first().fila == 77
