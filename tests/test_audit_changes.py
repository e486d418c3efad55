import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwork import schema as S
from tillwork.operators import audit as A, changes as G

T0 = dt.datetime(2025, 1, 1, 10)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def trail(spark, seed):
    logins = [(1, "hacker_user", "192.168.1.99", 1, False, "x", at(0)), (2, "hacker_user", "192.168.1.99", 2, False, "x", at(1)),
              (3, "hacker_user", "192.168.1.99", 3, True, "x", at(2)), (4, "db_vendedor", "10.0.0.5", 1, False, "x", at(3))]
    grants = [(1, "GRANT", "SELECT", "t", "db_auditor", "db_admin", False, "EXITOSO", None, at(4), "GRANT SELECT ON t TO db_auditor"),
              (2, "REVOKE", "SELECT", "t", "db_auditor", "db_admin", True, "ERROR", "e", at(5), "REVOKE SELECT ON t FROM db_auditor")]
    requests = spark.createDataFrame(
        [(1, 1, A.ADMIN, "h", at(6)), (2, 2, "db_vendedor@localhost", "h", at(7)), (3, 99, A.ADMIN, "h", at(8)),
         (4, 98, "otro", "h", at(9))],
        "id_evento int, id_venta int, usuario_bd string, host_origen string, fecha_evento timestamp_ntz")
    audited = A.audit_deletes(requests, seed["ventas"])
    done, refused = A.split_deletes(requests, seed["ventas"])
    return {"logins": spark.createDataFrame(logins, S.AUDIT_LOGINS), "grants": spark.createDataFrame(grants, S.AUDIT_GRANTS),
            "deletes": done, "blocked": refused, "audited": audited}


def test_deletes(trail):
    got = {r.id_evento: r for r in trail["audited"].collect()}
    assert {k: r.resultado for k, r in got.items()} == {1: "EXITOSO", 2: "BLOQUEADO", 4: "BLOQUEADO"}
    image = json.loads(got[1].datos_eliminados)
    assert image == {"id_venta": 1, "id_cliente": 1, "id_usuario": 2, "total": 93500.0, "estado": "entregada",
                     "fecha_venta": "2024-08-01 10:30:00"}
    assert got[2].datos_eliminados is None and got[2].motivo_bloqueo == A.DENIED and got[1].motivo_bloqueo is None


def test_delete_image_keeps_nulls(spark, seed):
    v = seed["ventas"].withColumn("total", F.lit(None).cast(S.MONEY))
    r = spark.createDataFrame([(1, 1, A.ADMIN, "h", at(0))],
                              "id_evento int, id_venta int, usuario_bd string, host_origen string, fecha_evento timestamp_ntz")
    assert json.loads(A.audit_deletes(r, v).first().datos_eliminados)["total"] is None


def test_feed(trail):
    until = F.lit(at(60)).cast("timestamp_ntz")
    feed = A.audit_feed(trail, until=until)
    assert feed.columns == A.FEED
    assert dict(rows(feed.groupBy("categoria_evento").count())) == {
        "DELETE_VENTAS": 1, "DELETE_VENTAS_BLOQUEADO": 2, "PERMISO_GRANT": 1, "PERMISO_REVOKE": 1, "LOGIN_FALLIDO": 4}
    one = lambda **k: rows(A.audit_feed(trail, until=until, **k), "categoria_evento", "id_evento")
    assert len(one(category="DELETE")) == 3 and len(one(category="GRANT")) == 2
    assert len(one(category="LOGIN_FALLIDO")) == 4 and len(one(user="HACKER_user")) == 3
    assert len(one(user="%")) == 0
    assert len(one(since=at(9).isoformat(" "))) == 1
    assert len(rows(A.audit_feed(trail, until=F.lit(at(2)).cast("timestamp_ntz")))) == 3
    locked = feed.where("id_evento = 3 and categoria_evento = 'LOGIN_FALLIDO'").first()
    assert (locked.succeeded, locked.statement, locked.additional_info) == (
        "BLOQUEADO", "CONNECT AS hacker_user", "Intento #3 – cuenta bloqueada")
    revoked = feed.where("categoria_evento = 'PERMISO_REVOKE'").first()
    assert revoked.additional_info == "Beneficiario: db_auditor WITH GRANT OPTION"
    with pytest.raises(ValueError):
        A.audit_feed(trail, category="X")


def test_feed_as_table_function(spark, trail):
    A.register_feed_function(spark, trail)
    n = lambda args: spark.sql(f"SELECT * FROM fn_get_audit_file({args})").count()
    assert n("'TODAS', NULL, NULL, NULL") == 9
    assert n("'DELETE', NULL, NULL, NULL") == 3 and n("'GRANT', NULL, NULL, NULL") == 2
    assert n("'TODAS', NULL, NULL, 'hacker_user'") == 3
    assert n("'TODAS', TIMESTAMP_NTZ'2025-01-01 10:09:00', NULL, NULL") == 1


def test_summary(trail):
    assert rows(A.audit_summary(trail), "categoria", "total_eventos", "bloqueados") == [
        ("DELETE Bloqueado", 2, 2), ("DELETE en Ventas", 1, 0), ("Login Fallidos", 4, 1), ("Permisos (GRANT)", 1, 0),
        ("Permisos (REVOKE)", 1, 1)]


def test_reports(spark, trail):
    assert rows(A.delete_report(trail["audited"]), "id_evento") == [(4,), (2,), (1,)]
    assert rows(A.privilege_report(trail["grants"]), "id_evento") == [(2,), (1,)]
    assert rows(A.top_threats(trail["logins"]), "usuario_intento", "total_intentos", "max_intentos_seguidos",
                "veces_bloqueado") == [("hacker_user", 3, 3, 1), ("db_vendedor", 1, 1, 0)]
    config = spark.createDataFrame(
        [("a", "GRANT_REVOKE", "audit_permisos", True, T0, "x", "y"), ("a", "DELETE", "audit_delete_ventas", True, T0, "x", "y"),
         ("a", "FAILED_LOGIN", "audit_login_fallidos", False, T0, "x", "y")], S.AUDIT_CONFIG)
    assert rows(A.audit_config_report(config), "accion") == [("DELETE",), ("FAILED_LOGIN",), ("GRANT_REVOKE",)]
    assert A.audit_config_report(config, active_only=True).count() == 2
    feed = A.categorise(A.audit_feed(trail, until=F.lit(at(60)).cast("timestamp_ntz")), config)
    assert dict(rows(feed.groupBy("tabla_destino").count())) == {
        "audit_delete_ventas": 3, "audit_permisos": 2, None: 4}


def test_statement(spark):
    df = spark.createDataFrame([("GRANT", True), ("GRANT", False), ("REVOKE", True)], "a string, w boolean")
    got = df.select(A.grant_statement(F.col("a"), F.lit("SELECT"), F.lit("t"), F.lit("u"), F.col("w")))
    assert [r[0] for r in got.collect()] == ["GRANT SELECT ON t TO u WITH GRANT OPTION", "GRANT SELECT ON t TO u",
                                            "REVOKE SELECT ON t FROM u"]


def test_protected(seed):
    kept, free = A.protected_products(seed["productos"], seed["detalle_ventas"])
    assert kept.count() == 11 and free.count() == 0
    kept, free = A.protected_products(seed["productos"], seed["detalle_ventas"].where("id_producto < 4"))
    assert sorted(rows(kept, "id_producto")) == [(1,), (2,), (3,)] and free.count() == 8


def test_failure_streaks(spark):
    data = [(1, "a", False), (2, "a", False), (3, "a", True), (4, "a", False), (5, "b", False), (6, "a", False),
            (7, "a", False), (8, "a", False), (9, "b", True)]
    df = spark.createDataFrame([(i, u, s, T0 + dt.timedelta(hours=i)) for i, u, s in data],
                               "id_evento int, usuario string, exitoso boolean, fecha_evento timestamp_ntz")
    got = rows(A.failure_streaks(df).orderBy("id_evento"), "id_evento",
               "intentos_cuenta", "bloqueado")
    assert got == [(1, 1, False), (2, 2, False), (4, 1, False), (5, 1, False), (6, 2, False), (7, 3, True), (8, 4, True)]


def test_sale_audit(seed):
    new = G.new_rows(seed["ventas"], seed["ventas"].where("id_venta < 8"), "id_venta")
    r = G.sale_audit(new, "db_vendedor", F.lit(T0).cast("timestamp_ntz")).first()
    assert r.detalle == "Venta #8 registrada para cliente id=7 | usuario id=2 | total=$12,000.00 | estado=confirmada"


def test_price_changes(seed):
    old = seed["productos"]
    new = (old.withColumn("precio", F.when(F.col("id_producto") == 1, F.col("precio") * F.lit("1.10").cast("decimal(3,2)"))
                          .otherwise(F.col("precio")).cast(S.PRICE))
           .withColumn("stock", F.col("stock") - F.when(F.col("id_producto") == 2, 1).otherwise(0)))
    assert rows(G.price_changes(old, new)) == [(1, "Smartphone X12", 75000, 82500, 7500, 10)]
    free = old.withColumn("precio", F.lit(0).cast(S.PRICE))
    assert {p for _, p in rows(G.price_changes(free, old), "id_producto", "porcentaje_cambio")} == {None}


def test_price_history(spark):
    data = [(1, 1, 10), (2, 1, 10), (3, 1, 12), (4, 2, 5), (5, 1, 0), (6, 1, 3)]
    df = spark.createDataFrame([(i, k, Decimal(p), T0 + dt.timedelta(hours=i)) for i, k, p in data],
                               "id int, k int, precio decimal(10,2), ts timestamp_ntz")
    got = rows(G.price_history(df, "k", ["ts", "id"]).orderBy("id"), "id", "precio_anterior",
               "precio_nuevo", "diferencia", "porcentaje_cambio")
    assert got == [(3, 10, 12, 2, 20), (5, 12, 0, -12, -100), (6, 0, 3, 3, None)]
