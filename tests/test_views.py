from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwork import schema as S
from tillwork.operators import constraints as K, views as V


def test_active_products(seed):
    off = seed["productos"].withColumn("activo", F.col("id_producto") != 1)
    got = dict(rows(V.active_products(off, seed["categorias"]), "id_producto", "categoria"))
    assert len(got) == 10 and got[11] == "Deportes" and 1 not in got


def test_contacts_and_summary(seed):
    assert V.customer_contacts(seed["clientes"]).where("id_cliente = 1").first().nombre_completo == "Ana García"
    assert V.sales_summary(seed["ventas"]).columns == ["id_venta", "fecha_venta", "estado", "total"]


def test_sale_detail(seed):
    d = V.sale_detail(seed)
    assert d.count() == 15
    r = d.where("id_venta = 2 and producto like 'Remera%'").first()
    assert (r.cliente, r.vendedor, r.categoria, r.subtotal, r.total_venta) == (
        "Luis Martínez", "vendedor1", "Ropa", Decimal("7000.00"), Decimal("15500.00"))


def test_sales_by_customer(seed):
    got = rows(V.sales_by_customer(seed["clientes"], seed["ventas"]), "cliente", "total_compras", "monto_total")
    assert got[0] == ("Sofía López", 1, 326500) and got[1] == ("Ana García", 2, 112800)
    assert got[-1] == ("Valeria Ruiz", 0, None) and len(got) == 7


def test_product_ranking(seed):
    got = rows(V.product_ranking(seed), "id_producto", "unidades_vendidas", "ingresos_totales", "veces_en_venta")
    assert got == [(6, 4, 11200, 2), (3, 2, 37000, 2), (4, 2, 7000, 1), (5, 2, 24000, 2), (9, 2, 17400, 2),
                   (1, 1, 75000, 1), (2, 1, 320000, 1), (8, 1, 45000, 1), (11, 1, 9800, 1)]


def test_seller_performance(seed):
    got = sorted(rows(V.seller_performance(seed["usuarios"], seed["ventas"]), "vendedor", "ventas_realizadas",
                      "monto_total_vendido", "ticket_promedio"))
    assert got == [("admin", 0, None, None), ("supervisor", 0, None, None), ("vendedor1", 4, 166000, 41500),
                   ("vendedor2", 3, 374100, 124700)]


def test_complete_orders(seed):
    assert V.complete_orders(seed).count() == 15
    assert sorted(rows(V.complete_orders(seed, sale=7), "id_producto", "subtotal_linea")) == [
        (5, 12000), (9, 8700), (11, 9800)]


def test_lists_and_lookups(spark, seed):
    assert rows(V.sale_list(seed["ventas"], seed["clientes"], seed["usuarios"]), "id_venta") == [(i,) for i in range(1, 9)]
    got = V.stock_of_sold(seed["productos"], seed["detalle_ventas"], seed["ventas"].where("id_venta = 7"))
    assert sorted(rows(got, "id_producto", "stock")) == [(5, 60), (9, 90), (11, 45)]
    assert rows(V.latest(seed["ventas"], ["fecha_venta", "id_venta"], 2), "id_venta") == [(8,), (7,)]
    assert rows(V.latest(seed["ventas"], ["fecha_venta"], 1, F.col("id_cliente") == 1), "id_venta") == [(5,)]


def test_check_option(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, activo boolean")
    ok, refused = V.check_option(df, F.col("activo"))
    assert rows(ok, "id") == [(1,)] and sorted(rows(refused, "id")) == [(2,), (3,)]


def test_roles(seed):
    users = seed["usuarios"]
    assert "password_hash" not in V.project_for_role(users, "usuarios", "rol_auditor").columns
    assert V.project_for_role(users, "usuarios", "rol_administrador").columns == users.columns
    with pytest.raises(PermissionError):
        V.project_for_role(users, "usuarios", "rol_vendedor")
    assert "rol_vendedor_usuarios" not in V.publish_for_role(seed, "rol_vendedor")


def test_published_views(spark, seed):
    V.publish_views(spark, seed)
    got = rows(spark.sql("SELECT cliente, monto_total FROM v_ventas_por_cliente ORDER BY monto_total DESC LIMIT 1"))
    assert got == [("Sofía López", 326500)]
    assert spark.sql("SELECT * FROM v_detalle_ventas_completo").count() == 15
    got = rows(spark.sql("SELECT fn_calcular_total_venta(200000, fn_calcular_descuento(200000, 8, 1))"))
    assert got == [(164000,)]


def test_constraint_audit(spark, seed):
    assert {n for _, n in rows(K.constraint_audit(seed))} == {0}
    bad = dict(seed)
    bad["ventas"] = seed["ventas"].unionByName(spark.createDataFrame(
        [(1, 99, 2, None, Decimal(-5), "rara", None)], "id_venta int, id_cliente int, id_usuario int, "
        "fecha_venta timestamp_ntz, total decimal(12,2), estado string, observaciones string"))
    bad["detalle_ventas"] = seed["detalle_ventas"].withColumn("cantidad", F.when(F.col("id_detalle") > 2, F.col("cantidad")).otherwise(0))
    bad["clientes"] = seed["clientes"].withColumn("email", F.lit("X@y.com"))
    got = {k: n for k, n in rows(K.constraint_audit(bad)) if n}
    assert got == {"pk_ventas": 1, "fk_venta_cliente": 1, "nn_ventas": 1, "chk_total": 1, "enum_estado": 1, "chk_cantidad": 2,
                   "uq_clientes_email": 6}
