import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwork import schema as S
from tillwork.plans import reports as R, star


@pytest.fixture(scope="module")
def dw(spark, seed):
    calendar = star.dim_date(spark, dt.date(2024, 1, 1), dt.date(2026, 12, 31))
    dim_c = star.dim_customer(seed["clientes"], seed["ventas"])
    dim_p = star.dim_product(seed["productos"], seed["categorias"])
    fact = star.fact_sales(seed["ventas"], seed["detalle_ventas"], dim_c, dim_p)
    return {k: v.cache() for k, v in dict(calendar=calendar, dim_c=dim_c, dim_p=dim_p, fact=fact).items()}


def test_calendar(dw):
    assert dw["calendar"].count() == 1096
    day = dw["calendar"].where("id_tiempo = 20241230").first()
    assert (day.anio, day.semana_anio, day.nombre_mes, day.nombre_dia, day.dia_semana, day.es_fin_semana,
            day.anio_mes, day.trimestre) == (2024, 1, "Diciembre", "Lunes", 1, False, "2024-12", 4)
    assert dw["calendar"].where("id_tiempo = 20240804").first().nombre_dia == "Domingo"


def test_calendar_ignores_known_days(spark, dw):
    more = star.dim_date(spark, dt.date(2026, 12, 30), dt.date(2027, 1, 2))
    assert star.extend_dim_date(dw["calendar"], more).count() == 1098


def test_empty_calendar(spark):
    assert star.dim_date(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0


def test_dim_customer(dw):
    got = rows(dw["dim_c"].orderBy("id_cliente_sk"), "id_cliente_sk", "nombre_completo", "ciudad", "segmento")
    assert got[0] == (1, "Ana García", "Córdoba", "OCASIONAL")
    assert got[3] == (4, "Carlos Fernández", "Cba.", "OCASIONAL")
    assert got[4] == (5, "Valeria Ruiz", "Villa Allende", "NUEVO")


def test_dim_product(dw):
    got = dict(rows(dw["dim_p"], "nombre_producto", "rango_precio"))
    assert got["Smartphone X12"] == "PREMIUM" and got["Silla ergonómica"] == "MEDIO"
    assert got["Remera básica"] == "ECONOMICO"


def test_fact(dw):
    got = rows(dw["fact"].orderBy("id_venta_nk", "id_producto_nk"), "id_venta_nk", "id_producto_nk",
               "monto_bruto_linea", "descuento_pct", "monto_descuento", "monto_neto_linea")
    assert got == [
        (1, 1, 75000, 0, 0, 75000), (1, 3, 18500, 0, 0, 18500), (2, 4, 7000, -0.65, -45.45, 7045.45),
        (2, 6, 8400, -0.65, -54.55, 8454.55), (3, 2, 320000, -1.15, -3667.91, 323667.91),
        (3, 6, 2800, -1.15, -32.09, 2832.09), (4, 8, 45000, 0, 0, 45000), (5, 3, 18500, 29.04, 5373.16, 13126.84),
        (5, 9, 8700, 29.04, 2526.84, 6173.16), (7, 5, 12000, 7.21, 865.57, 11134.43),
        (7, 9, 8700, 7.21, 627.54, 8072.46), (7, 11, 9800, 7.21, 706.89, 9093.11), (8, 5, 12000, 0, 0, 12000)]


def test_fact_net_adds_up_to_the_sale(dw):
    for sale in star.rounding_residual(dw["fact"]).collect():
        assert abs(sale.residuo) <= Decimal("0.01") * sale.lineas


def test_monthly(dw):
    got = rows(R.monthly_sales(dw["fact"], dw["calendar"]), "periodo", "cantidad_ventas", "unidades_vendidas",
               "monto_bruto", "total_descuentos", "monto_neto", "ticket_promedio", "ticket_por_venta")
    assert got == [
        ("2024-08", 3, 9, 431700, -3800, 435500, 145166.67, 145166.67),
        ("2024-09", 2, 3, 72200, 7900, 64300, 27866.67, 32150),
        ("2024-10", 2, 4, 42500, 2200, 40300, 24225, 20150)]


def test_top_products(dw):
    got = rows(R.top_products(dw["fact"], dw["dim_p"]), "nombre_producto", "unidades_vendidas", "monto_neto_total",
               "apariciones_en_ventas", "pct_sobre_total")
    assert [(g[0].split()[0], *g[1:]) for g in got] == [
        ("Laptop", 1, 323667.91, 1, 59.93), ("Smartphone", 1, 75000, 1, 13.89), ("Silla", 1, 45000, 1, 8.33),
        ("Auriculares", 2, 31626.84, 2, 5.86), ("Campera", 2, 23134.43, 2, 4.28), ("Lámpara", 2, 14245.62, 2, 2.64),
        ("Café", 4, 11286.64, 2, 2.09), ("Mochila", 1, 9093.11, 1, 1.68), ("Remera", 2, 7045.45, 1, 1.30)]


def test_category_rollup(dw):
    got = rows(R.category_rollup(dw["fact"], dw["dim_p"]), "categoria", "ventas", "unidades", "bruto", "descuentos",
               "neto", "pct_categoria")
    assert got == [
        (S.TOTAL_LABEL, 7, 16, 546400, 6300, 540100, 50.00),
        ("Electrónica", 3, 4, 432000, 1705.25, 430294.75, 39.83),
        ("Hogar", 3, 3, 62400, 3154.38, 59245.62, 5.48), ("Ropa", 3, 4, 31000, 820.12, 30179.88, 2.79),
        ("Alimentos", 2, 4, 11200, -86.64, 11286.64, 1.04), ("Deportes", 1, 1, 9800, 706.89, 9093.11, 0.84)]
    real = rows(R.category_rollup(dw["fact"], dw["dim_p"]), "pct_real")
    assert real[0] == (100.0,) and real[1] == (79.67,)


def test_customer_ranking(dw):
    got = rows(R.customer_ranking(dw["fact"], dw["dim_c"], dw["calendar"]), "ranking", "nombre_completo",
               "total_compras", "gasto_total_neto", "ticket_por_venta", "descuentos_obtenidos", "dias_como_cliente")
    assert [(g[0], g[1].split()[0], *g[2:]) for g in got] == [
        (1, "Sofía", 1, 326500, 326500, -3700, 0), (2, "Ana", 2, 112800, 56400, 7900, 45),
        (3, "Carlos", 1, 45000, 45000, 0, 0), (4, "Mateo", 1, 28300, 28300, 2200, 0),
        (5, "Luis", 1, 15500, 15500, -100, 0), (6, "Luciana", 1, 12000, 12000, 0, 0)]


def test_quarterly(dw):
    got = rows(R.quarterly_change(dw["fact"], dw["calendar"]), "periodo", "neto_trimestre",
               "neto_trimestre_anterior", "variacion_absoluta", "variacion_pct")
    assert got == [("2024 Q3", 499800, None, None, None), ("2024 Q4", 40300, 499800, -459500, -91.94)]


def test_oltp_and_star_agree(seed, dw):
    a = R.month_category_oltp(seed)
    b = R.month_category_dw(dw["fact"], dw["calendar"], dw["dim_p"])
    assert a.count() == b.count() > 0
    diff = R.reconcile(a, b, ["periodo", "categoria"])
    assert diff.where("presente <> 'ambos' or dif_ventas <> 0 or dif_unidades <> 0 or dif_monto_bruto <> 0 "
                      "or dif_monto_neto <> 0").count() == 0


def test_reconcile_sees_differences(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, n int")
    b = spark.createDataFrame([("x", 3), ("y", 4)], "k string, n int")
    got = sorted(rows(R.reconcile(a, b, ["k"])), key=str)
    assert got == sorted([("x", "ambos", -2), (None, "solo_a", 2), ("y", "solo_b", -4)], key=str)


def test_concentration(dw):
    got = rows(R.concentration(R.product_sales(dw["fact"], dw["dim_p"])), "puesto", "pct", "pct_acumulado")
    assert got[0] == (1, 59.93, 59.93) and got[1] == (2, 13.89, 73.81) and got[-1][2] == 100.0


def test_extremes(dw):
    got = rows(R.extremes(R.monthly_sales(dw["fact"], dw["calendar"]), "periodo", "monto_neto"))
    assert got == [("2024-08", 435500, "2024-10", 40300)]


def test_segment_check(dw):
    got = rows(R.segment_check(R.customer_ranking(dw["fact"], dw["dim_c"]), top=4), "ranking", "nombre_completo")
    assert sorted(got) == [(1, "Sofía López"), (4, "Mateo Díaz")]


def test_run_etl(spark, seed, tmp_path):
    log = rows(star.run_etl(seed, str(tmp_path), dt.date(2024, 1, 1), dt.date(2026, 12, 31)), "tabla", "filas")
    assert log == [("DimTiempo", 1096), ("DimCliente", 7), ("DimProducto", 11), ("HechoVentas", 13)]
    again = rows(star.run_etl(seed, str(tmp_path), dt.date(2024, 1, 1), dt.date(2026, 12, 31)), "filas")
    assert [n for n, in again] == [1096, 7, 11, 13]
    stored = spark.read.parquet(f"{tmp_path}/HechoVentas")
    plan = stored.where(F.col("anio_venta") == 2024)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(anio_venta" in plan


def test_an_amount_of_too_many_digits_stops_nothing(spark, seed):
    from tillwork.plans import star
    huge = spark.createDataFrame([(99, 1, 1, 2_000_000_000, Decimal("99999999.99"))], seed["detalle_ventas"].schema)
    lines = star.apportioned_lines(seed["ventas"], seed["detalle_ventas"].unionByName(huge))
    got = dict(rows(lines.where("id_venta = 1"), "cantidad", "monto_bruto_linea"))
    assert got[2_000_000_000] is None and got[1] is not None


def test_bucketed_lines_stay_where_they_are(spark, seed, tmp_path):
    from tillwork.plans import star
    from tillwork.sources import layout
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cubos LOCATION '{tmp_path}'")
    layout.write_bucketed(seed["detalle_ventas"], "cubos.lineas", "id_venta", 4)
    layout.write_bucketed(seed["ventas"], "cubos.ventas", "id_venta", 4)
    t = layout.read_tables(spark, {"l": "cubos.lineas", "v": "cubos.ventas"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = star.apportioned_lines(t["v"], t["l"])
        plan = found._jdf.queryExecution().sparkPlan().toString()
        executed = found._jdf.queryExecution().executedPlan().toString()
        # headers alone are exchanged; of lines, neither the sums per sale nor the join moves one
        moved = [part for part in executed.split("Exchange hashpartitioning")[1:]]
        assert len(moved) <= 1 and plan.count("cubos.lineas") == 2
        want = star.apportioned_lines(seed["ventas"], seed["detalle_ventas"])
        assert sorted(rows(found, "id_venta", "id_producto", "monto_neto_linea")) == sorted(
            rows(want, "id_venta", "id_producto", "monto_neto_linea"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE cubos CASCADE")


def _stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sales(spark, seed, tmp_path):
    dim_c, dim_p = star.dim_customer(seed["clientes"], seed["ventas"]), star.dim_product(seed["productos"], seed["categorias"])
    fact = star.fact_sales(seed["ventas"], seed["detalle_ventas"], dim_c, dim_p)
    return _stored(fact, tmp_path / "fact"), dim_c, dim_p, star.dim_date_of(seed["ventas"])


def test_rows_are_rebalanced_before_they_are_wide(spark, seed):
    dim_c, dim_p = star.dim_customer(seed["clientes"], seed["ventas"]), star.dim_product(seed["productos"], seed["categorias"])
    fact = star.fact_sales(seed["ventas"], seed["detalle_ventas"], dim_c, dim_p, layout="anio_venta")
    above, below = fact._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions", 1)
    assert "monto_neto_linea" in above and "anio_venta" in below
    assert not any(c in below for c in ("monto_neto_linea", "descuento_pct", "trimestre_venta"))


def test_concentration_reads_its_report_once(spark, seed, tmp_path):
    fact, _, dim_p, _ = _sales(spark, seed, tmp_path)
    found = R.concentration(R.product_sales(fact, dim_p))
    assert not set(found.inputFiles()) & set(fact.inputFiles()) and found.count() > 1


@pytest.mark.parametrize("name", ["product_sales", "category_rollup", "month_category_dw"])
def test_distinct_sales_are_counted_without_the_sums(spark, seed, tmp_path, name):
    fact, _, dim_p, calendar = _sales(spark, seed, tmp_path)
    report = R.month_category_dw(fact, calendar, dim_p) if name == "month_category_dw" else getattr(R, name)(fact, dim_p)
    per_sale = [l for l in _plan(report).splitlines() if "HashAggregate(keys=[" in l and "id_venta_nk" in l.split("functions=")[0]]
    assert per_sale and all("functions=[]" in l for l in per_sale) and "monto_neto" in _plan(report)
