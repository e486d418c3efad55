"""Analytic reports over the star schema, and the checks that compare them.

Money stays DECIMAL throughout. Shares and ranks over all rows never use a window without
a partition on anything that grows with customers or products: totals are scalars, and
ranks go through ``operators.sequence``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwork import schema as S
from tillwork.functions import dates, money
from tillwork.operators.sequence import rank_by, value_ladder
from tillwork.plans.star import apportioned_lines
from tillwork.session import settle

_SUMS = {"unidades": "cantidad", "bruto": "monto_bruto_linea", "descuentos": "monto_descuento",
         "neto": "monto_neto_linea"}


def _live(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("estado_venta") != S.CANCELLED)


def _sum(col: str, name: str) -> Column:
    return F.sum(col).alias(name)


def _visits(rows: DataFrame, *keys: str, name: str) -> DataFrame:
    """Distinct sales per key: pairs alone are shuffled, without the sums that a common aggregate would carry."""
    pairs = rows.where(F.col("id_venta_nk").isNotNull()).select(*keys, "id_venta_nk").distinct()
    return pairs.groupBy(*keys).agg(F.count("*").alias(name))


def _total(col: str) -> Column:
    return F.col(col).cast(S.TOTAL).alias(col)


def monthly_sales(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales, units and amounts per month.

    ``ticket_promedio`` averages over fact lines, as the report always did;
    ``ticket_por_venta`` counts every sale once. A sale has one day, so sales per day add
    up to sales per month, and the calendar joins one row per day, not one per line.
    """
    per_sale = _live(fact).groupBy("id_tiempo", "id_venta_nk").agg(
        F.count("*").alias("lineas"), F.max("total_venta").alias("total"), F.sum("total_venta").alias("por_linea"),
        *[_sum(c, n) for n, c in _SUMS.items()])
    per_day = per_sale.groupBy("id_tiempo").agg(
        F.count("*").alias("ventas"), _sum("total", "totales"), _sum("por_linea", "por_linea"),
        _sum("lineas", "lineas"), *[_sum(n, n) for n in _SUMS])
    month = calendar.select("id_tiempo", F.col("anio_mes").alias("periodo"), "anio", "mes", "nombre_mes")
    return (per_day.join(month, "id_tiempo").groupBy("periodo", "anio", "mes", "nombre_mes")
            .agg(*[_sum(n, n) for n in ("ventas", "totales", "por_linea", "lineas", *_SUMS)])
            .select("periodo", "anio", "mes", "nombre_mes", F.col("ventas").alias("cantidad_ventas"),
                    F.col("unidades").alias("unidades_vendidas"), F.col("bruto").cast(S.TOTAL).alias("monto_bruto"),
                    F.col("descuentos").cast(S.TOTAL).alias("total_descuentos"),
                    F.col("neto").cast(S.TOTAL).alias("monto_neto"),
                    money.average(F.col("por_linea"), F.col("lineas")).alias("ticket_promedio"),
                    money.average(F.col("totales"), F.col("ventas")).alias("ticket_por_venta"))
            .orderBy("anio", "mes"))


def product_sales(fact: DataFrame, dim_p: DataFrame) -> DataFrame:
    """Every product that sold, with its share of the total over all products.

    Lines are folded per product before the dimension is joined; the total reads one column.
    """
    rows = _live(fact)
    folded = rows.groupBy("id_producto_sk").agg(
        _sum("cantidad", "unidades_vendidas"), F.sum("monto_neto_linea").cast(S.TOTAL).alias("monto_neto_total"),
        F.sum("precio_unitario").alias("_p"), F.count("precio_unitario").alias("_n"))
    folded = (folded.join(_visits(rows, "id_producto_sk", name="_visits"), "id_producto_sk", "left")
              .withColumn("apariciones_en_ventas", F.coalesce("_visits", F.lit(0))))
    sold = folded.join(dim_p.select("id_producto_sk", "nombre_producto", "nombre_categoria", "rango_precio"),
                       "id_producto_sk")
    # every sold product has its row in the dimension, so the total needs neither the join nor the fold
    total = _live(fact).agg(F.sum("monto_neto_linea").cast(S.TOTAL)).scalar()
    return sold.select(
        "id_producto_sk", "nombre_producto", "nombre_categoria", "rango_precio", "unidades_vendidas",
        "monto_neto_total", money.average(F.col("_p"), F.col("_n")).alias("precio_promedio_venta"),
        "apariciones_en_ventas", money.percent(F.col("monto_neto_total"), total).alias("pct_sobre_total"))


def top_products(fact: DataFrame, dim_p: DataFrame, k: int = 10) -> DataFrame:
    return product_sales(fact, dim_p).orderBy(F.desc("monto_neto_total"), "id_producto_sk").limit(k)


def category_rollup(fact: DataFrame, dim_p: DataFrame) -> DataFrame:
    """Per category and in total, with shares.

    ``pct_categoria`` divides by the sum over all report rows, the total included, as the
    report always did; ``pct_real`` divides by the total. Lines are folded per category, and
    the distinct sales counted beside that, so the rollup expands one row per category.
    """
    rows = _live(fact).join(dim_p.select("id_producto_sk", "nombre_categoria"), "id_producto_sk")
    amounts = rows.groupBy("nombre_categoria").agg(*[_sum(c, n) for n, c in _SUMS.items()])
    both = amounts.unionByName(_visits(rows, "nombre_categoria", name="ventas"), allowMissingColumns=True)
    every_sale = rows.agg(F.count_distinct("id_venta_nk")).scalar()
    rolled = both.rollup("nombre_categoria").agg(
        F.grouping("nombre_categoria").alias("_total"), _sum("ventas", "ventas"), *[_sum(n, n) for n in _SUMS])
    rolled = rolled.withColumn("ventas", F.when(F.col("_total") == 1, every_sale).otherwise(F.coalesce("ventas", F.lit(0))))
    # one row per category: small by nature
    every = Window.partitionBy()
    grand = F.max(F.when(F.col("_total") == 1, F.col("neto"))).over(every)
    return rolled.select(
        F.when(F.col("_total") == 1, S.TOTAL_LABEL).otherwise(F.col("nombre_categoria")).alias("categoria"),
        F.col("_total").cast("int").alias("es_total"), "ventas", "unidades", _total("bruto"), _total("descuentos"),
        _total("neto"), money.percent(F.col("neto"), F.sum("neto").over(every)).alias("pct_categoria"),
        money.percent(F.col("neto"), grand).alias("pct_real"),
    ).orderBy(F.desc("neto"), F.desc("es_total"))


def customer_ranking(fact: DataFrame, dim_c: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Customers ranked by net spend.

    Customers are ranked over distinct amounts in chunks, so no task sees every customer.
    ``calendar`` narrows the report to days it contains; dates come from the day key.
    """
    rows = _live(fact)
    if calendar is not None:
        rows = rows.join(calendar.select("id_tiempo"), "id_tiempo", "left_semi")
    per_sale = rows.groupBy("id_cliente_sk", "id_venta_nk").agg(
        F.count("*").alias("lineas"), F.max("total_venta").alias("total"), F.sum("total_venta").alias("por_linea"),
        F.min("id_tiempo").alias("primero"), F.max("id_tiempo").alias("ultimo"),
        *[_sum(c, n) for n, c in _SUMS.items()])
    folded = per_sale.groupBy("id_cliente_sk").agg(
        F.count("*").alias("total_compras"), _sum("total", "totales"), _sum("por_linea", "por_linea"),
        _sum("lineas", "lineas"), F.min("primero").alias("primero"), F.max("ultimo").alias("ultimo"),
        *[_sum(n, n) for n in _SUMS]).withColumn("gasto_total_neto", F.col("neto").cast(S.TOTAL))
    ranked = rank_by(folded, "gasto_total_neto", "ranking")
    who = dim_c.select("id_cliente_sk", "nombre_completo", "segmento", "ciudad", "anio_registro")
    as_date = lambda c: F.make_date(F.call_function("div", F.col(c), F.lit(10000)).cast("int"),
                                    (F.call_function("div", F.col(c), F.lit(100)) % 100).cast("int"),
                                    (F.col(c) % 100).cast("int"))
    return ranked.join(who, "id_cliente_sk").select(
        "ranking", "id_cliente_sk", "nombre_completo", "segmento", "ciudad", "anio_registro", "total_compras",
        F.col("unidades").alias("unidades_compradas"), "gasto_total_neto",
        money.average(F.col("por_linea"), F.col("lineas")).alias("ticket_promedio"),
        money.average(F.col("totales"), F.col("total_compras")).alias("ticket_por_venta"),
        F.col("descuentos").cast(S.TOTAL).alias("descuentos_obtenidos"),
        as_date("primero").alias("primera_compra"), as_date("ultimo").alias("ultima_compra"),
        F.datediff(as_date("ultimo"), as_date("primero")).alias("dias_como_cliente"),
    ).orderBy("ranking", "id_cliente_sk")


def quarterly_change(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Net per quarter against the previous quarter that has sales."""
    per_day = _live(fact).groupBy("id_tiempo").agg(_sum("monto_neto_linea", "neto"))
    quarter = (per_day.join(calendar.select("id_tiempo", "anio", "trimestre"), "id_tiempo")
               .groupBy("anio", "trimestre").agg(F.sum("neto").cast(S.TOTAL).alias("neto_trimestre")))
    # four rows a year: the one window a single task may hold
    before = F.lag("neto_trimestre").over(Window.partitionBy().orderBy("anio", "trimestre"))
    seen = quarter.withColumn("neto_trimestre_anterior", before)
    change = (F.col("neto_trimestre") - F.col("neto_trimestre_anterior")).cast(S.TOTAL)
    return seen.select(
        "anio", "trimestre",
        F.concat(F.col("anio").cast("string"), F.lit(" Q"), F.col("trimestre").cast("string")).alias("periodo"),
        "neto_trimestre", "neto_trimestre_anterior", change.alias("variacion_absoluta"),
        money.percent(change, F.col("neto_trimestre_anterior")).alias("variacion_pct"),
    ).orderBy("anio", "trimestre")


_CELL = ["periodo", "categoria"]


def month_category_oltp(t: dict[str, DataFrame]) -> DataFrame:
    """Month by category straight from the operational tables."""
    product = (t["productos"].select("id_producto", "id_categoria")
               .join(t["categorias"].select("id_categoria", F.col("nombre").alias("categoria")), "id_categoria")
               .select("id_producto", "categoria"))
    lines = apportioned_lines(t["ventas"].select("id_venta", "fecha_venta", "total", "estado"), t["detalle_ventas"], product)
    return (lines.withColumn("periodo", dates.month_key(F.col("fecha_venta")))
            .groupBy(*_CELL)
            .agg(F.count_distinct("id_venta").alias("ventas"), _sum("cantidad", "unidades"),
                 F.sum("monto_bruto_linea").cast(S.TOTAL).alias("monto_bruto"),
                 F.sum("monto_neto_linea").cast(S.TOTAL).alias("monto_neto"))
            .orderBy(*_CELL))


def month_category_dw(fact: DataFrame, calendar: DataFrame, dim_p: DataFrame) -> DataFrame:
    """The same question answered from the star: two joins, one of them on folded days."""
    cat = dim_p.select("id_producto_sk", F.col("nombre_categoria").alias("categoria"))
    rows = _live(fact).join(cat, "id_producto_sk")
    amounts = rows.groupBy("id_tiempo", "categoria").agg(
        F.lit(0).cast("bigint").alias("ventas"), _sum("cantidad", "unidades"), _sum("monto_bruto_linea", "monto_bruto"),
        _sum("monto_neto_linea", "monto_neto"))
    per_day = amounts.unionByName(_visits(rows, "id_tiempo", "categoria", name="ventas"), allowMissingColumns=True)
    return (per_day.join(calendar.select("id_tiempo", F.col("anio_mes").alias("periodo")), "id_tiempo")
            .groupBy(*_CELL)
            .agg(_sum("ventas", "ventas"), _sum("unidades", "unidades"),
                 F.sum("monto_bruto").cast(S.TOTAL).alias("monto_bruto"),
                 F.sum("monto_neto").cast(S.TOTAL).alias("monto_neto"))
            .orderBy(*_CELL))


def reconcile(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides on their keys, with the difference of every other column; missing counts as 0."""
    measures = [c for c in a.columns if c not in keys]
    left = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(m).alias(f"_a_{m}") for m in measures],
                    F.lit(True).alias("_in_a"))
    right = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(m).alias(f"_b_{m}") for m in measures],
                     F.lit(True).alias("_in_b"))
    same = reduce(lambda x, y: x & y, [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys])
    diff = lambda m: (F.coalesce(f"_a_{m}", F.lit(0)) - F.coalesce(f"_b_{m}", F.lit(0))).alias(f"dif_{m}")
    where = F.when(F.col("_in_b").isNull(), "solo_a").when(F.col("_in_a").isNull(), "solo_b").otherwise("ambos")
    return left.join(right, same, "full").select(
        *[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys], where.alias("presente"),
        *[diff(m) for m in measures])


def concentration(products: DataFrame, net: str = "monto_neto_total", key: str = "id_producto_sk") -> DataFrame:
    """Share of each product, and of all products at least as large, in the total.

    Products with equal amounts share one cumulative figure. The report is stored, as it is read three times.
    """
    products = settle(products.select(key, net), "products")
    ladder = value_ladder(products, net)
    total = products.agg(F.sum(net).cast(S.TOTAL)).scalar()
    return (products.join(ladder, net)
            .select(key, net, (F.col("_above") + 1).alias("puesto"), money.percent(F.col(net), total).alias("pct"),
                    money.percent(F.col("_running"), total).alias("pct_acumulado"))
            .orderBy("puesto", key))


def extremes(report: DataFrame, label: str, value: str) -> DataFrame:
    """Best and worst row of a report; among equals the later label wins for best, the earlier for worst."""
    named = report.where(F.col(value).isNotNull())
    return named.agg(
        F.max_by(F.col(label), F.struct(value, label)).alias("mejor"), F.max(value).alias("mejor_valor"),
        F.min_by(F.col(label), F.struct(value, label)).alias("peor"), F.min(value).alias("peor_valor"))


def segment_check(ranking: DataFrame, top: int = 10, segments=(S.DEFAULT_SEGMENT,)) -> DataFrame:
    """Customers near the top by spend whose segment says otherwise."""
    return (ranking.where((F.col("ranking") <= top) & F.col("segmento").isin(*segments))
            .select("ranking", "id_cliente_sk", "nombre_completo", "segmento", "gasto_total_neto", "total_compras"))
