"""Star schema: calendar, customer and product dimensions, and the sales fact per line."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork import schema as S
from tillwork.functions import dates, money
from tillwork.functions.text import city_of, full_name
from tillwork.operators.sequence import number_rows
from tillwork.operators.skew import own_exchange


def dim_date(spark: SparkSession, start: dt.date, end: dt.date, months=S.MONTH_NAMES,
             days=S.DAY_NAMES) -> DataFrame:
    """One row per day of a closed range."""
    span = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    return _days(span, months, days)


def dim_date_of(ventas: DataFrame, months=S.MONTH_NAMES, days=S.DAY_NAMES) -> DataFrame:
    """The calendar from the first to the last sale."""
    day = F.col("fecha_venta").cast("date")
    return _days(ventas.agg(F.min(day).alias("a"), F.max(day).alias("b")), months, days)


def _days(span: DataFrame, months, days) -> DataFrame:
    listed = span.where("a <= b").select(F.explode(F.sequence("a", "b")).alias("fecha"))
    return listed.select(*dates.calendar_columns(F.col("fecha"), months, days))


def extend_dim_date(calendar: DataFrame, more: DataFrame) -> DataFrame:
    """Adds the days a calendar does not have yet; days it has stay as they are."""
    return calendar.unionByName(more.join(calendar.select("id_tiempo"), "id_tiempo", "left_anti"))


def _ladder(value: Column, steps, default: str) -> Column:
    out = F
    for floor, label in steps:
        out = out.when(value >= floor, label)
    return out.otherwise(default)


def dim_customer(clientes: DataFrame, ventas: DataFrame, segments=S.SEGMENTS,
                 loaded_at: Column | None = None) -> DataFrame:
    """Customers with city, registration year and segment by delivered purchases."""
    delivered = (ventas.where(F.col("estado") == S.DELIVERED).groupBy("id_cliente")
                 .agg(F.count("*").alias("_n")))
    keyed = number_rows(clientes, "id_cliente", "id_cliente_sk").join(delivered, "id_cliente", "left")
    extra = [] if loaded_at is None else [loaded_at.alias("fecha_carga_dw")]
    return keyed.select(
        "id_cliente_sk", F.col("id_cliente").alias("id_cliente_nk"),
        full_name(F.col("nombre"), F.col("apellido")).alias("nombre_completo"), "email", "telefono", "direccion",
        city_of(F.col("direccion")).alias("ciudad"), "fecha_registro",
        F.year("fecha_registro").alias("anio_registro"),
        _ladder(F.col("_n"), segments, S.DEFAULT_SEGMENT).alias("segmento"), *extra)


def dim_product(productos: DataFrame, categorias: DataFrame, bands=S.PRICE_BANDS, top: str = S.TOP_PRICE_BAND,
                loaded_at: Column | None = None) -> DataFrame:
    """Products with their category's name and a price band."""
    band = F
    for bound, label in bands:
        band = band.when(F.col("precio") < F.lit(bound).cast(S.PRICE), label)
    cat = categorias.select("id_categoria", F.col("nombre").alias("nombre_categoria"))
    keyed = number_rows(productos.join(cat, "id_categoria"), "id_producto", "id_producto_sk")
    extra = [] if loaded_at is None else [loaded_at.alias("fecha_carga_dw")]
    return keyed.select(
        "id_producto_sk", F.col("id_producto").alias("id_producto_nk"), F.col("nombre").alias("nombre_producto"),
        "descripcion", "id_categoria", "nombre_categoria", band.otherwise(top).alias("rango_precio"),
        F.col("precio").alias("precio_actual"), "activo", *extra)


def apportioned_lines(ventas: DataFrame, lines: DataFrame, product: DataFrame | None = None) -> DataFrame:
    """Lines of the sales that count, with the sale total spread over them by gross amount.

    Sums per sale come from an aggregate that combines before it shuffles, joined back on
    the sale; a window per sale would hold the largest sale in one task. Headers are
    shuffled once more before lines join them, which lets a sale with very many lines be split.
    Over tables bucketed on the sale (``sources.layout``) lines are not shuffled at all. A line
    whose amount has too many digits has none, and no part of the total. Lines take along the
    columns of ``product`` (by id_producto), looked up while they are narrow; those of unknown
    products are left out, but count in their sale.
    """
    return _spread(_with_whole(ventas, lines, product))


def _gross_amount() -> Column:
    return (F.col("cantidad") * F.col("precio_unitario")).try_cast(S.MONEY).alias("monto_bruto_linea")


def _with_whole(ventas: DataFrame, lines: DataFrame, product: DataFrame | None) -> DataFrame:
    """Lines with their sale's header and gross sum: what ``_spread`` needs of other rows."""
    line = lines.select("id_venta", "id_producto", "cantidad", "precio_unitario")
    gross = (line.select("id_venta", _gross_amount()).groupBy("id_venta")
             .agg(F.sum("monto_bruto_linea").cast(S.WIDE).alias("_gross")))
    header = ventas.where(F.col("estado") != S.CANCELLED).join(gross, "id_venta")
    # the discount is what the sale total leaves off; negative where the total is higher
    header = own_exchange(header.withColumnRenamed("total", "total_venta"), "id_venta")
    return (line if product is None else line.join(product, "id_producto")).join(header, "id_venta")


def _spread(whole: DataFrame) -> DataFrame:
    return money.apportion(whole.select("*", _gross_amount()), "monto_bruto_linea", "total_venta", "_gross",
                           pct="descuento_pct", off="monto_descuento", net="monto_neto_linea").drop("_gross")


def fact_sales(ventas: DataFrame, lines: DataFrame, dim_c: DataFrame, dim_p: DataFrame,
               layout: str | None = None) -> DataFrame:
    """The fact: one row per line of a sale that was not cancelled.

    Customer keys are looked up on sale headers, before lines multiply them. With ``layout`` the
    rows of a value of that column are brought together, in as many parts of advisory size as it
    needs, before amounts and calendar columns make them wide.
    """
    header = ventas.select("id_venta", "id_cliente", "total", "estado", F.col("fecha_venta").cast("date").alias("_day")).join(
        own_exchange(dim_c.select(F.col("id_cliente_nk").alias("id_cliente"), "id_cliente_sk"), "id_cliente"),
        "id_cliente")
    rows = _with_whole(header, lines, dim_p.select(F.col("id_producto_nk").alias("id_producto"), "id_producto_sk"))
    rows = rows.withColumn("anio_venta", F.year("_day"))
    return _spread(rows.hint("rebalance", layout) if layout else rows).select(
        dates.date_key(F.col("_day")).alias("id_tiempo"), "id_cliente_sk", "id_producto_sk",
        F.col("id_venta").alias("id_venta_nk"), F.col("id_cliente").alias("id_cliente_nk"),
        F.col("id_producto").alias("id_producto_nk"), "cantidad", "precio_unitario", "monto_bruto_linea",
        "descuento_pct", "monto_descuento", "monto_neto_linea", "total_venta",
        F.col("estado").alias("estado_venta"), "anio_venta", F.month("_day").alias("mes_venta"),
        F.quarter("_day").alias("trimestre_venta"))


def rounding_residual(fact: DataFrame) -> DataFrame:
    """Per sale, what rounding each line left between the sale total and its lines."""
    return (fact.groupBy("id_venta_nk")
            .agg(F.max("total_venta").alias("total_venta"), F.sum("monto_neto_linea").alias("neto_lineas"),
                 F.count("*").alias("lineas"))
            .withColumn("residuo", (F.col("total_venta") - F.col("neto_lineas")).cast(S.WIDE)))


def run_etl(t: dict[str, DataFrame], folder: str, start: dt.date | None = None, end: dt.date | None = None,
            **options) -> DataFrame:
    """Full refresh in dependency order; returns rows and load time per table.

    Each table is written before the next reads it, so the fact joins stored dimensions of
    known size. The fact is laid out by year, which lets a report on a period skip the rest.
    """
    spark = t["ventas"].sparkSession
    # a calendar without explicit bounds covers the sales there are
    calendar = dim_date_of(t["ventas"]) if start is None else dim_date(spark, start, end)
    now = F.current_timestamp()
    steps = [
        ("DimTiempo", lambda: calendar, None),
        ("DimCliente", lambda: dim_customer(t["clientes"], t["ventas"], loaded_at=now), None),
        ("DimProducto", lambda: dim_product(t["productos"], t["categorias"], loaded_at=now, **options), None),
        ("HechoVentas", lambda: fact_sales(
            t["ventas"], t["detalle_ventas"], spark.read.parquet(f"{folder}/DimCliente"),
            spark.read.parquet(f"{folder}/DimProducto"), layout="anio_venta"), "anio_venta"),
    ]
    counts = []
    for position, (name, build, layout) in enumerate(steps, start=1):
        writer = build().write.mode("overwrite")
        (writer.partitionBy(layout) if layout else writer).parquet(f"{folder}/{name}")
        stamp = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        counts.append(spark.read.parquet(f"{folder}/{name}").agg(F.count("*").alias("filas")).select(
            F.lit(position).alias("orden"), F.lit(name).alias("tabla"), "filas",
            F.lit(stamp).cast("timestamp_ntz").alias("cargada")))
    return reduce(DataFrame.unionByName, counts)
