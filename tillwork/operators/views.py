"""Views and lookups over the operational tables.

Dimension sides carry no broadcast hint: the optimiser knows their size, and a customer
or product table that has outgrown memory must still work. Where a report groups by a
key, rows are aggregated on the key first and descriptive columns are joined afterwards,
so only one row per key takes part in that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork import schema as S
from tillwork.functions import money
from tillwork.functions.text import full_name


def _not_cancelled(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("estado") != S.CANCELLED)


def with_subtotal(lines: DataFrame) -> DataFrame:
    return lines.withColumn("subtotal", (F.col("cantidad") * F.col("precio_unitario")).try_cast(S.MONEY))


def active_products(productos: DataFrame, categorias: DataFrame) -> DataFrame:
    cat = categorias.select("id_categoria", F.col("nombre").alias("categoria"))
    return (productos.where(F.col("activo")).join(cat, "id_categoria")
            .select("id_producto", F.col("nombre").alias("producto"), "categoria", "precio", "stock"))


def customer_contacts(clientes: DataFrame) -> DataFrame:
    return clientes.select("id_cliente", full_name(F.col("nombre"), F.col("apellido")).alias("nombre_completo"),
                           "email", "telefono", "fecha_registro")


def sales_summary(ventas: DataFrame) -> DataFrame:
    return ventas.select("id_venta", "fecha_venta", "estado", "total")


def _people(clientes: DataFrame, *more: str) -> DataFrame:
    return clientes.select("id_cliente", full_name(F.col("nombre"), F.col("apellido")).alias("cliente"),
                           *[F.col(c).alias(f"{c}_cliente") for c in more])


def _sellers(usuarios: DataFrame) -> DataFrame:
    return usuarios.select("id_usuario", F.col("username").alias("vendedor"))


def sale_detail(t: dict[str, DataFrame]) -> DataFrame:
    """One row per line with sale, customer, seller, product and category."""
    header = (t["ventas"].join(_people(t["clientes"], "email"), "id_cliente")
              .join(_sellers(t["usuarios"]), "id_usuario")
              .select("id_venta", "fecha_venta", "estado", "cliente", "email_cliente", "vendedor",
                      F.col("total").alias("total_venta")))
    product = (t["productos"].select("id_producto", "id_categoria", F.col("nombre").alias("producto"))
               .join(t["categorias"].select("id_categoria", F.col("nombre").alias("categoria")), "id_categoria"))
    return (with_subtotal(t["detalle_ventas"]).join(product, "id_producto").join(header, "id_venta")
            .select("id_venta", "fecha_venta", "estado", "cliente", "email_cliente", "vendedor", "producto",
                    "categoria", "cantidad", "precio_unitario", "subtotal", "total_venta"))


def sales_by_customer(clientes: DataFrame, ventas: DataFrame) -> DataFrame:
    """Purchases, amount and last purchase; customers without any keep a NULL amount."""
    bought = (_not_cancelled(ventas).groupBy("id_cliente")
              .agg(F.count("id_venta").alias("n"), F.sum("total").alias("monto_total"),
                   F.max("fecha_venta").alias("ultima_compra")))
    who = clientes.select("id_cliente", full_name(F.col("nombre"), F.col("apellido")).alias("cliente"), "email")
    return (who.join(bought, "id_cliente", "left")
            .select("id_cliente", "cliente", "email", F.coalesce("n", F.lit(0)).alias("total_compras"),
                    "monto_total", "ultima_compra")
            .orderBy(F.desc_nulls_last("monto_total"), "id_cliente"))


def product_ranking(t: dict[str, DataFrame]) -> DataFrame:
    """Units, revenue and distinct sales per product; cancelled sales do not count."""
    live = _not_cancelled(t["ventas"]).select("id_venta")
    sold = (with_subtotal(t["detalle_ventas"]).join(live, "id_venta").groupBy("id_producto")
            .agg(F.sum("cantidad").alias("unidades_vendidas"), F.sum("subtotal").alias("ingresos_totales"),
                 F.count_distinct("id_venta").alias("veces_en_venta")))
    product = (t["productos"].select("id_producto", "id_categoria", F.col("nombre").alias("producto"))
               .join(t["categorias"].select("id_categoria", F.col("nombre").alias("categoria")), "id_categoria"))
    return (sold.join(product, "id_producto")
            .select("id_producto", "producto", "categoria", "unidades_vendidas", "ingresos_totales",
                    "veces_en_venta")
            .orderBy(F.desc("unidades_vendidas"), "id_producto"))


def seller_performance(usuarios: DataFrame, ventas: DataFrame) -> DataFrame:
    """Sales, amount and mean ticket per seller; idle sellers stay with NULL amounts."""
    sold = (_not_cancelled(ventas).groupBy("id_usuario")
            .agg(F.count("id_venta").alias("n"), F.count("total").alias("_priced"),
                 F.sum("total").alias("monto_total_vendido")))
    return (usuarios.select("id_usuario", F.col("username").alias("vendedor"), "rol")
            .join(sold, "id_usuario", "left")
            .select("id_usuario", "vendedor", "rol", F.coalesce("n", F.lit(0)).alias("ventas_realizadas"),
                    "monto_total_vendido",
                    money.average(F.col("monto_total_vendido"), F.col("_priced")).alias("ticket_promedio")))


def complete_orders(t: dict[str, DataFrame], sale: int | None = None) -> DataFrame:
    """Order lines with customer and seller; ``sale`` narrows the scan to one order."""
    ventas, lines = t["ventas"], t["detalle_ventas"]
    if sale is not None:
        ventas, lines = ventas.where(F.col("id_venta") == sale), lines.where(F.col("id_venta") == sale)
    header = (ventas.join(_people(t["clientes"]), "id_cliente").join(_sellers(t["usuarios"]), "id_usuario")
              .withColumnRenamed("total", "total_venta"))
    product = t["productos"].select("id_producto", F.col("nombre").alias("producto"))
    return (with_subtotal(lines).join(product, "id_producto").join(header, "id_venta")
            .select("id_venta", "fecha_venta", "estado", "total_venta", "id_cliente", "cliente", "id_usuario",
                    "vendedor", "id_producto", "producto", "cantidad", "precio_unitario",
                    F.col("subtotal").alias("subtotal_linea")))


def check_option(rows: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows a filtered view would take, and those it would refuse (unknown is refused too)."""
    ok = F.coalesce(predicate, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def sale_list(ventas: DataFrame, clientes: DataFrame, usuarios: DataFrame) -> DataFrame:
    return (ventas.join(_people(clientes), "id_cliente").join(_sellers(usuarios), "id_usuario")
            .select("id_venta", "fecha_venta", "estado", "cliente", "vendedor", "total").orderBy("id_venta"))


def stock_of_sold(productos: DataFrame, lines: DataFrame, sales: DataFrame) -> DataFrame:
    """Stock of the products that occur in the given sales (a frame with ``id_venta``)."""
    sold = lines.join(sales.select("id_venta"), "id_venta", "left_semi").select("id_producto").distinct()
    return productos.join(sold, "id_producto", "left_semi").select("id_producto", "nombre", "stock")


def latest(df: DataFrame, order: list[str], k: int, where: Column | None = None) -> DataFrame:
    """The k most recent rows: each task keeps k, so nothing is fully sorted."""
    kept = df if where is None else df.where(where)
    return kept.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(k)


# What each role may read. A missing table is not granted; "*" is every column.
ROLE_POLICY = {
    "rol_administrador": {"*": "*"},
    "rol_vendedor": {"productos": "*", "categorias": "*", "clientes": "*", "ventas": "*",
                     "detalle_ventas": "*"},
    "rol_auditor": {"*": "*", "usuarios": ["id_usuario", "username", "rol", "activo", "ultimo_login"]},
}


def project_for_role(df: DataFrame, table: str, role: str, policy: dict = ROLE_POLICY) -> DataFrame:
    """The columns of ``table`` the role may read; refuses a table it was never granted."""
    grants = policy.get(role, {})
    allowed = grants.get(table, grants.get("*"))
    if allowed is None:
        raise PermissionError(f"{role} has no access to {table}")
    return df if allowed == "*" else df.select(*[c for c in df.columns if c in allowed])


def publish_for_role(t: dict[str, DataFrame], role: str, policy: dict = ROLE_POLICY) -> list[str]:
    """Temporary views holding what the role may read, one per granted table."""
    names = []
    for table, df in t.items():
        try:
            project_for_role(df, table, role, policy).createOrReplaceTempView(f"{role}_{table}")
        except PermissionError:
            continue
        names.append(f"{role}_{table}")
    return names


def publish_views(spark: SparkSession, t: dict[str, DataFrame]) -> None:
    """Makes the tables and their standard views available to ``spark.sql``."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    views = {
        "v_productos_activos": active_products(t["productos"], t["categorias"]),
        "v_clientes": customer_contacts(t["clientes"]),
        "v_ventas_resumen": sales_summary(t["ventas"]),
        "v_detalle_ventas_completo": sale_detail(t),
        "v_ventas_por_cliente": sales_by_customer(t["clientes"], t["ventas"]),
        "v_ranking_productos": product_ranking(t),
        "v_performance_vendedores": seller_performance(t["usuarios"], t["ventas"]),
        "vista_pedidos_completos": complete_orders(t),
        "vista_productos_activos": t["productos"].where(F.col("activo")),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    money.register_sql_functions(spark)
