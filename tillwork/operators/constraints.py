"""Constraint audit: what a database would have refused, counted.

Files carry no keys or checks, so each declared constraint becomes a count of violations.
Every table is scanned once for its keys and checks, and those with a unique name once more. A row tells, per constraint that concerns it, the key it holds
and whether as the row that owns the key or one that refers to it; failed checks are told the
same way, without a key. One aggregate by key, which combines before it shuffles, then gives
duplicates (owners beyond the first) and orphans (references without an owner), so a key
that fills a third of a table is folded before it moves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwork import schema as S
from tillwork.functions.text import accent_free_key

OWNS, REFERS, FAILS = 1, 0, -1

#: key -> (constraint that it is unique, constraint that references exist)
_KEYS = {
    "clientes": ("pk_clientes", "fk_venta_cliente"), "categorias": ("pk_categorias", "fk_prod_cat"),
    "productos": ("pk_productos", "fk_det_producto"), "usuarios": ("pk_usuarios", "fk_venta_usuario"),
    "ventas": ("pk_ventas", "fk_det_venta"), "detalle": ("pk_detalle", None),
    "email": ("uq_clientes_email", None), "nombre": ("uq_categorias_nombre", None), "username": ("uq_usuarios_uname", None),
}
_CHECKS = ["nn_clientes", "nn_categorias", "nn_productos", "nn_usuarios", "nn_ventas", "nn_detalle", "chk_precio",
           "chk_stock", "enum_rol", "chk_total", "enum_estado", "chk_cantidad", "chk_precio_unit"]


def _told(df: DataFrame, owns: dict[str, Column], refers: dict[str, str], checks: dict[str, Column]) -> DataFrame:
    """(what, k, role) rows. NULL keys own and refer to nothing; an unknown check passes, as in SQL."""
    def entry(what: str, key: Column, role: int, keep: Column) -> Column:
        return F.when(keep, F.struct(F.lit(what).alias("what"), key.cast("bigint").alias("k"), F.lit(role).alias("role")))

    entries = [*(entry(what, key, OWNS, key.isNotNull()) for what, key in owns.items()),
               *(entry(what, F.col(key), REFERS, F.col(key).isNotNull()) for what, key in refers.items()),
               *(entry(name, F.lit(None), FAILS, ~cond) for name, cond in checks.items())]
    return df.select(F.inline(F.array(*entries))).where(F.col("what").isNotNull())


def _names(df: DataFrame, what: str, column: str) -> DataFrame:
    """How many rows hold each name, case and accents aside."""
    keyed = df.select(accent_free_key(F.col(column)).alias("k")).where(F.col("k").isNotNull())
    return keyed.groupBy("k").count().select(F.lit(what).alias("what"), F.col("count").alias("owners"),
                                             F.lit(0).cast("bigint").alias("others"))


def _present(df: DataFrame, *columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns if c in df.columns])


def constraint_audit(t: dict[str, DataFrame]) -> DataFrame:
    """Every key, reference, check and NOT NULL of the sales model over the tables in ``t``."""
    c, k, p, u, v, d = (t[n] for n in ("clientes", "categorias", "productos", "usuarios", "ventas", "detalle_ventas"))
    numbered = "id_detalle" in d.columns
    told = [
        _told(c, {"clientes": F.col("id_cliente")}, {},
              {"nn_clientes": _present(c, "id_cliente", "nombre", "apellido", "email", "fecha_registro")}),
        _told(k, {"categorias": F.col("id_categoria")}, {},
              {"nn_categorias": _present(k, "id_categoria", "nombre")}),
        _told(p, {"productos": F.col("id_producto")}, {"categorias": "id_categoria"}, {
            "nn_productos": _present(p, "id_producto", "id_categoria", "nombre", "precio", "stock", "activo"),
            "chk_precio": F.col("precio") >= 0, "chk_stock": F.col("stock") >= 0}),
        _told(u, {"usuarios": F.col("id_usuario")}, {}, {
            "nn_usuarios": _present(u, "id_usuario", "username", "password_hash", "rol", "activo"),
            "enum_rol": F.col("rol").isin(S.ROLES)}),
        _told(v, {"ventas": F.col("id_venta")}, {"clientes": "id_cliente", "usuarios": "id_usuario"}, {
            "nn_ventas": _present(v, "id_venta", "id_cliente", "id_usuario", "fecha_venta", "total", "estado"),
            "chk_total": F.col("total") >= 0, "enum_estado": F.col("estado").isin(S.SALE_STATES)}),
        _told(d, {"detalle": F.col("id_detalle")} if numbered else {}, {"ventas": "id_venta", "productos": "id_producto"}, {
            "nn_detalle": _present(d, "id_detalle", "id_venta", "id_producto", "cantidad", "precio_unitario"),
            "chk_cantidad": F.col("cantidad") > 0, "chk_precio_unit": F.col("precio_unitario") >= 0}),
    ]
    by_key = reduce(DataFrame.unionByName, told).groupBy("what", "k").agg(
        F.count_if(F.col("role") == OWNS).alias("owners"), F.count_if(F.col("role") != OWNS).alias("others")).drop("k")
    by_key = reduce(DataFrame.unionByName, [by_key, _names(c, "email", "email"), _names(k, "nombre", "nombre"),
                                            _names(u, "username", "username")])
    by_what = by_key.groupBy("what").agg(
        F.sum(F.greatest(F.col("owners") - 1, F.lit(0))).alias("twice"),
        F.sum(F.when(F.col("owners") == 0, F.col("others")).otherwise(0)).alias("alone"))
    pick = lambda what, value: F.coalesce(F.max(F.when(F.col("what") == what, F.col(value))), F.lit(0))
    names = [*((name, what, "twice") for what, (name, _) in _KEYS.items() if numbered or what != "detalle"),
             *((name, what, "alone") for what, (_, name) in _KEYS.items() if name), *((n, n, "alone") for n in _CHECKS)]
    one = by_what.agg(*[pick(what, value).alias(name) for name, what, value in names])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("restriccion"), F.col(n).alias("violaciones")) for n, _, _ in names])))
