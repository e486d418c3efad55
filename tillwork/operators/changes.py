"""Change tracking between snapshots and along event series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwork import schema as S
from tillwork.functions import money
from tillwork.functions.text import money_text, show
from tillwork.operators.sequence import previous_value


def new_rows(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    return current.join(previous.select(key), key, "left_anti")


def sale_audit(new_sales: DataFrame, actor: str, run_ts: Column) -> DataFrame:
    """One audit row per new sale."""
    detail = F.concat(
        F.lit("Venta #"), F.col("id_venta").cast("string"),
        F.lit(" registrada para cliente id="), F.col("id_cliente").cast("string"),
        F.lit(" | usuario id="), F.col("id_usuario").cast("string"),
        F.lit(" | total=$"), money_text(F.col("total")), F.lit(" | estado="), F.col("estado"))
    return new_sales.select("id_venta", "id_cliente", "id_usuario", "total", "estado",
                            F.lit("INSERT").alias("accion"), F.lit(actor).alias("usuario_bd"),
                            detail.alias("detalle"), run_ts.alias("fecha_evento"))


def change_columns(old: Column, new: Column) -> list[Column]:
    return [old.alias("precio_anterior"), new.alias("precio_nuevo"),
            (new - old).try_cast(S.PRICE).alias("diferencia"),
            # no percentage where the old price was zero
            money.percent(new - old, old).alias("porcentaje_cambio")]


def price_changes(old: DataFrame, new: DataFrame, actor: str | None = None,
                  run_ts: Column | None = None) -> DataFrame:
    """Products in both snapshots whose price differs, with difference and percentage."""
    before = old.select("id_producto", F.col("precio").alias("_old"))
    changed = new.join(before, "id_producto").where(F.col("precio") != F.col("_old"))
    extra = [] if actor is None else [F.lit(actor).alias("usuario_bd"), run_ts.alias("fecha_cambio")]
    return changed.select("id_producto", F.col("nombre").alias("nombre_producto"),
                          *change_columns(F.col("_old"), F.col("precio")), *extra)


def price_history(events: DataFrame, key: str, order: list[str], chunk: Column | None = None,
                  price: str = "precio") -> DataFrame:
    """Price changes along an event series: each event against the one before it.

    The series of a busy key is cut into stretches of equal size; ``chunk``, which must not fall along
    ``order``, cuts it without storing the events first.
    """
    seen = previous_value(events, [key], order, chunk, price, "_old")
    return (seen.where(F.col(price) != F.col("_old"))
            .select(key, *order, *change_columns(F.col("_old"), F.col(price))))
