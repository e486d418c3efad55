"""The product and customer imports as whole jobs, under either of the two rule orders.

STRICT checks format before looking anything up and rejects bad dates. LENIENT looks up
duplicates first, also within the batch, and repairs what it can.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwork import schema as S
from tillwork.functions import dates, observations as O, rules as R
from tillwork.functions.text import accent_free_key, blank_to_null, match_key
from tillwork.operators import validation as V

STRICT, LENIENT = "strict", "lenient"


def product_rules(policy: str) -> list[R.Rule]:
    name, price = R.rule_required("nombre"), R.rule_decimal("precio", comma=policy == LENIENT)
    category = [R.rule_int_key("id_categoria"), R.rule_fk("id_categoria", "_categoria", "Categorias")]
    existing = R.rule_exists("nombre", "_existe", "Productos")
    if policy == STRICT:
        return O.worded([name, price, *category, existing, R.fix_negative("precio")], O.STRICT_PRODUCTS, True)
    return O.worded([name, existing, R.rule_batch_dup("nombre", "_repetido"), *category, price,
                     R.fix_negative("precio", comma=True), R.fix_decimal_comma("precio"),
                     *R.fix_int_default("stock"), R.fix_bool_default("activo")], O.LENIENT_PRODUCTS, False)


def _key_of(policy: str) -> Callable[[Column], Column]:
    return accent_free_key if policy == STRICT else match_key


def validate_products(raw: DataFrame, categorias: DataFrame, productos: DataFrame, policy: str = STRICT,
                      key: Callable[[Column], Column] | None = None) -> DataFrame:
    """``key`` decides which names are the same: ``match_key`` ignores case, ``accent_free_key``
    accents as well. The strict policy is the database's, whose collation ignores both."""
    ruleset, key = product_rules(policy), key or _key_of(policy)
    marked = V.mark_parent(raw, R.to_int(F.col("id_categoria")), categorias, "id_categoria", "_categoria")
    alone = [r for r in ruleset if r.name not in ("duplicado", "duplicado_lote")]
    marked = V.mark_key(marked, key(F.col("nombre")), productos, key(F.col("nombre")), "fila",
                        V.passes(alone), "_existe", "_repetido")
    parsed = {
        "id_categoria": R.to_int(F.col("id_categoria")),
        "precio": R.to_decimal(F.col("precio"), comma=policy == LENIENT),
        "stock": F.coalesce(R.to_int(F.col("stock")), F.lit(0)),
        "activo": R.to_bool(F.col("activo")),
        "descripcion": blank_to_null(F.col("descripcion")),
    }
    return V.validate(marked, ruleset, parsed).drop("_categoria", "_existe", "_repetido")


def client_rules(policy: str, run_date: Column) -> list[R.Rule]:
    name, email = R.rule_required("nombre"), R.rule_email("email")
    existing, surname = R.rule_exists("email", "_existe", "Clientes"), R.fix_default_text("apellido")
    if policy == STRICT:
        return O.worded([name, email, existing, R.rule_date("fecha_registro"), surname], O.STRICT_CLIENTS, True)
    return O.worded([name, surname, R.rule_required("email"), email, existing, R.rule_batch_dup("email", "_repetido"),
                     R.fix_bad_date("fecha_registro", run_date), R.fix_date_layout("fecha_registro"),
                     R.fix_future_date("fecha_registro", run_date)], O.LENIENT_CLIENTS, False)


def validate_clients(raw: DataFrame, clientes: DataFrame, run_date: dt.date, policy: str = STRICT,
                     key: Callable[[Column], Column] | None = None) -> DataFrame:
    """``run_date`` stands for today, so a run can be repeated with the same result."""
    key = key or _key_of(policy)
    ruleset = client_rules(policy, F.lit(run_date).cast("date"))
    alone = [r for r in ruleset if r.name not in ("duplicado", "duplicado_lote")]
    marked = V.mark_key(raw, key(F.col("email")), clientes, key(F.col("email")), "fila",
                        V.passes(alone), "_existe", "_repetido")
    read = dates.parse_iso if policy == STRICT else dates.parse_any
    parsed = {
        "apellido": blank_to_null(F.col("apellido")),
        "telefono": blank_to_null(F.col("telefono")),
        "direccion": blank_to_null(F.col("direccion")),
        "fecha_registro": read(F.col("fecha_registro")),
    }
    return V.validate(marked, ruleset, parsed).drop("_existe", "_repetido")


def product_label() -> Column:
    return F.coalesce("nombre", F.lit("(sin nombre)"))


def client_label() -> Column:
    return F.concat(F.coalesce("nombre", F.lit("?")), F.lit(" "), F.coalesce("apellido", F.lit("?")))


def import_reports(products: DataFrame, clients: DataFrame) -> dict[str, DataFrame]:
    """Summary, counters, problem log, problem types and error rate over both entities."""
    both = lambda make: reduce(DataFrame.unionByName, [make(products, "Productos"), make(clients, "Clientes")])
    who = {"Productos": product_label(),
           "Clientes": F.concat(F.coalesce("nombre", F.lit("?")), F.lit(" – "), F.coalesce("email", F.lit("sin email")))}
    log = both(lambda df, e: V.issue_log(df, e, label=who[e]))
    names = {"Productos": product_label(), "Clientes": client_label()}
    counters = both(V.import_counters)
    totals = counters.agg(F.sum("errores").alias("errores"), F.sum("advertencias").alias("advertencias"))
    return {
        "resumen": both(V.status_counts),
        "registros": both(lambda df, e: V.status_names(df, e, names[e])),
        "contadores": counters,
        "totales": totals,
        "problemas": log.orderBy(F.desc("entidad"), "fila"),
        "tipos": V.issue_types(log),
        "tasa_error": both(V.error_rate),
    }
