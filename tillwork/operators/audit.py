"""Audit rows for deletions, the unified event feed and its reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork import schema as S
from tillwork.functions.text import show
from tillwork.operators.sequence import streak

# --- Fixed values: feed categories, results and texts --------------------------------
SUCCESS, BLOCKED, FAILED, ERROR = "EXITOSO", "BLOQUEADO", "FALLIDO", "ERROR"
CATEGORIES = ["DELETE", "GRANT", "LOGIN_FALLIDO", "TODAS"]
FEED = ["categoria_evento", "id_evento", "fecha_evento", "principal_name", "client_host", "succeeded",
        "statement", "additional_info", "row_data_json"]
DENIED = "Operación denegada: las ventas no se eliminan, use sp_cancelar_venta() para cancelarlas."
SINCE = "2000-01-01 00:00:00"
ADMIN = "db_admin@localhost"
# -------------------------------------------------------------------------------------


def audit_deletes(requests: DataFrame, ventas: DataFrame, admin: str = ADMIN) -> DataFrame:
    """Delete requests (id_evento, id_venta, usuario_bd, host_origen, fecha_evento) as audit rows.

    Only the administrator deletes; that row keeps the whole sale as JSON, nulls included.
    Anybody else's request is recorded as blocked with the reason. Deleting a sale that does
    not exist deletes nothing and leaves no row.
    """
    image = F.to_json(F.struct("id_venta", "id_cliente", "id_usuario", "total", "estado", "fecha_venta"),
                      {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"})
    sale = ventas.select("id_venta", "id_cliente", "id_usuario", "total", "estado", "fecha_venta")
    allowed = F.coalesce(F.col("usuario_bd") == admin, F.lit(False))
    known = sale.withColumn("_known", F.lit(True))
    judged = requests.join(known, "id_venta", "left").where(F.col("_known").isNotNull() | ~allowed)
    return judged.select(
        "id_evento", "id_venta", F.col("id_cliente").alias("id_cliente_ref"),
        F.col("id_usuario").alias("id_usuario_ref"), F.col("total").alias("total_ref"),
        F.col("estado").alias("estado_ref"), "usuario_bd", "host_origen",
        F.when(allowed, SUCCESS).otherwise(BLOCKED).alias("resultado"),
        F.when(~allowed, F.lit(DENIED)).alias("motivo_bloqueo"), "fecha_evento",
        F.when(allowed, image).alias("datos_eliminados"))


def split_deletes(requests: DataFrame, ventas: DataFrame, admin: str = ADMIN) -> tuple[DataFrame, DataFrame]:
    """The two tables the feed reads: deletions that happened, and refused ones.

    Who asks decides, so only the administrator's requests look up their sale.
    """
    allowed = F.coalesce(F.col("usuario_bd") == admin, F.lit(False))
    refused = requests.where(~allowed).select(
        "id_evento", F.col("id_venta").alias("id_venta_ref"), "usuario_bd", "host_origen",
        F.lit(DENIED).alias("motivo"), "fecha_evento")
    return audit_deletes(requests.where(allowed), ventas, admin), refused


def protected_products(productos: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products that have sales and so may not be deleted, and those that may."""
    sold = lines.select("id_producto").distinct()
    return (productos.join(sold, "id_producto", "left_semi"), productos.join(sold, "id_producto", "left_anti"))


def grant_statement(action: Column, privilege: Column, obj: Column, grantee: Column, with_grant: Column) -> Column:
    granted = F.concat(F.lit("GRANT "), privilege, F.lit(" ON "), obj, F.lit(" TO "), grantee,
                       F.when(with_grant, F.lit(" WITH GRANT OPTION")).otherwise(F.lit("")))
    revoked = F.concat(F.lit("REVOKE "), privilege, F.lit(" ON "), obj, F.lit(" FROM "), grantee)
    return F.when(action == "GRANT", granted).otherwise(revoked)


def _branches(t: dict[str, DataFrame]) -> dict[str, list[DataFrame]]:
    none = F.lit(None).cast("string")
    deleted = lambda col: F.concat(F.lit("DELETE FROM Ventas WHERE id_venta = "),
                                   F.coalesce(F.col(col).cast("string"), F.lit("(masivo)")))
    # order of columns as in FEED
    return {
        "DELETE": [
            t["deletes"].select(
                F.lit("DELETE_VENTAS"), "id_evento", "fecha_evento", "usuario_bd", "host_origen", "resultado",
                deleted("id_venta"), "motivo_bloqueo", "datos_eliminados"),
            t["blocked"].select(
                F.lit("DELETE_VENTAS_BLOQUEADO"), "id_evento", "fecha_evento", "usuario_bd", "host_origen",
                F.lit(BLOCKED), deleted("id_venta_ref"), "motivo", none),
        ],
        "GRANT": [t["grants"].select(
            F.concat(F.lit("PERMISO_"), "accion"), "id_evento", "fecha_evento", "otorgado_por",
            F.lit("localhost"), "resultado", "sentencia_sql",
            F.concat(F.lit("Beneficiario: "), "beneficiario",
                     F.when(F.col("with_grant_option"), " WITH GRANT OPTION").otherwise("")), none)],
        "LOGIN_FALLIDO": [t["logins"].select(
            F.lit("LOGIN_FALLIDO"), "id_evento", "fecha_evento", "usuario_intento", "host_origen",
            F.when(F.col("bloqueado"), BLOCKED).otherwise(FAILED),
            F.concat(F.lit("CONNECT AS "), "usuario_intento"),
            F.concat(F.lit("Intento #"), F.col("intentos_cuenta").cast("string"),
                     F.when(F.col("bloqueado"), " – cuenta bloqueada").otherwise("")), none)],
    }


def audit_feed(t: dict[str, DataFrame], category: str = "TODAS", since: Column | str | None = None,
               until: Column | None = None, user: str | None = None) -> DataFrame:
    """All audit tables in one nine-column feed, filtered by category, time range and user.

    The filters are applied to each branch, where they reach the scan. ``until`` is the run
    time by default. The user filter is a plain substring match that ignores case.
    """
    if category not in CATEGORIES:
        raise ValueError(f"category must be one of {CATEGORIES}")
    start = F.lit(SINCE if since is None else since).cast("timestamp_ntz") if not isinstance(since, Column) else since
    end = F.current_timestamp().cast("timestamp_ntz") if until is None else until
    picked = [b for name, group in _branches(t).items() if category in (name, "TODAS") for b in group]
    feed = reduce(DataFrame.unionByName, [b.toDF(*FEED) for b in picked])
    feed = feed.where(F.col("fecha_evento").between(start, end))
    if user is not None:
        feed = feed.where(F.contains(F.lower("principal_name"), F.lit(user.lower())))
    return feed


def register_feed_function(spark: SparkSession, t: dict[str, DataFrame], name: str = "fn_get_audit_file") -> None:
    """The feed as a SQL table function: SELECT * FROM fn_get_audit_file('TODAS', NULL, NULL, NULL)."""
    audit_feed(t, until=F.lit("9999-12-31").cast("timestamp_ntz"), since="0001-01-01").createOrReplaceTempView(
        f"{name}_base")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            category STRING, since TIMESTAMP_NTZ, until TIMESTAMP_NTZ, who STRING)
        RETURNS TABLE ({", ".join(c + (" BIGINT" if c == "id_evento" else " TIMESTAMP_NTZ" if c == "fecha_evento"
                                       else " STRING") for c in FEED)})
        RETURN SELECT {", ".join(("CAST(id_evento AS BIGINT)" if c == "id_evento" else c) for c in FEED)}
        FROM {name}_base
        WHERE (category = 'TODAS' OR categoria_evento LIKE
               CASE category WHEN 'DELETE' THEN 'DELETE%' WHEN 'GRANT' THEN 'PERMISO%' ELSE category END)
          AND fecha_evento BETWEEN coalesce(since, TIMESTAMP_NTZ'{SINCE}')
                               AND coalesce(until, CAST(current_timestamp() AS TIMESTAMP_NTZ))
          AND (who IS NULL OR contains(lower(principal_name), lower(who)))""")


def audit_summary(t: dict[str, DataFrame]) -> DataFrame:
    """Events, blocked events and latest event per category."""
    def part(df: DataFrame, label: Column, blocked: Column) -> DataFrame:
        return df.select(label.alias("categoria"), F.coalesce(blocked, F.lit(False)).cast("int").alias("b"),
                         F.col("fecha_evento"))
    parts = [
        part(t["deletes"], F.lit("DELETE en Ventas"), F.col("resultado") == BLOCKED),
        part(t["blocked"], F.lit("DELETE Bloqueado"), F.lit(True)),
        part(t["grants"], F.concat(F.lit("Permisos ("), "accion", F.lit(")")), F.col("resultado") == ERROR),
        part(t["logins"], F.lit("Login Fallidos"), F.col("bloqueado")),
    ]
    return (reduce(DataFrame.unionByName, parts).groupBy("categoria")
            .agg(F.count("*").alias("total_eventos"), F.sum("b").alias("bloqueados"),
                 F.max("fecha_evento").alias("ultimo_evento")).orderBy("categoria"))


def delete_report(deletes: DataFrame) -> DataFrame:
    return (deletes.select("id_evento", "fecha_evento", "usuario_bd", "host_origen", "id_venta", "total_ref",
                           "estado_ref", "resultado", "datos_eliminados")
            .orderBy(F.desc("fecha_evento"), F.desc("id_evento")))


def privilege_report(grants: DataFrame) -> DataFrame:
    return (grants.select("id_evento", "fecha_evento", "accion", "privilegio", "objeto", "beneficiario",
                          "otorgado_por", "with_grant_option", "resultado", "sentencia_sql")
            .orderBy(F.desc("fecha_evento"), F.desc("id_evento")))


def top_threats(logins: DataFrame) -> DataFrame:
    """Failed logins per user and host, most attempts first."""
    return (logins.groupBy("usuario_intento", "host_origen")
            .agg(F.count("*").alias("total_intentos"), F.max("intentos_cuenta").alias("max_intentos_seguidos"),
                 F.sum(F.col("bloqueado").cast("int")).alias("veces_bloqueado"),
                 F.min("fecha_evento").alias("primer_intento"), F.max("fecha_evento").alias("ultimo_intento"))
            .orderBy(F.desc("total_intentos"), "usuario_intento", "host_origen"))


def audit_config_report(config: DataFrame, active_only: bool = False) -> DataFrame:
    rows = config.where(F.col("activo")) if active_only else config
    return rows.select("nombre_audit", "accion", "tabla_destino", "activo", "fecha_creacion", "creado_por",
                       "descripcion").orderBy("accion")


def categorise(feed: DataFrame, config: DataFrame) -> DataFrame:
    """Feed rows with the audit table their category is configured to go to, if it is active."""
    action = (F.when(F.col("categoria_evento").startswith("DELETE"), "DELETE")
              .when(F.col("categoria_evento").startswith("PERMISO"), "GRANT_REVOKE").otherwise("FAILED_LOGIN"))
    target = config.where(F.col("activo")).select(F.col("accion").alias("_a"), "tabla_destino")
    return feed.withColumn("_a", action).join(target, "_a", "left").drop("_a")


def failure_streaks(logins: DataFrame, chunk: Column | None = None, limit: int = 3, user: str = "usuario",
                    order: tuple[str, ...] = ("fecha_evento", "id_evento"), success: str = "exitoso") -> DataFrame:
    """Failed attempts counted since the user's last success, and the lock at ``limit``."""
    counted = streak(logins, [user], list(order), chunk, ~F.col(success), F.col(success), "intentos_cuenta")
    return (counted.where(~F.col(success))
            .withColumn("intentos_cuenta", F.col("intentos_cuenta").cast("bigint"))
            .withColumn("bloqueado", F.col("intentos_cuenta") >= limit))
