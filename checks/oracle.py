"""The same results in plain SQL for another engine, written independently of the Spark code.

Amounts are whole cents in wide integers here, divided once at the end, so no rounding
depends on how an engine divides decimals.
"""

from __future__ import annotations

import re


def rdiv(n: str, d: str) -> str:
    """n / d rounded half away from zero, in integers; NULL when d is 0."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE (CASE WHEN ({n} < 0) = ({d} < 0) THEN 1 ELSE -1 END) "
            f"* ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END)")


def money(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) / 100" + (f" AS {name}" if name else "")


def cents(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def money_text(c: str) -> str:
    """1,234.50 from cents; enough for twelve integer digits."""
    whole = f"CAST(abs({c}) // 100 AS BIGINT)"
    g = [f"lpad(CAST({whole} // {10 ** p} % 1000 AS VARCHAR), 3, '0')" for p in (9, 6, 3, 0)]
    first = {0: f"CAST({whole} AS VARCHAR)", 1: f"CAST({whole} // 1000 AS VARCHAR) || ',' || {g[3]}",
             2: f"CAST({whole} // 1000000 AS VARCHAR) || ',' || {g[2]} || ',' || {g[3]}",
             3: f"CAST({whole} // 1000000000 AS VARCHAR) || ',' || {g[1]} || ',' || {g[2]} || ',' || {g[3]}"}
    return (f"(CASE WHEN {c} < 0 THEN '-' ELSE '' END || CASE WHEN {whole} < 1000 THEN {first[0]} "
            f"WHEN {whole} < 1000000 THEN {first[1]} WHEN {whole} < 1000000000 THEN {first[2]} ELSE {first[3]} END"
            f" || '.' || lpad(CAST(abs({c}) % 100 AS VARCHAR), 2, '0'))")


BUYER = "(o_custkey + CASE WHEN o_orderkey % 13 = 0 THEN 10000000 ELSE 0 END)"
DESK = "CAST(substr(o_orderpriority, 1, 1) AS BIGINT)"
BRAND = "CAST(split_part(p_brand, '#', 2) AS INT)"
MAIL = "lower(replace(c_name, '#', '.')) || '@mail.com'"
PART_NAME = "p_name || ' ' || p_brand || ' ' || CAST(p_partkey // 200 AS VARCHAR)"
PRICE_TEXT = "CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR)"

MONTHS = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre",
          "Noviembre", "Diciembre"]
DAYS = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]


def names(values: list[str], at: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{at}]"



CTES = {
    "categorias": ([], f"SELECT DISTINCT {BRAND} AS id_categoria, p_brand AS nombre FROM part"),
    "productos": ([], f"""SELECT p_partkey AS id_producto, {BRAND} AS id_categoria,
        p_name || ' ' || CAST(p_partkey AS VARCHAR) AS nombre, p_type AS descripcion,
        {cents('p_retailprice')} AS precio_c, p_size * 10 AS stock, p_type <> 'PROMO' AS activo FROM part"""),
    "clientes": ([], f"""SELECT c_custkey AS id_cliente, split_part(c_name, '#', 1) AS nombre,
        split_part(c_name, '#', 2) AS apellido, {MAIL} AS email, CAST(NULL AS VARCHAR) AS telefono,
        c_mktsegment || ', ' || n_name AS direccion,
        CAST(DATE '1994-01-01' + c_nationkey * 30 AS DATE) AS fecha_registro
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""),
    "usuarios": ([], """SELECT s_suppkey AS id_usuario, s_name AS username,
        CASE s_nationkey WHEN 0 THEN 'admin' WHEN 1 THEN 'supervisor' ELSE 'vendedor' END AS rol,
        s_acctbal >= 1000 AS activo, CAST(NULL AS TIMESTAMP) AS ultimo_login FROM supplier"""),
    "ventas": ([], f"""SELECT o_orderkey AS id_venta, o_custkey AS id_cliente, {DESK} AS id_usuario,
        o_orderdate AS fecha_venta, {cents('o_totalprice')} AS total_c,
        CASE o_orderstatus WHEN 'F' THEN 'entregada' WHEN 'O' THEN 'confirmada' WHEN 'P' THEN 'cancelada' END AS estado,
        CAST(NULL AS VARCHAR) AS observaciones FROM orders"""),
    "lineas": ([], f"""SELECT l_orderkey AS id_venta, l_partkey AS id_producto, CAST(l_quantity AS INT) AS cantidad,
        CAST({rdiv(cents('l_extendedprice'), 'CAST(l_quantity AS INT)')} AS BIGINT) AS precio_c FROM lineitem"""),
    "calendario": (["ventas"], f"""SELECT
        CAST(strftime(d, '%Y%m%d') AS INT) AS id_tiempo, CAST(d AS DATE) AS fecha, CAST(year(d) AS INT) AS anio,
        CAST(quarter(d) AS INT) AS trimestre, CAST(month(d) AS INT) AS mes,
        {names(MONTHS, 'month(d)')} AS nombre_mes, CAST(week(d) AS INT) AS semana_anio, CAST(day(d) AS INT) AS dia_mes,
        CAST(isodow(d) AS INT) AS dia_semana, {names(DAYS, 'isodow(d)')} AS nombre_dia, isodow(d) >= 6 AS es_fin_semana,
        strftime(d, '%Y-%m') AS anio_mes
        FROM (SELECT unnest(generate_series(CAST(min(fecha_venta) AS DATE), CAST(max(fecha_venta) AS DATE),
              INTERVAL 1 DAY)) AS d FROM ventas)"""),
    "dim_c": (["clientes", "ventas"], """SELECT CAST(row_number() OVER (ORDER BY c.id_cliente) AS BIGINT) AS id_cliente_sk,
        c.id_cliente AS id_cliente_nk, c.nombre || ' ' || c.apellido AS nombre_completo, email, telefono, direccion,
        trim(split_part(direccion, ',', -1)) AS ciudad, fecha_registro,
        CAST(year(fecha_registro) AS INT) AS anio_registro,
        CASE WHEN n >= 10 THEN 'VIP' WHEN n >= 5 THEN 'FRECUENTE' WHEN n >= 1 THEN 'OCASIONAL' ELSE 'NUEVO' END AS segmento
        FROM clientes c LEFT JOIN (SELECT id_cliente, count(*) AS n FROM ventas WHERE estado = 'entregada'
        GROUP BY 1) e ON e.id_cliente = c.id_cliente"""),
    "dim_p": (["productos", "categorias"], """SELECT
        CAST(row_number() OVER (ORDER BY p.id_producto) AS BIGINT) AS id_producto_sk, p.id_producto AS id_producto_nk,
        p.nombre AS nombre_producto, p.descripcion, c.id_categoria, c.nombre AS nombre_categoria,
        CASE WHEN precio_c < 93000 THEN 'ECONOMICO' WHEN precio_c < 97000 THEN 'MEDIO' ELSE 'PREMIUM' END AS rango_precio,
        precio_c, activo FROM productos p JOIN categorias c ON p.id_categoria = c.id_categoria"""),
    "hecho": (["ventas", "lineas", "dim_c", "dim_p"], f"""SELECT
        CAST(strftime(fecha_venta, '%Y%m%d') AS INT) AS id_tiempo, id_cliente_sk, id_producto_sk, v.id_venta,
        v.id_cliente, l.id_producto, l.cantidad, l.precio_c, l.cantidad * l.precio_c AS bruto_c,
        {rdiv('(g - total_c) * 10000', 'g')} AS pct_c,
        {rdiv('CAST(l.cantidad * l.precio_c AS HUGEINT) * (g - total_c)', 'g')} AS desc_c,
        {rdiv('CAST(l.cantidad * l.precio_c AS HUGEINT) * total_c', 'g')} AS neto_c,
        total_c, v.estado, CAST(year(fecha_venta) AS INT) AS anio, CAST(month(fecha_venta) AS INT) AS mes,
        CAST(quarter(fecha_venta) AS INT) AS trimestre, nombre_producto, nombre_categoria, rango_precio
        FROM ventas v JOIN lineas l ON l.id_venta = v.id_venta
        JOIN (SELECT id_venta, sum(cantidad * precio_c) AS g FROM lineas GROUP BY 1) s ON s.id_venta = v.id_venta
        JOIN dim_c ON id_cliente_nk = v.id_cliente JOIN dim_p ON id_producto_nk = l.id_producto
        WHERE v.estado <> 'cancelada'"""),
    "st_p": ([], f"""SELECT p_partkey AS fila,
        CASE p_size WHEN 1 THEN NULL WHEN 2 THEN '99' WHEN 3 THEN 'x1' ELSE split_part(p_brand, '#', 2) END AS id_categoria,
        CASE p_size WHEN 4 THEN '  ' ELSE {PART_NAME} END AS nombre, p_type AS descripcion,
        CASE p_size WHEN 5 THEN 'PRECIO_INVALIDO' WHEN 6 THEN '-' || {PRICE_TEXT}
             WHEN 7 THEN replace({PRICE_TEXT}, '.', ',') WHEN 8 THEN NULL ELSE {PRICE_TEXT} END AS precio,
        CASE p_size WHEN 9 THEN 'n/a' WHEN 10 THEN '-5' WHEN 11 THEN NULL ELSE CAST(p_size * 10 AS VARCHAR) END AS stock,
        CASE p_size WHEN 12 THEN 'si' WHEN 13 THEN NULL WHEN 14 THEN 'FALSE' ELSE '1' END AS activo FROM part"""),
    "catalogo": ([], f"SELECT DISTINCT lower({PART_NAME}) AS k FROM part WHERE p_type = 'PROMO'"),
    "p_flags": (["st_p", "catalogo", "categorias"], """SELECT s.*, lower(trim(s.nombre)) AS k,
        coalesce(trim(s.nombre), '') = '' AS f_nombre, TRY_CAST(trim(s.id_categoria) AS INT) AS cat,
        TRY_CAST(trim(s.id_categoria) AS INT) IS NULL AS f_clave,
        coalesce(TRY_CAST(trim(s.id_categoria) AS INT) NOT IN (SELECT id_categoria FROM categorias), true) AS f_fk,
        lower(trim(s.nombre)) IN (SELECT k FROM catalogo) AS f_existe,
        TRY_CAST(s.precio AS DECIMAL(10,2)) AS d_strict, TRY_CAST(replace(s.precio, ',', '.') AS DECIMAL(10,2)) AS d_lenient,
        TRY_CAST(s.stock AS INT) AS n_stock FROM st_p s"""),
    "p_strict": (["p_flags"], """SELECT *, CASE WHEN f_nombre THEN 'obligatorio' WHEN d_strict IS NULL THEN 'no_numerico'
        WHEN f_clave THEN 'clave_invalida' WHEN f_fk THEN 'clave_foranea' WHEN f_existe THEN 'duplicado' END AS rechazo
        FROM p_flags"""),
    "p_strict_v": (["p_strict"], """SELECT *, CASE WHEN rechazo IS NOT NULL THEN 'error'
        WHEN d_strict < 0 THEN 'corregido' ELSE 'ok' END AS estado,
        coalesce(rechazo, CASE WHEN d_strict < 0 THEN 'precio_negativo' END) AS regla,
        greatest(d_strict, 0) AS v_precio, greatest(coalesce(n_stock, 0), coalesce(n_stock, 0)) AS v_stock,
        CASE WHEN activo IN ('0', 'false', 'FALSE') THEN false ELSE true END AS v_activo FROM p_strict"""),
    "p_first": (["p_flags"], """SELECT k, min(fila) AS primera FROM p_flags
        WHERE NOT f_nombre AND NOT f_clave AND NOT f_fk AND d_lenient IS NOT NULL GROUP BY k"""),
    "p_lenient_v": (["p_flags", "p_first"], """SELECT *,
        CASE WHEN rechazo IS NOT NULL THEN 'error' WHEN avisos > 0 THEN 'corregido' ELSE 'ok' END AS estado FROM (
        SELECT f.*, CASE WHEN f_nombre THEN 'obligatorio' WHEN f_existe THEN 'duplicado'
          WHEN fila > primera THEN 'duplicado_lote' WHEN f_clave THEN 'clave_invalida' WHEN f_fk THEN 'clave_foranea'
          WHEN d_lenient IS NULL THEN 'no_numerico' END AS rechazo,
          CASE WHEN activo NOT IN ('0', '1', 'true', 'false', 'TRUE', 'FALSE') THEN 'booleano_invalido'
               WHEN n_stock < 0 THEN 'entero_negativo' WHEN n_stock IS NULL THEN 'entero_invalido'
               WHEN contains(precio, ',') THEN 'separador_decimal' WHEN d_lenient < 0 THEN 'precio_negativo' END AS aviso,
          coalesce(CAST(activo NOT IN ('0', '1', 'true', 'false', 'TRUE', 'FALSE') AS INT), 0)
            + coalesce(CAST(n_stock < 0 AS INT), 1) + coalesce(CAST(contains(precio, ',') AS INT), 0)
            + coalesce(CAST(d_lenient < 0 AS INT), 0) AS avisos
        FROM p_flags f LEFT JOIN p_first USING (k))"""),
    "st_c": ([], f"""SELECT c_custkey AS fila, CASE c_nationkey WHEN 0 THEN '' ELSE split_part(c_name, '#', 1) END AS nombre,
        CASE c_nationkey WHEN 1 THEN NULL ELSE split_part(c_name, '#', 2) END AS apellido,
        CASE c_nationkey WHEN 2 THEN 'sin-arroba' WHEN 3 THEN NULL
          WHEN 4 THEN lower(c_mktsegment) || '.' || CAST(c_custkey // 50 AS VARCHAR) || '@dup.com' ELSE {MAIL} END AS email,
        CASE c_nationkey WHEN 5 THEN ' ' ELSE c_mktsegment END AS telefono, c_mktsegment AS direccion,
        CASE c_nationkey WHEN 6 THEN '2025-30-99' WHEN 7 THEN '15/03/2024' WHEN 8 THEN '12/25/2024' WHEN 9 THEN '20240315'
          WHEN 10 THEN '2999-01-01' WHEN 11 THEN ''
          ELSE CAST(CAST(DATE '1994-01-01' + c_nationkey * 30 AS DATE) AS VARCHAR) END AS fecha_registro FROM customer"""),
    "registrados": ([], f"SELECT lower({MAIL}) AS k FROM customer WHERE c_acctbal < 0"),
    "c_flags": (["st_c", "registrados"], """SELECT s.*, lower(trim(email)) AS k, coalesce(trim(nombre), '') = '' AS f_nombre,
        coalesce(trim(email), '') = '' AS f_vacio,
        NOT coalesce(regexp_full_match(trim(email), '[^@\\s]+@[^@\\s]+\\.[^@\\s]+'), false) AS f_email,
        coalesce(lower(trim(email)) IN (SELECT k FROM registrados), false) AS f_existe,
        coalesce(trim(apellido), '') = '' AS f_apellido,
        CAST(try_strptime(fecha_registro, '%Y-%m-%d') AS DATE) AS d_iso,
        CAST(coalesce(try_strptime(fecha_registro, '%Y-%m-%d'), try_strptime(fecha_registro, '%d/%m/%Y'),
          try_strptime(fecha_registro, '%m/%d/%Y'), try_strptime(fecha_registro, '%Y%m%d')) AS DATE) AS d_any FROM st_c s"""),
    "c_strict_v": (["c_flags"], """SELECT *, CASE WHEN rechazo IS NOT NULL THEN 'error' WHEN f_apellido THEN 'corregido'
        ELSE 'ok' END AS estado, coalesce(rechazo, CASE WHEN f_apellido THEN 'texto_vacio' END) AS regla FROM (
        SELECT *, CASE WHEN f_nombre THEN 'obligatorio' WHEN f_email THEN 'formato_email' WHEN f_existe THEN 'duplicado'
          WHEN d_iso IS NULL THEN 'fecha_invalida' END AS rechazo FROM c_flags)"""),
    "c_first": (["c_flags"], """SELECT k, min(fila) AS primera FROM c_flags
        WHERE NOT f_nombre AND NOT f_vacio AND NOT f_email GROUP BY k"""),
    "c_lenient_v": (["c_flags", "c_first"], """SELECT *,
        CASE WHEN rechazo IS NOT NULL THEN 'error' WHEN n_apellido + n_fecha > 0 THEN 'corregido' ELSE 'ok' END AS estado,
        coalesce(rechazo, CASE WHEN d_any IS NULL THEN 'fecha_invalida' WHEN d_any > DATE '2025-06-01' THEN 'fecha_futura'
          WHEN d_iso IS NULL THEN 'formato_fecha' WHEN f_apellido THEN 'texto_vacio' END) AS regla,
        CASE WHEN rechazo = 'obligatorio' AND f_nombre THEN 1 WHEN rechazo IS NOT NULL THEN n_apellido + 1
          ELSE n_apellido + n_fecha END AS problemas FROM (
        SELECT f.*, CASE WHEN f_nombre THEN 'obligatorio' WHEN f_vacio THEN 'obligatorio' WHEN f_email THEN 'formato_email'
          WHEN f_existe THEN 'duplicado' WHEN fila > primera THEN 'duplicado_lote' END AS rechazo,
          CAST(f_apellido AS INT) AS n_apellido,
          CASE WHEN d_any IS NULL THEN 1 ELSE CAST(d_iso IS NULL AS INT) + CAST(d_any > DATE '2025-06-01' AS INT) END AS n_fecha
        FROM c_flags f LEFT JOIN c_first USING (k))"""),
    "carros": ([], f"""SELECT o_orderkey AS cart_id, {BUYER} AS id_cliente, {DESK} AS id_usuario,
        o_orderpriority AS observacion, o_orderdate AS submitted_at FROM orders"""),
    "items": ([], """SELECT l_orderkey AS cart_id, CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 100
        + CAST(l_quantity AS INT) AS pos, l_partkey AS id_producto, CASE WHEN l_partkey % 97 = 0 THEN 0 WHEN l_partkey % 89 = 0 THEN -3
        WHEN l_partkey % 101 = 0 THEN 2000000000 WHEN l_partkey % 83 <> 0 THEN CAST(l_quantity AS INT) END AS cantidad
        FROM lineitem"""),
    "carros_json": ([], f"""SELECT o_orderkey AS cart_id, {BUYER} AS id_cliente, {DESK} AS id_usuario FROM orders"""),
    "items_json": (["items"], """SELECT i.* FROM items i JOIN orders ON o_orderkey = cart_id WHERE o_orderpriority <> '5-LOW'"""),
    "entregas": (["ventas"], "SELECT id_cliente, count(*) AS n FROM ventas WHERE estado = 'entregada' GROUP BY 1"),
    "pedidos": ([], f"""SELECT o_orderkey AS pedido_id, {BUYER} AS id_cliente, {DESK} AS id_usuario,
        o_custkey AS id_producto, CAST(day(o_orderdate) - 3 AS INT) AS cantidad FROM orders"""),
    "bajas": ([], """SELECT l_orderkey + CASE WHEN l_linenumber = 7 THEN 1000000000 ELSE 0 END AS id_venta,
        'dev ' || l_linenumber || '/' || l_partkey AS motivo,
        CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 100 + CAST(l_quantity AS INT) AS orden
        FROM lineitem WHERE l_returnflag = 'R'"""),
    "bajas_v": (["bajas", "ventas"], """SELECT * EXCLUDE (vez, antes), CASE WHEN antes IS NULL THEN 1
        WHEN antes NOT IN ('pendiente', 'confirmada') OR vez > 1 THEN 2 ELSE 0 END AS codigo,
        CASE WHEN antes IN ('pendiente', 'confirmada') AND vez > 1 THEN 'cancelada' ELSE antes END AS estado FROM (
        SELECT b.*, v.estado AS antes, row_number() OVER (PARTITION BY b.id_venta ORDER BY orden) AS vez FROM bajas b
        LEFT JOIN ventas v USING (id_venta))"""),
    "accesos": ([], """SELECT event_id AS id_evento, 'user_' || user_id AS usuario, user_id, event_type <> 'error' AS exitoso,
        ts AS fecha_evento FROM events"""),
    "rachas": (["accesos"], """SELECT id_evento, usuario, user_id, fecha_evento, intentos_cuenta,
        intentos_cuenta >= 3 AS bloqueado FROM (
        SELECT *, CAST(sum(CAST(NOT exitoso AS INT)) OVER (PARTITION BY usuario, tramo ORDER BY fecha_evento, id_evento
          ROWS UNBOUNDED PRECEDING) AS BIGINT) AS intentos_cuenta FROM (
        SELECT *, sum(CAST(exitoso AS INT)) OVER (PARTITION BY usuario ORDER BY fecha_evento, id_evento
          ROWS UNBOUNDED PRECEDING) AS tramo FROM accesos)) WHERE NOT exitoso"""),
    "borrados": (["ventas"], """SELECT event_id AS id_evento, event_id AS id_venta, v.id_cliente AS id_cliente_ref,
        v.id_usuario AS id_usuario_ref, v.total_c, v.estado AS estado_ref, usuario_bd,
        '10.0.0.' || user_id AS host_origen, CASE WHEN usuario_bd = 'db_admin@localhost' THEN 'EXITOSO' ELSE 'BLOQUEADO' END
        AS resultado, CASE WHEN usuario_bd <> 'db_admin@localhost' THEN 'Operación denegada: las ventas no se eliminan, '
        || 'use sp_cancelar_venta() para cancelarlas.' END AS motivo_bloqueo, ts AS fecha_evento,
        CASE WHEN usuario_bd = 'db_admin@localhost' THEN '{"id_venta":' || v.id_venta || ',"id_cliente":' || v.id_cliente
          || ',"id_usuario":' || v.id_usuario || ',"total":' || CAST(CAST(v.total_c AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))
          || ',"estado":"' || v.estado || '","fecha_venta":"' || strftime(v.fecha_venta, '%Y-%m-%d %H:%M:%S') || '"}' END
        AS datos_eliminados
        FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'db_admin@localhost' ELSE 'user_' || user_id END AS usuario_bd
              FROM events) e LEFT JOIN ventas v ON v.id_venta = e.event_id
        WHERE v.id_venta IS NOT NULL OR usuario_bd <> 'db_admin@localhost'"""),
    "permisos": ([], """SELECT *, accion || ' SELECT ON ventas ' || CASE accion WHEN 'GRANT' THEN 'TO ' ELSE 'FROM ' END
        || beneficiario || CASE WHEN accion = 'GRANT' AND with_grant_option THEN ' WITH GRANT OPTION' ELSE '' END
        AS sentencia_sql FROM (
        SELECT event_id AS id_evento, CASE WHEN value >= 10 THEN 'GRANT' ELSE 'REVOKE' END AS accion,
        'SELECT' AS privilegio, 'ventas' AS objeto, 'user_' || user_id AS beneficiario, 'db_admin' AS otorgado_por,
        value >= 20 AS with_grant_option, CASE WHEN value < 1 THEN 'ERROR' ELSE 'EXITOSO' END AS resultado,
        ts AS fecha_evento FROM events WHERE event_type = 'click')"""),
    "feed": (["borrados", "permisos", "rachas"], """
        SELECT 'DELETE_VENTAS' AS categoria_evento, id_evento, fecha_evento, usuario_bd AS principal_name,
          host_origen AS client_host, resultado AS succeeded, 'DELETE FROM Ventas WHERE id_venta = ' || id_venta AS statement,
          motivo_bloqueo AS additional_info, datos_eliminados AS row_data_json FROM borrados WHERE resultado = 'EXITOSO'
        UNION ALL SELECT 'DELETE_VENTAS_BLOQUEADO', id_evento, fecha_evento, usuario_bd, host_origen, 'BLOQUEADO',
          'DELETE FROM Ventas WHERE id_venta = ' || id_venta, motivo_bloqueo, NULL FROM borrados WHERE resultado = 'BLOQUEADO'
        UNION ALL SELECT 'PERMISO_' || accion, id_evento, fecha_evento, otorgado_por, 'localhost', resultado, sentencia_sql,
          'Beneficiario: ' || beneficiario || CASE WHEN with_grant_option THEN ' WITH GRANT OPTION' ELSE '' END, NULL
          FROM permisos
        UNION ALL SELECT 'LOGIN_FALLIDO', id_evento, fecha_evento, usuario, '10.0.0.' || user_id,
          CASE WHEN bloqueado THEN 'BLOQUEADO' ELSE 'FALLIDO' END, 'CONNECT AS ' || usuario,
          'Intento #' || intentos_cuenta || CASE WHEN bloqueado THEN ' – cuenta bloqueada' ELSE '' END, NULL FROM rachas"""),
    "precios": ([], f"""SELECT user_id, ts, event_id, {cents('value')} AS precio_c FROM events WHERE event_type = 'purchase'"""),
}


def priced(carts: str, items: str) -> dict[str, tuple[list[str], str]]:
    """CTEs that judge a pair of cart and item tables."""
    return {
        "j_items": ([items, "productos"], f"""SELECT i.*, p.precio_c, p.stock,
            CASE WHEN p.id_producto IS NULL OR NOT p.activo THEN 1 WHEN p.stock < i.cantidad THEN 2 ELSE 0 END AS falla,
            CASE WHEN p.id_producto IS NULL OR NOT p.activo THEN 'Producto id=' || i.id_producto || ' no existe o no está activo.'
                 WHEN p.stock < i.cantidad THEN 'Stock insuficiente para "' || p.nombre || '": solicitado=' || i.cantidad
                   || ', disponible=' || p.stock || '.' END AS texto
            FROM {items} i LEFT JOIN productos p ON p.id_producto = i.id_producto"""),
        "j_first": (["j_items"], """SELECT cart_id, falla, texto FROM (SELECT *, row_number() OVER (PARTITION BY cart_id
            ORDER BY pos) AS rn FROM j_items WHERE falla > 0) WHERE rn = 1"""),
        "j_sum": (["j_items"], """SELECT cart_id, CASE WHEN NOT bool_or(coalesce(largo, false)) THEN sum(importe_c) END AS bruto_c,
            sum(cantidad) AS total_items, count(*) AS lineas,
            bool_or(coalesce(cantidad <= 0, true) OR coalesce(largo, false)) AS negado FROM (
            SELECT *, CAST(precio_c AS HUGEINT) * cantidad AS importe_c,
              abs(CAST(precio_c AS HUGEINT) * cantidad) > 999999999999 AS largo FROM j_items) GROUP BY 1"""),
        "j_over": (["j_items"], """SELECT DISTINCT cart_id FROM (SELECT cart_id, id_producto FROM j_items
            GROUP BY 1, 2 HAVING sum(cantidad) > max(stock))"""),
        "j_cart": ([carts, "clientes", "usuarios", "j_first", "j_sum", "j_over", "entregas"], f"""
            SELECT *, {pct_sql('bruto_c', 'total_items', 'id_cliente', 'n')} AS pct, CASE
              WHEN lineas IS NULL THEN 1 WHEN NOT hay_cliente THEN 2 WHEN NOT hay_usuario THEN 3 WHEN falla IS NOT NULL THEN 4
              WHEN sobra OR negado THEN 99 ELSE 0 END AS codigo, CASE
              WHEN lineas IS NULL THEN 'El carrito está vacío. Debe incluir al menos un producto.'
              WHEN NOT hay_cliente THEN 'Cliente id=' || id_cliente || ' no encontrado.'
              WHEN NOT hay_usuario THEN 'Usuario id=' || id_usuario || ' no encontrado o inactivo.'
              WHEN falla IS NOT NULL THEN texto WHEN sobra OR negado THEN 'Error inesperado de base de datos. Transacción revertida.'
              ELSE '' END AS mensaje FROM (
            SELECT c.*, s.bruto_c, s.total_items, s.lineas, s.negado, f.falla, f.texto, o.cart_id IS NOT NULL AS sobra, e.n,
              c.id_cliente IN (SELECT id_cliente FROM clientes) AS hay_cliente,
              c.id_usuario IN (SELECT id_usuario FROM usuarios WHERE activo) AS hay_usuario
            FROM {carts} c LEFT JOIN j_sum s ON s.cart_id = c.cart_id LEFT JOIN j_first f ON f.cart_id = c.cart_id
            LEFT JOIN j_over o ON o.cart_id = c.cart_id LEFT JOIN entregas e ON e.id_cliente = c.id_cliente)"""),
    }


def pct_sql(gross_c: str, items: str, client: str, delivered: str) -> str:
    return (f"least(30, CASE WHEN {gross_c} >= 20000000 THEN 15 WHEN {gross_c} >= 10000000 THEN 10 "
            f"WHEN {gross_c} >= 5000000 THEN 5 ELSE 0 END + CASE WHEN {items} >= 5 THEN 3 ELSE 0 END "
            f"+ CASE WHEN {client} IS NOT NULL AND coalesce({delivered}, 0) > 5 THEN 5 ELSE 0 END)")


def net_sql(gross_c: str, pct: str) -> str:
    held = f"greatest(least({pct}, 100), 0)"
    return f"CASE WHEN {gross_c} < 0 THEN 0 ELSE {rdiv(f'CAST({gross_c} AS HUGEINT) * (100 - {held})', '100')} END"


def sql(body: str, *needs: str, extra: dict | None = None) -> str:
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in known[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    head = "WITH " + ",\n".join(f"{n} AS ({known[n][1]})" for n in order) + "\n" if order else ""
    return head + body


CARTS = priced("carros", "items")
JSON_CARTS = priced("carros_json", "items_json")
MARK = "TIMESTAMP '1998-01-01'"
SALE_OUT = f"id_venta, id_cliente, id_usuario, fecha_venta, {money('total_c', 'total')}, estado, observaciones"
P_OUT = "id_categoria, nombre, precio, stock, activo"

_CONSTRAINTS = """
        SELECT 'pk_clientes' AS restriccion, CAST(count(*) - count(DISTINCT id_cliente) AS BIGINT) AS violaciones FROM clientes
        UNION ALL SELECT 'uq_clientes_email', count(email) - count(DISTINCT lower(email)) FROM clientes
        UNION ALL SELECT 'pk_categorias', count(*) - count(DISTINCT id_categoria) FROM categorias
        UNION ALL SELECT 'uq_categorias_nombre', count(nombre) - count(DISTINCT lower(nombre)) FROM categorias
        UNION ALL SELECT 'pk_productos', count(*) - count(DISTINCT id_producto) FROM productos
        UNION ALL SELECT 'pk_usuarios', count(*) - count(DISTINCT id_usuario) FROM usuarios
        UNION ALL SELECT 'uq_usuarios_uname', count(*) - count(DISTINCT lower(username)) FROM usuarios
        UNION ALL SELECT 'pk_ventas', count(*) - count(DISTINCT id_venta) FROM ventas
        UNION ALL SELECT 'fk_prod_cat', count(*) FROM productos WHERE id_categoria NOT IN (SELECT id_categoria FROM categorias)
        UNION ALL SELECT 'fk_venta_cliente', count(*) FROM ventas WHERE id_cliente NOT IN (SELECT id_cliente FROM clientes)
        UNION ALL SELECT 'fk_venta_usuario', count(*) FROM ventas WHERE id_usuario NOT IN (SELECT id_usuario FROM usuarios)
        UNION ALL SELECT 'fk_det_venta', count(*) FROM lineas WHERE id_venta NOT IN (SELECT id_venta FROM ventas)
        UNION ALL SELECT 'fk_det_producto', count(*) FROM lineas WHERE id_producto NOT IN (SELECT id_producto FROM productos)
        UNION ALL SELECT 'nn_clientes', count(*) FROM clientes WHERE nombre IS NULL OR apellido IS NULL OR email IS NULL
        UNION ALL SELECT 'nn_categorias', count(*) FROM categorias WHERE id_categoria IS NULL OR nombre IS NULL
        UNION ALL SELECT 'nn_usuarios', count(*) FROM usuarios WHERE id_usuario IS NULL OR username IS NULL OR rol IS NULL
          OR activo IS NULL
        UNION ALL SELECT 'nn_ventas', count(*) FROM ventas WHERE id_venta IS NULL OR id_cliente IS NULL OR id_usuario IS NULL
          OR fecha_venta IS NULL OR total_c IS NULL OR estado IS NULL
        UNION ALL SELECT 'nn_detalle', count(*) FROM lineas WHERE id_venta IS NULL OR id_producto IS NULL OR cantidad IS NULL
          OR precio_c IS NULL
        UNION ALL SELECT 'chk_precio', count(*) FROM productos WHERE precio_c < 0
        UNION ALL SELECT 'chk_stock', count(*) FROM productos WHERE stock < 0
        UNION ALL SELECT 'nn_productos', count(*) FROM productos WHERE id_producto IS NULL
          OR id_categoria IS NULL OR nombre IS NULL OR precio_c IS NULL OR stock IS NULL OR activo IS NULL
        UNION ALL SELECT 'enum_rol', count(*) FROM usuarios WHERE rol NOT IN ('admin', 'vendedor', 'supervisor')
        UNION ALL SELECT 'chk_total', count(*) FROM ventas WHERE total_c < 0
        UNION ALL SELECT 'enum_estado', count(*) FROM ventas
          WHERE estado NOT IN ('pendiente', 'confirmada', 'cancelada', 'entregada')
        UNION ALL SELECT 'chk_cantidad', count(*) FROM lineas WHERE cantidad <= 0
        UNION ALL SELECT 'chk_precio_unit', count(*) FROM lineas WHERE precio_c < 0"""

def _spoil(table: str, key: str, again: int, faults: list[tuple[str, int, int, str]]) -> tuple[list[str], str]:
    """The table with its faults, rows whose key is a multiple of ``again`` twice."""
    changed = f"SELECT * REPLACE ({{}}) FROM {table}"
    merged: dict[str, str] = {}
    for column, by, rest, value in faults:
        merged[column] = f"CASE WHEN {key} % {by} = {rest} THEN {value} ELSE {merged.get(column, column)} END"
    one = changed.format(", ".join(f"{v} AS {c}" for c, v in merged.items()))
    return [table], f"{one} UNION ALL {one} WHERE {key} % {again} = 0"


_DIRTY = {f"d_{name}": _spoil(name, *rest) for name, *rest in [
    ("clientes", "id_cliente", 10, [("nombre", 9, 1, "NULL")]),
    ("categorias", "id_categoria", 3, [("nombre", 5, 1, "NULL")]),
    ("productos", "id_producto", 13, [("id_categoria", 17, 2, "1000"), ("precio_c", 19, 3, "-100"), ("stock", 23, 4, "-1"),
                                      ("nombre", 29, 5, "NULL")]),
    ("usuarios", "id_usuario", 3, [("rol", 4, 1, "'jefe'"), ("activo", 5, 2, "NULL")]),
    ("ventas", "id_venta", 31, [("id_cliente", 37, 7, "-1"), ("id_usuario", 41, 8, "-1"), ("total_c", 43, 9, "-500"),
                                ("estado", 47, 10, "'perdida'"), ("fecha_venta", 53, 11, "NULL")]),
    ("lineas", "id_producto", 10 ** 9, [("id_venta", 11, 1, "-1"), ("id_producto", 13, 2, "-1"), ("cantidad", 17, 3, "0"),
                                        ("precio_c", 19, 4, "-100"), ("cantidad", 23, 5, "NULL")])]}

_TABLE_FK = "'id_categoria=' || id_categoria || ' no existe en tabla Categorias – FK violation'"
STRICT_P = f"""CASE regla WHEN 'obligatorio' THEN 'nombre vacío o NULL – campo NOT NULL obligatorio'
            WHEN 'no_numerico' THEN 'precio="' || coalesce(precio, 'NULL') || '" no es un valor numérico válido'
            WHEN 'clave_invalida' THEN CASE WHEN coalesce(trim(id_categoria), '') = ''
              THEN 'id_categoria NULL – campo NOT NULL y FK requerida' ELSE {_TABLE_FK} END
            WHEN 'clave_foranea' THEN {_TABLE_FK}
            WHEN 'duplicado' THEN 'nombre="' || nombre || '" ya existe en Productos – registro duplicado'
            WHEN 'precio_negativo' THEN 'precio negativo (' || precio || ') corregido a 0.00 – viola CHECK (precio >= 0)' END"""
STRICT_C = """CASE regla WHEN 'obligatorio' THEN 'nombre vacío o NULL – NOT NULL obligatorio'
            WHEN 'texto_vacio' THEN 'apellido NULL corregido a "(sin apellido)" – NOT NULL obligatorio'
            WHEN 'formato_email' THEN 'email="' || coalesce(email, 'NULL') || '" formato inválido – no contiene @'
            WHEN 'duplicado' THEN 'email="' || email || '" ya existe en Clientes – registro duplicado'
            WHEN 'fecha_invalida' THEN 'fecha_registro="' || fecha_registro || '" es una fecha imposible (día/mes fuera de rango)' END"""
LENIENT_P = """CASE rechazo WHEN 'obligatorio' THEN 'nombre vacío – campo NOT NULL requerido'
            WHEN 'duplicado' THEN 'duplicado – ''' || trim(nombre) || ''' ya existe en Productos'
            WHEN 'duplicado_lote' THEN 'duplicado – ''' || trim(nombre) || ''' ya existe en Productos'
            WHEN 'clave_invalida' THEN 'id_categoria=''' || coalesce(trim(id_categoria), '')
              || ''' es nulo o no es entero – integridad referencial violada'
            WHEN 'clave_foranea' THEN 'id_categoria=' || cat || ' no existe en tabla Categorias – FK violation'
            WHEN 'no_numerico' THEN 'precio=''' || coalesce(precio, '') || ''' no es numérico – descartado'
            ELSE nullif(concat_ws('; ', CASE WHEN d_lenient < 0 THEN 'precio negativo viola CHECK (precio >= 0)' END,
              CASE WHEN contains(precio, ',') THEN 'separador decimal no estándar' END,
              CASE WHEN n_stock IS NULL THEN 'stock no es entero' WHEN n_stock < 0 THEN 'stock negativo viola CHECK (stock >= 0)' END,
              CASE WHEN activo NOT IN ('0', '1', 'true', 'false', 'TRUE', 'FALSE') THEN 'valor booleano no reconocido' END), '') END"""
LENIENT_C = """CASE rechazo WHEN 'obligatorio' THEN CASE WHEN f_nombre THEN 'nombre vacío – NOT NULL requerido'
              ELSE 'email vacío – NOT NULL + UNIQUE requerido' END
            WHEN 'formato_email' THEN 'email=''' || trim(email) || ''' formato inválido (sin @) – descartado'
            WHEN 'duplicado' THEN 'email=''' || trim(email) || ''' ya existe en Clientes – duplicado descartado'
            WHEN 'duplicado_lote' THEN 'email=''' || trim(email) || ''' ya existe en Clientes – duplicado descartado'
            ELSE nullif(concat_ws('; ', CASE WHEN f_apellido THEN 'apellido vacío – NOT NULL requerido' END,
              CASE WHEN d_any IS NULL THEN 'fecha inválida o formato no reconocido'
                WHEN d_iso IS NULL THEN 'formato de fecha no estándar (esperado YYYY-MM-DD)' END,
              CASE WHEN d_any > DATE '2025-06-01' THEN 'fecha en el futuro' END), '') END"""

ORACLE = {
    "s1_read_products_csv": sql("SELECT * FROM st_p", "st_p"),
    "s2_read_clients_json": sql("SELECT * FROM st_c", "st_c"),
    "s3_snapshot_full": sql(f"SELECT {SALE_OUT} FROM ventas", "ventas"),
    "s4_snapshot_diff": sql(f"SELECT {SALE_OUT} FROM ventas WHERE fecha_venta > {MARK}", "ventas"),
    "s5_restore": sql(f"SELECT {SALE_OUT} FROM ventas", "ventas"),
    "s4_snapshot_changes": sql(f"""SELECT {SALE_OUT}, false AS borrada FROM ventas
        WHERE estado <> 'cancelada' AND (fecha_venta > {MARK} OR (estado = 'confirmada' AND total_c <> 0))
        UNION ALL SELECT id_venta, NULL, NULL, NULL, NULL, NULL, NULL, true FROM ventas
        WHERE estado = 'cancelada' AND fecha_venta <= {MARK}""", "ventas"),
    "s5_restore_changes": sql(f"SELECT {SALE_OUT} FROM ventas WHERE estado <> 'cancelada'", "ventas"),
    "s7_differing_buckets": sql(f"""
        SELECT 'solo_a' AS tabla, count(*) AS filas FROM ventas WHERE fecha_venta <= {MARK}
          AND (estado = 'cancelada' OR (estado = 'confirmada' AND total_c <> 0)) UNION ALL
        SELECT 'solo_b', count(*) FROM ventas WHERE estado <> 'cancelada'
          AND (fecha_venta > {MARK} OR (estado = 'confirmada' AND total_c <> 0))""", "ventas"),
    "s6_snapshot_log": sql(f"""
        SELECT 'FULL' AS tipo, 'Ventas' AS tabla_afectada, 'ventas_FULL' AS archivo, count(*) AS filas_respaldadas,
          {MARK} AS fecha_inicio FROM ventas WHERE fecha_venta <= {MARK}
        UNION ALL SELECT 'FULL', 'Productos', 'productos_FULL', count(*), TIMESTAMP '1998-01-02' FROM part
        UNION ALL SELECT 'DIFERENCIAL', 'Ventas', 'ventas_DIFF', count(*), TIMESTAMP '1999-01-01' FROM ventas
          WHERE fecha_venta > {MARK} ORDER BY fecha_inicio""", "ventas"),
    "s7_row_counts": sql("""
        SELECT 'clientes' AS tabla, count(*) AS filas FROM customer UNION ALL
        SELECT 'categorias', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'productos', count(*) FROM part UNION ALL
        SELECT 'usuarios', count(*) FROM supplier UNION ALL SELECT 'ventas', count(*) FROM orders UNION ALL
        SELECT 'detalle_ventas', count(*) FROM lineitem"""),
    "s7_differing_rows": sql(f"""
        SELECT 'solo_a' AS tabla, count(*) AS filas FROM ventas WHERE fecha_venta > {MARK} UNION ALL
        SELECT 'solo_b', count(*) FROM ventas WHERE fecha_venta > {MARK}""", "ventas"),

    "v16_validate_products_strict": sql(f"""
        SELECT fila, estado, {STRICT_P} AS observacion, regla, CAST(regla IS NOT NULL AS BIGINT) AS problemas,
          CASE WHEN estado <> 'error' THEN cat END AS id_categoria, CASE WHEN estado <> 'error' THEN nombre END AS nombre,
          CASE WHEN estado <> 'error' THEN CAST(v_precio AS DOUBLE) END AS precio,
          CASE WHEN estado <> 'error' THEN v_stock END AS stock, CASE WHEN estado <> 'error' THEN v_activo END AS activo
        FROM p_strict_v""", "p_strict_v"),
    "v16_validate_products_lenient": sql(f"""
        SELECT fila, estado, {LENIENT_P} AS observacion, coalesce(rechazo, aviso) AS regla,
          CAST(CASE WHEN rechazo IS NOT NULL THEN 1 ELSE avisos END AS BIGINT) AS problemas,
          CASE WHEN estado <> 'error' THEN cat END AS id_categoria, CASE WHEN estado <> 'error' THEN nombre END AS nombre,
          CASE WHEN estado <> 'error' THEN CAST(greatest(d_lenient, 0) AS DOUBLE) END AS precio,
          CASE WHEN estado <> 'error' THEN greatest(coalesce(n_stock, 0), 0) END AS stock,
          CASE WHEN estado <> 'error' THEN activo IS DISTINCT FROM 'FALSE' END AS activo FROM p_lenient_v""", "p_lenient_v"),
    "v16_validate_clients_strict": sql(f"""
        SELECT fila, estado, {STRICT_C} AS observacion, regla, CAST(regla IS NOT NULL AS BIGINT) AS problemas,
          CASE WHEN estado <> 'error' THEN nombre END AS nombre,
          CASE WHEN estado <> 'error' THEN CASE WHEN f_apellido THEN '(sin apellido)' ELSE apellido END END AS apellido,
          CASE WHEN estado <> 'error' THEN email END AS email,
          CASE WHEN estado <> 'error' THEN nullif(trim(telefono), '') END AS telefono,
          CASE WHEN estado <> 'error' THEN d_iso END AS fecha_registro FROM c_strict_v""", "c_strict_v"),
    "v16_validate_clients_lenient": sql(f"""
        SELECT fila, estado, {LENIENT_C} AS observacion, regla, CAST(problemas AS BIGINT) AS problemas,
          CASE WHEN estado <> 'error' THEN nombre END AS nombre,
          CASE WHEN estado <> 'error' THEN CASE WHEN f_apellido THEN '(sin apellido)' ELSE apellido END END AS apellido,
          CASE WHEN estado <> 'error' THEN email END AS email,
          CASE WHEN estado <> 'error' THEN nullif(trim(telefono), '') END AS telefono,
          CASE WHEN estado <> 'error' THEN least(coalesce(d_any, DATE '2025-06-01'), DATE '2025-06-01') END AS fecha_registro
        FROM c_lenient_v""", "c_lenient_v"),
    "s8_load_valid": sql("""
        SELECT cat AS id_categoria, trim(nombre) AS nombre, descripcion, CAST(v_precio AS DOUBLE) AS precio, v_stock AS stock,
          v_activo AS activo FROM p_strict_v WHERE estado <> 'error'""", "p_strict_v"),
    "v17_issue_log": sql(f"""
        SELECT 'Productos' AS entidad, fila, coalesce(nombre, '(sin nombre)') AS identificador, estado, regla,
          CASE regla WHEN 'obligatorio' THEN 'nombre' WHEN 'duplicado' THEN 'nombre' WHEN 'no_numerico' THEN 'precio'
            WHEN 'precio_negativo' THEN 'precio' ELSE 'id_categoria' END AS campo,
          CASE regla WHEN 'obligatorio' THEN nombre WHEN 'duplicado' THEN nombre WHEN 'no_numerico' THEN precio
            WHEN 'precio_negativo' THEN precio ELSE id_categoria END AS valor,
          {STRICT_P} AS problema,
          CASE WHEN rechazo IS NULL THEN 'warning' ELSE 'error' END AS severidad
        FROM p_strict_v WHERE regla IS NOT NULL
        UNION ALL
        SELECT 'Clientes', fila, coalesce(nombre, '?') || ' – ' || coalesce(email, 'sin email'), estado, regla,
          CASE regla WHEN 'obligatorio' THEN 'nombre' WHEN 'texto_vacio' THEN 'apellido' WHEN 'fecha_invalida'
            THEN 'fecha_registro' ELSE 'email' END,
          CASE regla WHEN 'obligatorio' THEN nombre WHEN 'texto_vacio' THEN apellido WHEN 'fecha_invalida'
            THEN fecha_registro ELSE email END,
          {STRICT_C},
          CASE WHEN rechazo IS NULL THEN 'warning' ELSE 'error' END FROM c_strict_v WHERE regla IS NOT NULL
        ORDER BY entidad DESC, fila""", "p_strict_v", "c_strict_v"),
    "v18_status_summary": sql("""
        SELECT 'Productos' AS entidad, estado, count(*) AS cantidad FROM p_strict_v GROUP BY 2
        UNION ALL SELECT 'Clientes', estado, count(*) FROM c_strict_v GROUP BY 2""", "p_strict_v", "c_strict_v"),
    "v18_status_names": sql("""
        SELECT 'Productos' AS entidad, estado, fila, coalesce(nombre, '(sin nombre)') AS registro FROM p_strict_v
        UNION ALL SELECT 'Clientes', estado, fila, coalesce(nombre, '?') || ' ' ||
          CASE WHEN f_apellido AND estado <> 'error' THEN '(sin apellido)' ELSE coalesce(nullif(trim(apellido), ''), '?') END
          FROM c_strict_v""", "p_strict_v", "c_strict_v"),
    "v19_import_counters": sql("""
        SELECT 'Productos' AS entidad, count(*) AS leidos, count(*) FILTER (estado <> 'error') AS insertados,
          count(*) FILTER (estado = 'error') AS descartados, count(*) FILTER (estado = 'corregido') AS corregidos,
          count(*) FILTER (estado = 'error') AS errores,
          CAST(sum(CASE WHEN rechazo IS NULL THEN avisos ELSE 0 END) AS BIGINT) AS advertencias FROM p_lenient_v
        UNION ALL SELECT 'Clientes', count(*), count(*) FILTER (estado <> 'error'), count(*) FILTER (estado = 'error'),
          count(*) FILTER (estado = 'corregido'), count(*) FILTER (estado = 'error'),
          CAST(sum(problemas - CAST(rechazo IS NOT NULL AS INT)) AS BIGINT) FROM c_lenient_v""", "p_lenient_v", "c_lenient_v"),
    "v20_error_rate": sql("""
        SELECT 'Productos' AS entidad, count(*) AS leidos, count(*) FILTER (estado = 'error') AS errores,
          round(count(*) FILTER (estado = 'error') / count(*) * 100, 2) AS pct_error,
          count(*) FILTER (estado = 'error') / count(*) > 0.1 AS alarma FROM p_strict_v
        UNION ALL SELECT 'Clientes', count(*), count(*) FILTER (estado = 'error'),
          round(count(*) FILTER (estado = 'error') / count(*) * 100, 2),
          count(*) FILTER (estado = 'error') / count(*) > 0.1 FROM c_strict_v""", "p_strict_v", "c_strict_v"),
    "v21_issue_types": sql("""
        SELECT entidad, regla, severidad, count(*) AS cantidad FROM (
          SELECT 'Productos' AS entidad, rechazo AS regla, 'error' AS severidad FROM p_lenient_v WHERE rechazo IS NOT NULL
          UNION ALL SELECT 'Productos', 'precio_negativo', 'warning' FROM p_lenient_v WHERE rechazo IS NULL AND d_lenient < 0
          UNION ALL SELECT 'Productos', 'separador_decimal', 'warning' FROM p_lenient_v
            WHERE rechazo IS NULL AND contains(precio, ',')
          UNION ALL SELECT 'Productos', 'entero_invalido', 'warning' FROM p_lenient_v WHERE rechazo IS NULL AND n_stock IS NULL
          UNION ALL SELECT 'Productos', 'entero_negativo', 'warning' FROM p_lenient_v WHERE rechazo IS NULL AND n_stock < 0
          UNION ALL SELECT 'Productos', 'booleano_invalido', 'warning' FROM p_lenient_v
            WHERE rechazo IS NULL AND activo NOT IN ('0', '1', 'true', 'false', 'TRUE', 'FALSE')
          UNION ALL SELECT 'Clientes', rechazo, 'error' FROM c_lenient_v WHERE rechazo IS NOT NULL
          UNION ALL SELECT 'Clientes', 'texto_vacio', 'warning' FROM c_lenient_v WHERE f_apellido AND NOT f_nombre
          UNION ALL SELECT 'Clientes', 'fecha_invalida', 'warning' FROM c_lenient_v WHERE rechazo IS NULL AND d_any IS NULL
          UNION ALL SELECT 'Clientes', 'formato_fecha', 'warning' FROM c_lenient_v
            WHERE rechazo IS NULL AND d_any IS NOT NULL AND d_iso IS NULL
          UNION ALL SELECT 'Clientes', 'fecha_futura', 'warning' FROM c_lenient_v WHERE rechazo IS NULL
            AND d_any > DATE '2025-06-01') GROUP BY 1, 2, 3""", "p_lenient_v", "c_lenient_v"),
    "v22_revalidate": sql(f"""
        SELECT fila, estado, {STRICT_P} AS observacion, regla, CAST(regla IS NOT NULL AS BIGINT) AS problemas,
          CASE WHEN estado <> 'error' THEN cat END AS id_categoria, CASE WHEN estado <> 'error' THEN nombre END AS nombre,
          CASE WHEN estado <> 'error' THEN CAST(greatest(d_strict, 0) AS DOUBLE) END AS precio,
          CASE WHEN estado <> 'error' THEN coalesce(n_stock, 0) END AS stock,
          CASE WHEN estado <> 'error' THEN CASE WHEN activo IN ('0', 'false', 'FALSE') THEN false ELSE true END END AS activo
        FROM (SELECT *, CASE WHEN otra IS NOT NULL THEN 'error' WHEN d_strict < 0 THEN 'corregido' ELSE 'ok' END AS estado,
            coalesce(otra, CASE WHEN d_strict < 0 THEN 'precio_negativo' END) AS regla FROM (
          SELECT *, CASE WHEN rechazo = 'clave_foranea' AND cat = 99 THEN CASE WHEN f_existe THEN 'duplicado' END
            ELSE rechazo END AS otra FROM p_strict WHERE rechazo IS NOT NULL))""", "p_strict"),
    "v23_constraint_audit": sql(_CONSTRAINTS, "clientes", "categorias", "productos", "usuarios", "ventas", "lineas"),

    "q1_active_products": sql(f"""SELECT id_producto, p.nombre AS producto, c.nombre AS categoria, {money('precio_c', 'precio')},
        stock FROM productos p JOIN categorias c USING (id_categoria) WHERE activo""", "productos", "categorias"),
    "q2_customer_contacts": sql("""SELECT id_cliente, nombre || ' ' || apellido AS nombre_completo, email, telefono,
        fecha_registro FROM clientes""", "clientes"),
    "q3_sales_summary": sql(f"SELECT id_venta, fecha_venta, estado, {money('total_c', 'total')} FROM ventas", "ventas"),
    "q4_sale_detail": sql(f"""SELECT v.id_venta, fecha_venta, v.estado, c.nombre || ' ' || c.apellido AS cliente,
        c.email AS email_cliente, u.username AS vendedor, p.nombre AS producto, k.nombre AS categoria, l.cantidad,
        {money('l.precio_c', 'precio_unitario')}, {money('l.precio_c * l.cantidad', 'subtotal')}, {money('total_c', 'total_venta')}
        FROM lineas l JOIN ventas v USING (id_venta) JOIN clientes c ON c.id_cliente = v.id_cliente
        JOIN usuarios u ON u.id_usuario = v.id_usuario JOIN productos p ON p.id_producto = l.id_producto
        JOIN categorias k ON k.id_categoria = p.id_categoria""", "lineas", "ventas", "clientes", "usuarios", "productos", "categorias"),
    "q5_sales_by_customer": sql(f"""SELECT c.id_cliente, nombre || ' ' || apellido AS cliente, email,
        count(v.id_venta) AS total_compras, {money('sum(total_c)', 'monto_total')}, max(fecha_venta) AS ultima_compra
        FROM clientes c LEFT JOIN ventas v ON v.id_cliente = c.id_cliente AND v.estado <> 'cancelada'
        GROUP BY 1, 2, 3""", "clientes", "ventas"),
    "q6_product_ranking": sql(f"""SELECT p.id_producto, p.nombre AS producto, k.nombre AS categoria,
        {big('sum(cantidad)', 'unidades_vendidas')}, {money('sum(cantidad * l.precio_c)', 'ingresos_totales')},
        count(DISTINCT l.id_venta) AS veces_en_venta FROM lineas l JOIN productos p USING (id_producto)
        JOIN categorias k ON k.id_categoria = p.id_categoria JOIN ventas v ON v.id_venta = l.id_venta
        WHERE v.estado <> 'cancelada' GROUP BY 1, 2, 3""", "lineas", "productos", "categorias", "ventas"),
    "q7_seller_performance": sql(f"""SELECT u.id_usuario, username AS vendedor, rol, count(id_venta) AS ventas_realizadas,
        {money('sum(total_c)', 'monto_total_vendido')}, {money(rdiv('sum(total_c)', 'count(total_c)'), 'ticket_promedio')}
        FROM usuarios u LEFT JOIN ventas v ON v.id_usuario = u.id_usuario AND v.estado <> 'cancelada'
        GROUP BY 1, 2, 3""", "usuarios", "ventas"),
    "q8_complete_orders": sql(f"""SELECT v.id_venta, fecha_venta, v.estado, {money('total_c', 'total_venta')}, c.id_cliente,
        c.nombre || ' ' || c.apellido AS cliente, u.id_usuario, username AS vendedor, p.id_producto, p.nombre AS producto,
        cantidad, {money('l.precio_c', 'precio_unitario')}, {money('l.precio_c * cantidad', 'subtotal_linea')}
        FROM ventas v JOIN clientes c USING (id_cliente) JOIN usuarios u ON u.id_usuario = v.id_usuario
        JOIN lineas l ON l.id_venta = v.id_venta JOIN productos p ON p.id_producto = l.id_producto""",
        "ventas", "clientes", "usuarios", "lineas", "productos"),
    "q9_check_option": sql("SELECT id_producto, nombre, activo AS aceptado FROM productos", "productos"),
    "q10_with_subtotal": sql(f"""SELECT id_venta, id_producto, cantidad, {money('precio_c', 'precio_unitario')},
        {money('precio_c * cantidad', 'subtotal')} FROM lineas""", "lineas"),
    "q11_sale_list": sql(f"""SELECT id_venta, fecha_venta, v.estado, c.nombre || ' ' || c.apellido AS cliente,
        username AS vendedor, {money('total_c', 'total')} FROM ventas v JOIN clientes c USING (id_cliente)
        JOIN usuarios u ON u.id_usuario = v.id_usuario ORDER BY id_venta""", "ventas", "clientes", "usuarios"),
    "q12_stock_of_sold": sql("""SELECT id_producto, nombre, stock FROM productos WHERE id_producto IN (SELECT id_producto
        FROM lineas WHERE id_venta IN (SELECT id_venta FROM ventas WHERE fecha_venta = TIMESTAMP '1998-01-01'))""",
        "productos", "lineas", "ventas"),
    "q13_latest": sql(f"SELECT {SALE_OUT} FROM ventas ORDER BY fecha_venta DESC NULLS LAST, id_venta DESC LIMIT 10", "ventas"),
    "q14_project_for_role": sql("SELECT id_usuario, username, rol, activo, ultimo_login FROM usuarios", "usuarios"),

    "c1_discount": sql(f"""SELECT c.cart_id, c.id_cliente, {money('bruto_c', 'monto_bruto')}, {big('total_items', 'total_items')},
        CAST({pct_sql('bruto_c', 'total_items', 'c.id_cliente', 'n')} AS DOUBLE) AS descuento_pct
        FROM carros c JOIN j_sum USING (cart_id) LEFT JOIN entregas e ON e.id_cliente = c.id_cliente""",
        "carros", "j_sum", "entregas", extra=CARTS),
    "c2_net_total": sql(f"""SELECT id_venta, {money('total_c', 'total')}, CAST((month(fecha_venta) - 1) * 10 AS DOUBLE) AS pct,
        {money(net_sql('total_c', '(month(fecha_venta) - 1) * 10'), 'neto')} FROM ventas""", "ventas"),
    "c3_discount_scenarios": sql(f"""SELECT id_venta AS escenario, CAST(pct AS DOUBLE) AS descuento_pct,
        {money(net_sql('total_c', 'pct'), 'total_neto')} FROM (SELECT v.*,
        {pct_sql('total_c', 'month(fecha_venta)', 'v.id_cliente', 'n')} AS pct
        FROM ventas v LEFT JOIN entregas e ON e.id_cliente = v.id_cliente)""", "ventas", "entregas"),
    "c5_price_carts": sql(f"""SELECT cart_id, id_cliente, {money('bruto_c', 'monto_bruto')}, {big('total_items', 'total_items')},
        CAST(pct AS DOUBLE) AS descuento_pct, {money(net_sql('bruto_c', 'pct'), 'total_neto')} FROM j_cart
        WHERE lineas IS NOT NULL""", "j_cart", extra=CARTS),
    "c6_validate_carts": sql(f"""SELECT cart_id, id_cliente, id_usuario, codigo, mensaje,
        CASE WHEN codigo = 0 THEN {money('bruto_c')} END AS monto_bruto,
        CASE WHEN codigo = 0 THEN CAST(total_items AS BIGINT) END AS total_items,
        CASE WHEN codigo = 0 THEN CAST(pct AS DOUBLE) ELSE 0 END AS descuento_pct,
        CASE WHEN codigo = 0 THEN {money(net_sql('bruto_c', 'pct'))} ELSE 0 END AS total_neto FROM j_cart""",
        "j_cart", extra=CARTS),
    "c6_validate_carts_json": sql(f"""SELECT cart_id, codigo, mensaje,
        CASE WHEN codigo = 0 THEN {money(net_sql('bruto_c', 'pct'))} ELSE 0 END AS total_neto FROM j_cart""",
        "j_cart", extra=JSON_CARTS),
    "c7_sale_headers": sql(f"""SELECT cart_id, id_venta, id_cliente, id_usuario, TIMESTAMP '2025-06-01' AS fecha_venta,
        {money('neto_c', 'total')}, 'confirmada' AS estado, observacion AS observaciones,
        'Venta registrada correctamente. ID=' || id_venta || ' | Bruto=$' || {money_text('bruto_c')} || ' | Descuento='
        || pct || '.00% | Total neto=$' || {money_text('neto_c')} AS mensaje
        FROM (SELECT *, CAST(row_number() OVER (ORDER BY cart_id) + (SELECT max(o_orderkey) FROM orders) AS BIGINT) AS id_venta,
          {net_sql('bruto_c', 'pct')} AS neto_c FROM j_cart WHERE codigo = 0)""", "j_cart", extra=CARTS),
    "c7_sale_lines": sql(f"""SELECT id_venta, i.id_producto, i.cantidad, {money('precio_c', 'precio_unitario')}
        FROM (SELECT cart_id, CAST(row_number() OVER (ORDER BY cart_id) + (SELECT max(o_orderkey) FROM orders) AS BIGINT)
          AS id_venta FROM j_cart WHERE codigo = 0) a JOIN j_items i USING (cart_id)""", "j_cart", "j_items", extra=CARTS),
    "c8_apply_stock": sql("""SELECT p.id_producto, CAST(stock - coalesce(n, 0) AS BIGINT) AS stock FROM productos p LEFT JOIN
        (SELECT id_producto, sum(cantidad) AS n FROM lineas JOIN ventas USING (id_venta) WHERE estado = 'confirmada'
         GROUP BY 1) m USING (id_producto)""", "productos", "lineas", "ventas"),
    "c10_cancel_requests": sql("""SELECT id_venta, motivo, orden, codigo, CASE codigo WHEN 1 THEN 'Venta id=' || id_venta || ' no encontrada.'
        WHEN 2 THEN 'La venta id=' || id_venta || ' tiene estado "' || estado || '" y no puede cancelarse.'
        ELSE 'Venta id=' || id_venta || ' cancelada correctamente. Stock restaurado.' END AS mensaje FROM bajas_v""", "bajas_v"),
    "c10_sales_after_cancel": sql("""SELECT v.id_venta, CASE WHEN codigo = 0 THEN 'cancelada' ELSE v.estado END AS estado,
        CASE WHEN codigo = 0 THEN ' | CANCELADA: ' || motivo || ' (2025-06-01 00:00:00)' END AS observaciones
        FROM ventas v LEFT JOIN (SELECT * FROM bajas_v WHERE codigo = 0) b USING (id_venta)""", "ventas", "bajas_v"),
    "c10_stock_after_cancel": sql("""SELECT p.id_producto, CAST(stock + coalesce(n, 0) AS BIGINT) AS stock FROM productos p
        LEFT JOIN (SELECT id_producto, sum(cantidad) AS n FROM lineas JOIN bajas_v USING (id_venta) WHERE codigo = 0
        GROUP BY 1) m USING (id_producto)""", "productos", "lineas", "bajas_v"),
    "c11_single_orders": sql(f"""SELECT pedido_id, id_cliente, id_usuario, id_producto, cantidad, codigo, CASE codigo
          WHEN 1 THEN 'Cliente id=' || id_cliente || ' no encontrado.'
          WHEN 2 THEN 'Usuario id=' || id_usuario || ' no encontrado o inactivo.'
          WHEN 3 THEN 'Producto id=' || id_producto || ' no existe o no está activo.'
          WHEN 4 THEN 'Stock insuficiente para "' || nombre || '": solicitado=' || cantidad || ', disponible=' || stock || '.'
          WHEN 99 THEN 'Error inesperado de base de datos. Transacción revertida.' END
          AS mensaje, CASE WHEN codigo = 0 THEN {money('precio_c * cantidad')} ELSE 0 END AS total
        FROM (SELECT o.*, p.nombre, p.stock, p.precio_c, CASE WHEN o.id_cliente NOT IN (SELECT id_cliente FROM clientes) THEN 1
          WHEN o.id_usuario NOT IN (SELECT id_usuario FROM usuarios WHERE activo) THEN 2
          WHEN p.id_producto IS NULL THEN 3 WHEN p.stock < o.cantidad THEN 4
          WHEN o.cantidad <= 0 THEN 99 ELSE 0 END AS codigo
          FROM pedidos o LEFT JOIN (SELECT * FROM productos WHERE activo) p USING (id_producto))""",
        "pedidos", "productos", "clientes", "usuarios"),

    "a1_sale_audit": sql(f"""SELECT id_venta, id_cliente, id_usuario, {money('total_c', 'total')}, estado, 'INSERT' AS accion,
        'db_admin' AS usuario_bd, 'Venta #' || id_venta || ' registrada para cliente id=' || id_cliente || ' | usuario id='
        || id_usuario || ' | total=$' || {money_text('total_c')} || ' | estado=' || estado AS detalle,
        TIMESTAMP '2025-06-01' AS fecha_evento FROM ventas WHERE fecha_venta > {MARK}""", "ventas"),
    "a2_price_changes": sql(f"""SELECT id_producto, nombre AS nombre_producto, {money('precio_c', 'precio_anterior')},
        {money('nuevo', 'precio_nuevo')}, {money('nuevo - precio_c', 'diferencia')},
        {money(rdiv('(nuevo - precio_c) * 10000', 'precio_c'), 'porcentaje_cambio')}
        FROM (SELECT *, {rdiv('precio_c * 110', '100')} AS nuevo FROM productos WHERE descripcion = 'MEDIUM')
        WHERE nuevo <> precio_c""", "productos"),
    "a3_price_history": sql(f"""SELECT user_id, ts, event_id, {money('antes', 'precio_anterior')}, {money('precio_c', 'precio_nuevo')},
        {money('precio_c - antes', 'diferencia')}, {money(rdiv('(precio_c - antes) * 10000', 'antes'), 'porcentaje_cambio')}
        FROM (SELECT *, lag(precio_c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS antes FROM precios)
        WHERE precio_c <> antes""", "precios"),
    "a4_audit_deletes": sql(f"""SELECT id_evento, id_venta, id_cliente_ref, id_usuario_ref, {money('total_c', 'total_ref')},
        estado_ref, usuario_bd, host_origen, resultado, motivo_bloqueo, fecha_evento, datos_eliminados FROM borrados""", "borrados"),
    "a5_protected_products": sql("""SELECT id_producto, id_producto IN (SELECT id_producto FROM lineas) AS protegido
        FROM productos""", "productos", "lineas"),
    "a6_audit_feed": sql("""SELECT * FROM feed WHERE fecha_evento BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2030-01-01'""", "feed"),
    "a6_audit_feed_filtered": sql("""SELECT * FROM feed WHERE fecha_evento BETWEEN TIMESTAMP '2024-01-05'
        AND TIMESTAMP '2030-01-01' AND contains(principal_name, 'user_1')""", "feed"),
    "a7_audit_summary": sql("""
        SELECT 'DELETE en Ventas' AS categoria, count(*) AS total_eventos, CAST(0 AS BIGINT) AS bloqueados,
          max(fecha_evento) AS ultimo_evento FROM borrados WHERE resultado = 'EXITOSO'
        UNION ALL SELECT 'DELETE Bloqueado', count(*), count(*), max(fecha_evento) FROM borrados WHERE resultado = 'BLOQUEADO'
        UNION ALL SELECT 'Permisos (' || accion || ')', count(*), count(*) FILTER (resultado = 'ERROR'), max(fecha_evento)
          FROM permisos GROUP BY accion
        UNION ALL SELECT 'Login Fallidos', count(*), count(*) FILTER (bloqueado), max(fecha_evento) FROM rachas""",
        "borrados", "permisos", "rachas"),
    "a8_delete_report": sql(f"""SELECT id_evento, fecha_evento, usuario_bd, host_origen, id_venta, {money('total_c', 'total_ref')},
        estado_ref, resultado, datos_eliminados FROM borrados ORDER BY fecha_evento DESC, id_evento DESC""", "borrados"),
    "a9_privilege_report": sql("""SELECT id_evento, fecha_evento, accion, privilegio, objeto, beneficiario, otorgado_por,
        with_grant_option, resultado, sentencia_sql FROM permisos ORDER BY fecha_evento DESC, id_evento DESC""", "permisos"),
    "a10_top_threats": sql("""SELECT usuario AS usuario_intento, '10.0.0.' || user_id AS host_origen, count(*) AS total_intentos,
        max(intentos_cuenta) AS max_intentos_seguidos, count(*) FILTER (bloqueado) AS veces_bloqueado,
        min(fecha_evento) AS primer_intento, max(fecha_evento) AS ultimo_intento FROM rachas GROUP BY 1, 2""", "rachas"),
    "a11_events_by_destination": sql("""SELECT CASE WHEN categoria_evento LIKE 'DELETE%' THEN 'audit_delete_ventas'
        WHEN categoria_evento LIKE 'PERMISO%' THEN 'audit_permisos' END AS tabla_destino, count(*) AS eventos
        FROM feed GROUP BY 1""", "feed"),
    "a12_failure_streaks": sql("SELECT id_evento, usuario, fecha_evento, intentos_cuenta, bloqueado FROM rachas", "rachas"),

    "d1_dim_date": sql("SELECT * FROM calendario", "calendario"),
    "d2_dim_customer": sql("SELECT * FROM dim_c", "dim_c"),
    "d3_dim_product": sql(f"SELECT * EXCLUDE (precio_c), {money('precio_c', 'precio_actual')} FROM dim_p", "dim_p"),
    "d4_fact_sales": sql(f"""SELECT id_tiempo, id_cliente_sk, id_producto_sk, id_venta AS id_venta_nk, id_cliente AS id_cliente_nk,
        id_producto AS id_producto_nk, cantidad, {money('precio_c', 'precio_unitario')}, {money('bruto_c', 'monto_bruto_linea')},
        {money('pct_c', 'descuento_pct')}, {money('desc_c', 'monto_descuento')}, {money('neto_c', 'monto_neto_linea')},
        {money('total_c', 'total_venta')}, estado AS estado_venta, anio AS anio_venta, mes AS mes_venta,
        trimestre AS trimestre_venta FROM hecho""", "hecho"),
    "d4_rounding_residual": sql(f"""SELECT id_venta AS id_venta_nk, {money('max(total_c)', 'total_venta')},
        {money('sum(neto_c)', 'neto_lineas')}, count(*) AS lineas, {money('max(total_c) - sum(neto_c)', 'residuo')}
        FROM hecho GROUP BY 1""", "hecho"),
    "d5_run_etl": sql("""SELECT CAST(1 AS INT) AS orden, 'DimTiempo' AS tabla, count(*) AS filas FROM calendario
        UNION ALL SELECT 2, 'DimCliente', count(*) FROM dim_c UNION ALL SELECT 3, 'DimProducto', count(*) FROM dim_p
        UNION ALL SELECT 4, 'HechoVentas', count(*) FROM hecho""", "calendario", "dim_c", "dim_p", "hecho"),

    "r1_monthly_sales": sql(f"""SELECT periodo, anio, mes, nombre_mes, {big('sum(es_primera)', 'cantidad_ventas')},
        {big('sum(cantidad)', 'unidades_vendidas')}, {money('sum(bruto_c)', 'monto_bruto')},
        {money('sum(desc_c)', 'total_descuentos')}, {money('sum(neto_c)', 'monto_neto')},
        {money(rdiv('sum(total_c)', 'count(*)'), 'ticket_promedio')},
        {money(rdiv('sum(total_c * es_primera)', 'sum(es_primera)'), 'ticket_por_venta')}
        FROM (SELECT h.*, t.anio_mes AS periodo, t.nombre_mes,
          CAST(row_number() OVER (PARTITION BY id_venta) = 1 AS INT) AS es_primera
          FROM hecho h JOIN calendario t USING (id_tiempo)) GROUP BY 1, 2, 3, 4""", "hecho", "calendario"),
    "r2_top_products": sql(f"""SELECT id_producto_sk, nombre_producto, nombre_categoria, rango_precio,
        {big('u', 'unidades_vendidas')}, {money('n', 'monto_neto_total')}, {money(rdiv('p', 'c'), 'precio_promedio_venta')},
        apariciones_en_ventas, {money(rdiv('n * 10000', 't'), 'pct_sobre_total')} FROM (SELECT *, sum(n) OVER () AS t FROM (
        SELECT id_producto_sk, nombre_producto, nombre_categoria, rango_precio, sum(cantidad) AS u, sum(neto_c) AS n,
          sum(precio_c) AS p, count(*) AS c, count(DISTINCT id_venta) AS apariciones_en_ventas FROM hecho GROUP BY 1, 2, 3, 4))
        ORDER BY n DESC, id_producto_sk LIMIT 10""", "hecho"),
    "r2_product_sales": sql(f"""SELECT id_producto_sk, nombre_producto, nombre_categoria, rango_precio,
        {big('u', 'unidades_vendidas')}, {money('n', 'monto_neto_total')}, {money(rdiv('p', 'c'), 'precio_promedio_venta')},
        apariciones_en_ventas, {money(rdiv('n * 10000', 't'), 'pct_sobre_total')} FROM (SELECT *, sum(n) OVER () AS t FROM (
        SELECT id_producto_sk, nombre_producto, nombre_categoria, rango_precio, sum(cantidad) AS u, sum(neto_c) AS n,
          sum(precio_c) AS p, count(*) AS c, count(DISTINCT id_venta) AS apariciones_en_ventas FROM hecho
          GROUP BY 1, 2, 3, 4))""", "hecho"),
    "r3_category_rollup": sql(f"""SELECT CASE WHEN es_total = 1 THEN '── TOTAL GENERAL ──' ELSE nombre_categoria END AS categoria,
        es_total, ventas, {big('u', 'unidades')}, {money('b', 'bruto')}, {money('d', 'descuentos')}, {money('n', 'neto')},
        {money(rdiv('n * 10000', 'todo'), 'pct_categoria')}, {money(rdiv('n * 10000', 'total'), 'pct_real')} FROM (
        SELECT *, sum(n) OVER () AS todo, max(CASE WHEN es_total = 1 THEN n END) OVER () AS total FROM (
        SELECT nombre_categoria, CAST(grouping(nombre_categoria) AS INT) AS es_total, count(DISTINCT id_venta) AS ventas,
          sum(cantidad) AS u, sum(bruto_c) AS b, sum(desc_c) AS d, sum(neto_c) AS n FROM hecho
        GROUP BY ROLLUP (nombre_categoria)))""", "hecho"),
    "r4_customer_ranking": sql(f"""SELECT CAST(rank() OVER (ORDER BY n DESC) AS BIGINT) AS ranking, id_cliente_sk, nombre_completo,
        segmento, ciudad, anio_registro, total_compras, {big('u', 'unidades_compradas')}, {money('n', 'gasto_total_neto')},
        {money(rdiv('tl', 'c'), 'ticket_promedio')}, {money(rdiv('tv', 'total_compras'), 'ticket_por_venta')},
        {money('d', 'descuentos_obtenidos')}, primera_compra, ultima_compra,
        CAST(date_diff('day', primera_compra, ultima_compra) AS INT) AS dias_como_cliente FROM (
        SELECT h.id_cliente_sk, nombre_completo, segmento, ciudad, anio_registro, CAST(sum(es_primera) AS BIGINT) AS total_compras,
          sum(cantidad) AS u, sum(neto_c) AS n, sum(desc_c) AS d, sum(total_c) AS tl, count(*) AS c,
          sum(total_c * es_primera) AS tv, min(t.fecha) AS primera_compra, max(t.fecha) AS ultima_compra
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY id_venta) = 1 AS INT) AS es_primera FROM hecho) h
        JOIN calendario t USING (id_tiempo) JOIN dim_c c ON c.id_cliente_sk = h.id_cliente_sk GROUP BY 1, 2, 3, 4, 5)""",
        "hecho", "calendario", "dim_c"),
    "r5_quarterly_change": sql(f"""SELECT anio, trimestre, anio || ' Q' || trimestre AS periodo, {money('n', 'neto_trimestre')},
        {money('a', 'neto_trimestre_anterior')}, {money('n - a', 'variacion_absoluta')},
        {money(rdiv('(n - a) * 10000', 'a'), 'variacion_pct')} FROM (
        SELECT *, lag(n) OVER (ORDER BY anio, trimestre) AS a FROM (SELECT t.anio, t.trimestre, sum(neto_c) AS n
        FROM hecho JOIN calendario t USING (id_tiempo) GROUP BY 1, 2))""", "hecho", "calendario"),
    "r6_month_category_oltp": sql(f"""SELECT strftime(fecha_venta, '%Y-%m') AS periodo, k.nombre AS categoria,
        count(DISTINCT id_venta) AS ventas, {big('sum(cantidad)', 'unidades')}, {money('sum(b)', 'monto_bruto')},
        {money('sum(n)', 'monto_neto')} FROM (SELECT v.id_venta, fecha_venta, l.id_producto, cantidad,
          cantidad * precio_c AS b, {rdiv('CAST(cantidad * precio_c AS HUGEINT) * total_c',
          'sum(cantidad * precio_c) OVER (PARTITION BY v.id_venta)')} AS n
          FROM ventas v JOIN lineas l ON l.id_venta = v.id_venta WHERE estado <> 'cancelada') x
        JOIN productos p USING (id_producto) JOIN categorias k ON k.id_categoria = p.id_categoria
        GROUP BY 1, 2 ORDER BY 1, 2""", "ventas", "lineas", "productos", "categorias"),
    "r7_month_category_dw": sql(f"""SELECT anio_mes AS periodo, nombre_categoria AS categoria, count(DISTINCT id_venta) AS ventas,
        {big('sum(cantidad)', 'unidades')}, {money('sum(bruto_c)', 'monto_bruto')}, {money('sum(neto_c)', 'monto_neto')}
        FROM hecho JOIN calendario USING (id_tiempo) GROUP BY 1, 2 ORDER BY 1, 2""", "hecho", "calendario"),
    "r8_reconcile": sql("""SELECT anio_mes AS periodo, nombre_categoria AS categoria, 'ambos' AS presente,
        CAST(0 AS BIGINT) AS dif_ventas, CAST(0 AS BIGINT) AS dif_unidades, CAST(0 AS DOUBLE) AS dif_monto_bruto,
        CAST(0 AS DOUBLE) AS dif_monto_neto FROM hecho JOIN calendario USING (id_tiempo) GROUP BY 1, 2""", "hecho", "calendario"),
    "r9_concentration": sql(f"""SELECT id_producto_sk, {money('n', 'monto_neto_total')},
        CAST(rank() OVER (ORDER BY n DESC) AS BIGINT) AS puesto, {money(rdiv('n * 10000', 't'), 'pct')},
        {money(rdiv('c * 10000', 't'), 'pct_acumulado')} FROM (SELECT *, sum(n) OVER () AS t, sum(n) OVER (ORDER BY n DESC) AS c
        FROM (SELECT id_producto_sk, sum(neto_c) AS n FROM hecho GROUP BY 1))""", "hecho"),
    "r10_extremes": sql(f"""SELECT arg_max(periodo, n) AS mejor, {money('max(n)', 'mejor_valor')}, arg_min(periodo, n) AS peor,
        {money('min(n)', 'peor_valor')} FROM (SELECT anio_mes AS periodo, sum(neto_c) AS n FROM hecho
        JOIN calendario USING (id_tiempo) GROUP BY 1)""", "hecho", "calendario"),
    "r11_segment_check": sql(f"""SELECT ranking, id_cliente_sk, nombre_completo, segmento, {money('n', 'gasto_total_neto')},
        total_compras FROM (SELECT CAST(rank() OVER (ORDER BY n DESC) AS BIGINT) AS ranking, * FROM (
        SELECT h.id_cliente_sk, nombre_completo, segmento, sum(neto_c) AS n, count(DISTINCT id_venta) AS total_compras
        FROM hecho h JOIN dim_c c ON c.id_cliente_sk = h.id_cliente_sk GROUP BY 1, 2, 3))
        WHERE ranking <= 2000 AND segmento = 'NUEVO'""", "hecho", "dim_c"),
}

_STOCK = "SELECT c.cart_id, coalesce(falla, 0) AS codigo, coalesce(texto, 'Stock verificado: disponibilidad suficiente en todos " \
         "los productos.') AS mensaje FROM {} c LEFT JOIN j_first f ON f.cart_id = c.cart_id"
ORACLE["c4_check_stock"] = sql(_STOCK.format("carros"), "carros", "j_first", extra=CARTS)
ORACLE["c4_check_stock_json"] = sql(_STOCK.format("carros_json"), "carros_json", "j_first", extra=JSON_CARTS)

_QUEUE = ("SELECT i.*, submitted_at, CAST(sum(cantidad) OVER (PARTITION BY id_producto ORDER BY submitted_at, cart_id, pos "
          "ROWS UNBOUNDED PRECEDING) AS BIGINT) AS demanda_acumulada FROM items i JOIN carros USING (cart_id)")
ORACLE["c9_allocate_stock"] = sql(f"""SELECT cart_id, pos, q.id_producto, cantidad, demanda_acumulada, p.stock,
    coalesce(demanda_acumulada <= p.stock, false) AS asignado FROM ({_QUEUE}) q
    LEFT JOIN (SELECT * FROM productos WHERE activo) p ON p.id_producto = q.id_producto""", "items", "carros", "productos")
ORACLE["c9_first_oversold"] = sql(f"""SELECT id_producto, cart_id, submitted_at, demanda_acumulada, stock FROM (
    SELECT q.id_producto, cart_id, submitted_at, demanda_acumulada, p.stock, row_number() OVER (PARTITION BY q.id_producto
      ORDER BY submitted_at, cart_id, pos) AS rn FROM ({_QUEUE}) q
    LEFT JOIN (SELECT * FROM productos WHERE activo) p ON p.id_producto = q.id_producto
    WHERE NOT coalesce(demanda_acumulada <= p.stock, false)) WHERE rn = 1""", "items", "carros", "productos")

ORACLE["v23_constraint_audit_dirty"] = sql(
    re.sub(r"FROM (clientes|categorias|productos|usuarios|ventas|lineas)\b", r"FROM d_\1", _CONSTRAINTS), *_DIRTY, extra=_DIRTY)
ORACLE["a11_config_report"] = sql("""SELECT 'audit_' || username AS nombre_audit, accion, lower(accion) AS tabla_destino, activo,
    TIMESTAMP '2025-06-01' AS fecha_creacion, rol AS creado_por, CAST(NULL AS VARCHAR) AS descripcion
    FROM (SELECT *, CASE id_usuario % 3 WHEN 0 THEN 'DELETE' WHEN 1 THEN 'GRANT_REVOKE' ELSE 'FAILED_LOGIN' END AS accion FROM usuarios)""",
    "usuarios")
ORACLE["d1_extend_dim_date"] = ORACLE["d1_dim_date"]
_SINGLES = {"vendidos": (["pedidos", "productos", "clientes", "usuarios", "ventas"], """
    SELECT o.*, p.precio_c, row_number() OVER (ORDER BY pedido_id) + (SELECT max(id_venta) FROM ventas) AS id_venta
    FROM pedidos o JOIN (SELECT * FROM productos WHERE activo) p USING (id_producto)
    WHERE o.id_cliente IN (SELECT id_cliente FROM clientes) AND o.id_usuario IN (SELECT id_usuario FROM usuarios WHERE activo)
      AND p.stock >= o.cantidad AND o.cantidad > 0""")}
ORACLE["c11_single_sale_headers"] = sql(f"""SELECT id_venta, id_cliente, id_usuario, TIMESTAMP '2025-06-01' AS fecha_venta,
    {money('precio_c * cantidad', 'total')}, 'confirmada' AS estado,
    'Insertado vía sp_insertar_pedido_via_vista (fachada de vista_pedidos_completos)' AS observaciones,
    'Pedido registrado vía vista_pedidos_completos. Venta id=' || id_venta AS mensaje FROM vendidos""", "vendidos", extra=_SINGLES)
ORACLE["c11_single_sale_lines"] = sql(f"SELECT id_venta, id_producto, cantidad, {money('precio_c', 'precio_unitario')} FROM vendidos",
                                      "vendidos", extra=_SINGLES)

# the same rounds: certain acceptances and refusals, until no cart is undecided
ORACLE["c9_replay_stock"] = "WITH RECURSIVE" + sql(f"""SELECT cart_id, CAST(bool_and(st) AS BOOLEAN) AS aceptado, max(rd) AS ronda FROM rondas
    WHERE it = (SELECT max(it) FROM rondas) GROUP BY cart_id""", "rondas", extra={"rondas": (["items", "carros", "productos"], """
    SELECT 0 AS it, cart_id, id_producto, submitted_at, q, stock, CASE WHEN NOT bool_and(ok) OVER (PARTITION BY cart_id) THEN false END AS st,
      CASE WHEN NOT bool_and(ok) OVER (PARTITION BY cart_id) THEN 0 END AS rd FROM (
        SELECT i.cart_id, i.id_producto, min(c.submitted_at) AS submitted_at, CAST(sum(i.cantidad) AS BIGINT) AS q, min(p.stock) AS stock,
          bool_and(coalesce(i.cantidad > 0 AND p.stock IS NOT NULL, false)) AS ok
        FROM items i JOIN carros c USING (cart_id) LEFT JOIN (SELECT * FROM productos WHERE activo) p ON p.id_producto = i.id_producto
        GROUP BY i.cart_id, i.id_producto)
    UNION ALL
    SELECT it + 1, cart_id, id_producto, submitted_at, q, stock, coalesce(st, CASE WHEN cabe THEN true WHEN rompe THEN false END),
      CASE WHEN st IS NOT NULL THEN rd WHEN cabe OR rompe THEN it + 1 END FROM (
        SELECT *, bool_and(todo <= stock) OVER (PARTITION BY cart_id) AS cabe, bool_or(cierto + q > stock) OVER (PARTITION BY cart_id) AS rompe,
          bool_or(st IS NULL) OVER () AS abierto FROM (
            SELECT *, sum(CASE WHEN st IS DISTINCT FROM false THEN q ELSE 0 END) OVER cola AS todo,
              sum(CASE WHEN st THEN q ELSE 0 END) OVER cola AS cierto FROM rondas
            WINDOW cola AS (PARTITION BY id_producto ORDER BY submitted_at, cart_id ROWS UNBOUNDED PRECEDING))) WHERE abierto""")}).removeprefix("WITH")

# files by the rows' numbers; rows of a file in their order, files one after another; one size has a field too many
_ARRIVED = """SELECT *, row_number() OVER (PARTITION BY k, apta ORDER BY lote, fila) AS vez FROM (
    SELECT *, NOT (f_nombre OR f_clave OR f_fk OR d_lenient IS NULL OR larga) AS apta FROM (
    SELECT *, fila // 7 % 4 AS lote, fila IN (SELECT p_partkey FROM part WHERE p_size = 15) AS larga FROM p_flags))"""
ORACLE["t1_import_stream"] = sql(f"""SELECT cat AS id_categoria, trim(nombre) AS nombre, descripcion,
    CAST(greatest(d_lenient, 0) AS DOUBLE) AS precio, greatest(coalesce(n_stock, 0), 0) AS stock,
    activo IS DISTINCT FROM 'FALSE' AS activo FROM ({_ARRIVED})
    WHERE apta AND vez = 1 AND k NOT IN (SELECT k FROM catalogo)""", "p_flags", "catalogo")
ORACLE["t1_rejected_rows"] = sql(f"""SELECT CASE WHEN NOT larga THEN nombre END AS nombre,
    CASE WHEN NOT larga THEN descripcion END AS descripcion, CASE WHEN NOT larga THEN precio END AS precio, regla,
    CASE regla WHEN 'archivo_malformado' THEN concat_ws(',', coalesce(id_categoria, ''), nombre, descripcion, coalesce(precio, ''),
        coalesce(stock, ''), coalesce(activo, ''), 'x')
      WHEN 'clave_invalida' THEN id_categoria WHEN 'clave_foranea' THEN id_categoria WHEN 'no_numerico' THEN precio
      ELSE nombre END AS valor
    FROM (SELECT r.*, CASE WHEN larga THEN 'archivo_malformado' WHEN f_nombre THEN 'obligatorio'
        WHEN f_existe OR r.lote > a.lote THEN 'duplicado' WHEN r.lote = a.lote AND r.fila > a.fila THEN 'duplicado_lote'
        WHEN f_clave THEN 'clave_invalida' WHEN f_fk THEN 'clave_foranea' WHEN d_lenient IS NULL THEN 'no_numerico' END AS regla
      FROM ({_ARRIVED}) r LEFT JOIN (SELECT k, lote, fila FROM ({_ARRIVED}) WHERE apta AND vez = 1 AND NOT f_existe) a ON a.k = r.k)
    WHERE regla IS NOT NULL""", "p_flags", "catalogo")
ORACLE["t2_price_stream"] = ORACLE["a3_price_history"]
