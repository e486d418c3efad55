"""Table schemas and the fixed vocabulary of the sales model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Sale states, roles and labels; results must carry exactly these texts.
PENDING = "pendiente"
CONFIRMED = "confirmada"
CANCELLED = "cancelada"
DELIVERED = "entregada"
SALE_STATES = [PENDING, CONFIRMED, CANCELLED, DELIVERED]
ROLES = ["admin", "vendedor", "supervisor"]

ROW_PENDING = "pendiente"
ROW_OK = "ok"
ROW_ERROR = "error"
ROW_FIXED = "corregido"
ROW_STATES = [ROW_OK, ROW_FIXED, ROW_ERROR, ROW_PENDING]  # report order

MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
DAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
TOTAL_LABEL = "── TOTAL GENERAL ──"
NO_SURNAME = "(sin apellido)"

# Customer segments by delivered purchases, highest first; the last is the default.
SEGMENTS = [(10, "VIP"), (5, "FRECUENTE"), (1, "OCASIONAL")]
DEFAULT_SEGMENT = "NUEVO"
# Price bands by exclusive upper bound; the last is open.
PRICE_BANDS = [("5000", "ECONOMICO"), ("50000", "MEDIO")]
TOP_PRICE_BAND = "PREMIUM"

# Discount by gross amount, highest first, then the two bonuses and the ceiling.
DISCOUNT_TIERS = [("200000", "15"), ("100000", "10"), ("50000", "5")]
VOLUME_ITEMS, VOLUME_BONUS = 5, "3"
LOYALTY_SALES, LOYALTY_BONUS = 5, "5"
DISCOUNT_CEILING = "30"
# ---------------------------------------------------------------------------

PRICE = T.DecimalType(10, 2)
MONEY = T.DecimalType(12, 2)
# One sale's sums and ratios; wide enough that an extreme ratio is a number, not an error.
WIDE = T.DecimalType(18, 2)
# Sums over any number of sales.
TOTAL = T.DecimalType(22, 2)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, len(rest) == 0 or rest[0]) for name, kind, *rest in fields])


_int, _text, _date, _ntz, _bool = (
    T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType(),
)

CATEGORIAS = _struct(("id_categoria", _int, False), ("nombre", _text, False), ("descripcion", _text))
PRODUCTOS = _struct(
    ("id_producto", _int, False), ("id_categoria", _int, False), ("nombre", _text, False),
    ("descripcion", _text), ("precio", PRICE, False), ("stock", _int, False), ("activo", _bool, False),
)
CLIENTES = _struct(
    ("id_cliente", _int, False), ("nombre", _text, False), ("apellido", _text, False),
    ("email", _text, False), ("telefono", _text), ("direccion", _text), ("fecha_registro", _date, False),
)
USUARIOS = _struct(
    ("id_usuario", _int, False), ("username", _text, False), ("password_hash", _text, False),
    ("rol", _text, False), ("activo", _bool, False), ("ultimo_login", _ntz),
)
VENTAS = _struct(
    ("id_venta", _int, False), ("id_cliente", _int, False), ("id_usuario", _int, False),
    ("fecha_venta", _ntz, False), ("total", MONEY, False), ("estado", _text, False),
    ("observaciones", _text),
)
DETALLE_VENTAS = _struct(
    ("id_detalle", _int, False), ("id_venta", _int, False), ("id_producto", _int, False),
    ("cantidad", _int, False), ("precio_unitario", PRICE, False),
)

# Import files arrive as text only; types are decided by the rules, never inferred.
STAGING_PRODUCTOS = _struct(*[(c, _text) for c in
                              ("id_categoria", "nombre", "descripcion", "precio", "stock", "activo")])
STAGING_CLIENTES = _struct(*[(c, _text) for c in
                             ("nombre", "apellido", "email", "telefono", "direccion", "fecha_registro")])
# What an accepted staging row becomes; ids are assigned by the target.
NUEVO_PRODUCTO = _struct(
    ("id_categoria", _int), ("nombre", _text), ("descripcion", _text), ("precio", PRICE),
    ("stock", _int), ("activo", _bool),
)
NUEVO_CLIENTE = _struct(
    ("nombre", _text), ("apellido", _text), ("email", _text), ("telefono", _text),
    ("direccion", _text), ("fecha_registro", _date),
)

CART_ITEMS = T.ArrayType(_struct(("id_producto", T.LongType()), ("cantidad", _int)))
CARTS = _struct(
    ("cart_id", _int, False), ("id_cliente", _int), ("id_usuario", _int), ("items_json", _text),
    ("observacion", _text), ("submitted_at", _ntz),
)
SNAPSHOT_LOG = _struct(
    ("tipo", _text, False), ("tabla_afectada", _text), ("archivo", _text),
    ("filas_respaldadas", T.LongType()), ("fecha_inicio", _ntz, False),
)

AUDIT_CONFIG = _struct(
    ("nombre_audit", _text, False), ("accion", _text, False), ("tabla_destino", _text, False),
    ("activo", _bool, False), ("fecha_creacion", _ntz), ("creado_por", _text), ("descripcion", _text),
)
AUDIT_DELETES = _struct(
    ("id_evento", _int, False), ("id_venta", _int), ("id_cliente_ref", _int), ("id_usuario_ref", _int),
    ("total_ref", MONEY), ("estado_ref", _text), ("usuario_bd", _text, False), ("host_origen", _text, False),
    ("resultado", _text, False), ("motivo_bloqueo", _text), ("fecha_evento", _ntz, False),
    ("datos_eliminados", _text),
)
AUDIT_BLOCKED = _struct(
    ("id_evento", _int, False), ("id_venta_ref", _int), ("usuario_bd", _text, False),
    ("host_origen", _text, False), ("motivo", _text, False), ("fecha_evento", _ntz, False),
)
AUDIT_GRANTS = _struct(
    ("id_evento", _int, False), ("accion", _text, False), ("privilegio", _text, False),
    ("objeto", _text, False), ("beneficiario", _text, False), ("otorgado_por", _text, False),
    ("with_grant_option", _bool, False), ("resultado", _text, False), ("detalle_error", _text),
    ("fecha_evento", _ntz, False), ("sentencia_sql", _text),
)
AUDIT_LOGINS = _struct(
    ("id_evento", _int, False), ("usuario_intento", _text, False), ("host_origen", _text, False),
    ("intentos_cuenta", _int, False), ("bloqueado", _bool, False), ("descripcion", _text),
    ("fecha_evento", _ntz, False),
)
