"""What the two imports write about a row, by rule and field."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, functions as F

from tillwork.functions import dates
from tillwork.functions.rules import Rule, to_int
from tillwork.functions.text import is_blank, show

# The observation texts of the staging tables; {} is the field as it came.
STRICT_PRODUCTS = {
    ("obligatorio", "nombre"): "nombre vacío o NULL – campo NOT NULL obligatorio",
    ("no_numerico", "precio"): 'precio="{}" no es un valor numérico válido',
    ("clave_invalida", "id_categoria"): "id_categoria NULL – campo NOT NULL y FK requerida",
    ("clave_foranea", "id_categoria"): "id_categoria={} no existe en tabla Categorias – FK violation",
    ("duplicado", "nombre"): 'nombre="{}" ya existe en Productos – registro duplicado',
    ("precio_negativo", "precio"): "precio negativo ({}) corregido a 0.00 – viola CHECK (precio >= 0)",
}
STRICT_CLIENTS = {
    ("obligatorio", "nombre"): "nombre vacío o NULL – NOT NULL obligatorio",
    ("formato_email", "email"): 'email="{}" formato inválido – no contiene @',
    ("duplicado", "email"): 'email="{}" ya existe en Clientes – registro duplicado',
    ("fecha_invalida", "fecha_registro"): 'fecha_registro="{}" es una fecha imposible (día/mes fuera de rango)',
    ("texto_vacio", "apellido"): 'apellido NULL corregido a "(sin apellido)" – NOT NULL obligatorio',
}

# The messages of the file import; warnings come with what was done.
LENIENT_PRODUCTS = {
    ("obligatorio", "nombre"): "nombre vacío – campo NOT NULL requerido",
    ("duplicado", "nombre"): "duplicado – '{}' ya existe en Productos",
    ("duplicado_lote", "nombre"): "duplicado – '{}' ya existe en Productos",
    ("clave_invalida", "id_categoria"): "id_categoria='{}' es nulo o no es entero – integridad referencial violada",
    ("clave_foranea", "id_categoria"): "id_categoria={} no existe en tabla Categorias – FK violation",
    ("no_numerico", "precio"): "precio='{}' no es numérico – descartado",
    ("precio_negativo", "precio"): ("precio negativo viola CHECK (precio >= 0)", "valor corregido a 0.00"),
    ("separador_decimal", "precio"): ("separador decimal no estándar", "normalizado a punto decimal"),
    ("entero_invalido", "stock"): ("stock no es entero", "asignado valor por defecto 0"),
    ("entero_negativo", "stock"): ("stock negativo viola CHECK (stock >= 0)", "corregido a 0"),
    ("booleano_invalido", "activo"): ("valor booleano no reconocido", "asignado TRUE por defecto"),
}
LENIENT_CLIENTS = {
    ("obligatorio", "nombre"): "nombre vacío – NOT NULL requerido",
    ("texto_vacio", "apellido"): ("apellido vacío – NOT NULL requerido", "asignado '(sin apellido)' como temporal"),
    ("obligatorio", "email"): "email vacío – NOT NULL + UNIQUE requerido",
    ("formato_email", "email"): "email='{}' formato inválido (sin @) – descartado",
    ("duplicado", "email"): "email='{}' ya existe en Clientes – duplicado descartado",
    ("duplicado_lote", "email"): "email='{}' ya existe en Clientes – duplicado descartado",
    ("fecha_invalida", "fecha_registro"): ("fecha inválida o formato no reconocido", "asignada fecha actual como fallback"),
    ("formato_fecha", "fecha_registro"): ("formato de fecha no estándar (esperado YYYY-MM-DD)", "convertida a {}"),
    ("fecha_futura", "fecha_registro"): ("fecha en el futuro", "corregida a fecha actual"),
}


def _filled(template: str, value: Column) -> Column:
    before, hole, after = template.partition("{}")
    return F.concat(F.lit(before), value, F.lit(after)) if hole else F.lit(template)


def worded(rules: list[Rule], texts: dict, strict: bool) -> list[Rule]:
    """The rules with the import's own texts. The database shows values as they came, a missing one as
    NULL; the file import trims them, and a missing one is empty."""
    out = []
    for rule in rules:
        found = texts[rule.name, rule.field]
        problem, action = found if isinstance(found, tuple) else (found, rule.action)
        came = F.col(rule.field)
        value = show(came) if strict else F.coalesce(came if rule.name == "no_numerico" else F.trim(came), F.lit(""))
        if rule.name == "clave_foranea" and not strict:
            value = to_int(came).cast("string")
        text = _filled(problem, value)
        if rule.name == "clave_invalida" and strict:  # a text that is no number names a category that is not there
            text = F.when(is_blank(came), text).otherwise(_filled(texts["clave_foranea", rule.field], value))
        if rule.name == "formato_fecha":
            action = _filled(action, dates.parse_any(came).cast("string"))
        out.append(replace(rule, problem=text, action=action))
    return out
