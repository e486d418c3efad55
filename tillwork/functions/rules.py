"""Import rules: each is one Boolean column plus the texts that explain it.

A rule never changes data by itself. ``operators.validation.validate`` evaluates an
ordered list of them in a single pass and applies the repairs of those that fired.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from tillwork import schema as S
from tillwork.functions import dates
from tillwork.functions.text import blank_to_null, is_blank, show

# Accepted shapes of numbers, e-mail addresses and Booleans in import files.
NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
#: what the file import reads as a number: a sign, digits on either side of the point, an exponent
LENIENT_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+$"
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
BOOLEANS = ["0", "1", "true", "false", "TRUE", "FALSE"]
TRUE_TEXTS = ["1", "true", "TRUE"]


@dataclass(frozen=True)
class Rule:
    name: str
    field: str
    fails: Column
    problem: Column
    action: str | Column = "descartado"
    repair: Column | None = None  # set: the row survives with this value in ``field``

    @property
    def rejects(self) -> bool:
        return self.repair is None


def _quoted(field: str, rest: str) -> Column:
    return F.concat(F.lit(f'{field}="'), show(F.col(field)), F.lit(f'" {rest}'))


def to_decimal(text: Column, kind=S.PRICE, comma: bool = False) -> Column:
    clean = F.trim(text)
    if comma:
        clean = F.regexp_replace(clean, ",", ".")
    return F.when(clean.rlike(LENIENT_NUMBER if comma else NUMBER), clean.try_cast(kind))


def to_int(text: Column) -> Column:
    clean = F.trim(text)
    return F.when(clean.rlike(INTEGER), clean.try_cast("int"))


def to_bool(text: Column) -> Column:
    """Missing and unrecognised both mean true."""
    clean = blank_to_null(text)
    return F.when(clean.isin(BOOLEANS), clean.isin(TRUE_TEXTS)).otherwise(F.lit(True))


def rule_required(field: str) -> Rule:
    return Rule("obligatorio", field, is_blank(F.col(field)),
                F.lit(f"{field} vacío o NULL – campo NOT NULL obligatorio"))


def rule_decimal(field: str, kind=S.PRICE, comma: bool = False) -> Rule:
    return Rule("no_numerico", field, to_decimal(F.col(field), kind, comma).isNull(),
                _quoted(field, "no es un valor numérico válido"))


def rule_int_key(field: str) -> Rule:
    return Rule("clave_invalida", field, to_int(F.col(field)).isNull(),
                _quoted(field, "es nulo o no es entero – NOT NULL y FK requerida"))


def rule_fk(field: str, found: str, parent: str) -> Rule:
    """``found`` is the flag column left by ``operators.validation.mark_parent``."""
    return Rule("clave_foranea", field, ~F.col(found),
                F.concat(F.lit(f"{field}="), show(F.col(field)), F.lit(f" no existe en {parent} – FK violation")))


def rule_exists(field: str, found: str, target: str) -> Rule:
    return Rule("duplicado", field, F.col(found),
                _quoted(field, f"ya existe en {target} – registro duplicado"))


def rule_batch_dup(field: str, repeated: str) -> Rule:
    return Rule("duplicado_lote", field, F.col(repeated),
                _quoted(field, "repetido en el mismo lote – registro duplicado"))


def rule_email(field: str) -> Rule:
    bad = ~F.coalesce(F.trim(F.col(field)).rlike(EMAIL), F.lit(False))
    return Rule("formato_email", field, bad, _quoted(field, "formato inválido"))


def rule_date(field: str) -> Rule:
    """Strict policy: only the standard layout is accepted."""
    return Rule("fecha_invalida", field, dates.parse_iso(F.col(field)).isNull(),
                _quoted(field, "es una fecha imposible (día/mes fuera de rango)"))


def fix_bad_date(field: str, run_date: Column) -> Rule:
    """Lenient policy: an unreadable date becomes the run date."""
    return Rule("fecha_invalida", field, dates.parse_any(F.col(field)).isNull(),
                _quoted(field, "fecha inválida o formato no reconocido"), "asignada fecha de ejecución", run_date)


def fix_date_layout(field: str) -> Rule:
    parsed = dates.parse_any(F.col(field))
    return Rule("formato_fecha", field, dates.parse_iso(F.col(field)).isNull() & parsed.isNotNull(),
                _quoted(field, "formato de fecha no estándar (esperado YYYY-MM-DD)"),
                "convertida a YYYY-MM-DD", parsed)


def fix_future_date(field: str, run_date: Column) -> Rule:
    return Rule("fecha_futura", field, dates.parse_any(F.col(field)) > run_date,
                _quoted(field, "fecha en el futuro"), "corregida a fecha de ejecución", run_date)


def fix_negative(field: str, kind=S.PRICE, comma: bool = False) -> Rule:
    return Rule("precio_negativo", field, to_decimal(F.col(field), kind, comma) < 0,
                F.concat(F.lit(f"{field} negativo ("), show(F.col(field)), F.lit(f") viola CHECK ({field} >= 0)")),
                "corregido a 0.00", F.lit(0).cast(kind))


def fix_decimal_comma(field: str, kind=S.PRICE) -> Rule:
    """Reported even where the sign was repaired first, so the value is left as that rule set it."""
    value = to_decimal(F.col(field), kind, comma=True)
    return Rule("separador_decimal", field, F.col(field).contains(",") & value.isNotNull(),
                _quoted(field, "separador decimal no estándar"), "normalizado a punto decimal",
                F.greatest(value, F.lit(0).cast(kind)))


def fix_int_default(field: str) -> list[Rule]:
    value = to_int(F.col(field))
    return [
        Rule("entero_invalido", field, value.isNull(), _quoted(field, "no es entero"),
             "asignado valor por defecto 0", F.lit(0)),
        Rule("entero_negativo", field, value < 0, _quoted(field, f"viola CHECK ({field} >= 0)"),
             "corregido a 0", F.lit(0)),
    ]


def fix_bool_default(field: str) -> Rule:
    clean = blank_to_null(F.col(field))
    return Rule("booleano_invalido", field, clean.isNotNull() & ~clean.isin(BOOLEANS),
                _quoted(field, "valor booleano no reconocido"), "asignado TRUE por defecto", F.lit(True))


def fix_default_text(field: str, default: str = S.NO_SURNAME) -> Rule:
    return Rule("texto_vacio", field, is_blank(F.col(field)),
                F.lit(f"{field} vacío – NOT NULL obligatorio"), f"asignado {default}", F.lit(default))
