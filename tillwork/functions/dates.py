"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillwork import schema as S

# Accepted date layouts in priority order. The first is the standard one.
DATE_FORMATS = ["yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "yyyyMMdd"]


def parse_iso(text: Column) -> Column:
    return F.try_to_date(F.trim(text), "yyyy-M-d")


def parse_any(text: Column) -> Column:
    clean = F.trim(text)
    return F.coalesce(*[F.try_to_date(clean, fmt) for fmt in DATE_FORMATS])


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(day: Column) -> Column:
    """'YYYY-MM' without going through a time zone."""
    return F.substring(day.cast("date").cast("string"), 1, 7)


def hour_slice(ts: Column) -> Column:
    """Hours since 1970 as an integer; grows with ts and reads no session time zone."""
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)


def _name(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def calendar_columns(day: Column, months=S.MONTH_NAMES, days=S.DAY_NAMES) -> list[Column]:
    weekday = F.weekday(day) + 1
    return [
        date_key(day).alias("id_tiempo"),
        day.alias("fecha"),
        F.year(day).cast("short").alias("anio"),
        F.quarter(day).cast("byte").alias("trimestre"),
        F.month(day).cast("byte").alias("mes"),
        _name(months, F.month(day)).alias("nombre_mes"),
        F.weekofyear(day).cast("byte").alias("semana_anio"),
        F.dayofmonth(day).cast("byte").alias("dia_mes"),
        weekday.cast("byte").alias("dia_semana"),
        _name(days, weekday).alias("nombre_dia"),
        (weekday >= 6).alias("es_fin_semana"),
        month_key(day).alias("anio_mes"),
    ]
