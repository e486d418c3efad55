"""Money arithmetic: exact apportioning, discounts and net totals as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork import schema as S


def _cents(amount: Column, kind: str) -> Column:
    return (amount * 100).cast(kind)


def _half_away(num: Column, den: Column) -> Column:
    """num / den to the nearest whole number, halves away from zero; NULL unless den is positive."""
    two, den = F.lit(2).cast("decimal(1,0)"), F.when(den > 0, den)
    return F.call_function("div", num * two + F.when(num < 0, -den).otherwise(den), den * two)


def _from_cents(value: Column) -> Column:
    return (value.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(S.WIDE)


def apportion(df: DataFrame, amount: str, total: str, whole: str, pct: str, off: str, net: str) -> DataFrame:
    """Spreads ``total`` over amounts that add up to ``whole``: ``net`` is the amount's part of
    it, ``off`` what the amount loses, ``pct`` that loss in percent; all NULL when whole is 0.

    One exact rule for every size: whole cents, multiplied first, divided once as integers.
    Amounts and totals of 12 digits and a whole of 18 keep every product within 38 digits.
    """
    a, t, w = F.col("_a"), F.col("_t"), F.col("_w")
    split = df.withColumns({"_a": _cents(F.col(amount), "decimal(12,0)"), "_t": _cents(F.col(total), "decimal(12,0)"),
                            "_w": _cents(F.col(whole), "decimal(18,0)")})
    part = lambda num: _from_cents(_half_away(num, w))
    return split.withColumns({pct: part((w - t) * F.lit(10_000).cast("decimal(5,0)")), off: part(a * (w - t)),
                              net: part(a * t)}).drop("_a", "_t", "_w")


def percent(part: Column, whole: Column) -> Column:
    """round(part * 100 / whole, 2); NULL when whole is 0."""
    return F.round(part.cast(S.TOTAL) * 100 / F.nullif(whole.cast(S.TOTAL), F.lit(0)), 2).cast(S.WIDE)


def average(total: Column, count: Column) -> Column:
    """round(total / count, 2); NULL over no rows."""
    return F.round(total.cast(S.TOTAL) / F.nullif(count, F.lit(0)), 2).cast(S.WIDE)


def discount_pct(gross: Column, items: Column, client: Column, delivered: Column,
                 tiers=S.DISCOUNT_TIERS, ceiling: str = S.DISCOUNT_CEILING) -> Column:
    """Discount from amount, volume and loyalty. No client, no loyalty bonus."""
    pct = lambda text: F.lit(text).cast("decimal(5,2)")
    base = F
    for floor, value in tiers:
        base = base.when(gross >= F.lit(floor).cast(S.MONEY), pct(value))
    volume = F.when(items >= S.VOLUME_ITEMS, pct(S.VOLUME_BONUS)).otherwise(pct("0"))
    loyal = client.isNotNull() & (F.coalesce(delivered, F.lit(0)) > S.LOYALTY_SALES)
    loyalty = F.when(loyal, pct(S.LOYALTY_BONUS)).otherwise(pct("0"))
    return F.least(base.otherwise(pct("0")) + volume + loyalty, pct(ceiling)).cast("decimal(5,2)")


def net_total(gross: Column, pct: Column) -> Column:
    """Gross less a percentage held between 0 and 100; a negative gross is worth nothing.

    NULL where the gross has more digits than an amount may have.
    """
    held = F.when(pct < 0, F.lit(0)).when(pct > 100, F.lit(100)).otherwise(pct).cast("decimal(5,2)")
    rate = F.lit(1) - held * F.lit("0.01").cast("decimal(3,2)")
    net = F.round(gross.try_cast(S.MONEY) * rate, 2)
    return F.when(gross < 0, F.lit(0)).otherwise(net).cast(S.MONEY)


def register_sql_functions(spark: SparkSession, sales_view: str = "ventas") -> None:
    """The same two calculations for SQL users. They are SQL bodies, so Catalyst inlines them.

    The discount looks up delivered sales in ``sales_view``, as a correlated subquery that
    becomes a join with one aggregate.
    """
    tiers = " ".join(f"WHEN gross >= {floor} THEN {value}" for floor, value in S.DISCOUNT_TIERS)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION fn_calcular_descuento(
            gross DECIMAL(12,2), items INT, client INT) RETURNS DECIMAL(5,2)
        RETURN CAST(least({S.DISCOUNT_CEILING},
            (CASE {tiers} ELSE 0 END)
            + if(items >= {S.VOLUME_ITEMS}, {S.VOLUME_BONUS}, 0)
            + if((SELECT count(*) FROM {sales_view} v
                  WHERE v.id_cliente = client AND v.estado = '{S.DELIVERED}') > {S.LOYALTY_SALES},
                 {S.LOYALTY_BONUS}, 0)
        ) AS DECIMAL(5,2))""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION fn_calcular_total_venta(
            gross DECIMAL(12,2), pct DECIMAL(5,2)) RETURNS DECIMAL(12,2)
        RETURN CAST(CASE WHEN gross < 0 THEN 0
            ELSE round(gross * (1 - (CASE WHEN pct < 0 THEN 0 WHEN pct > 100 THEN 100 ELSE pct END) * 0.01), 2)
            END AS DECIMAL(12,2))""")
