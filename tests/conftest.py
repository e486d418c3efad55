import datetime as dt
from decimal import Decimal

import pytest

from tillwork import build_session, schema as S
from tillwork.sources.testtables import TestTables


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__sql__session__timeZone="UTC", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    return TestTables(spark, "/root/testdata/sf0.001")


def rows(df, *cols):
    """Collected rows as tuples, decimals as floats where they are exact in two places."""
    out = df.select(*cols) if cols else df
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in out.collect()]


@pytest.fixture(scope="session")
def seed(spark):
    """A hand-sized shop with known totals.

    Fixed values: the reports' golden results are stated for exactly these rows. Telephones are empty.
    """
    D, ts, day = Decimal, dt.datetime, dt.date
    frame = lambda data, kind: spark.createDataFrame(data, kind)
    categorias = [(1, "Electrónica"), (2, "Ropa"), (3, "Alimentos"), (4, "Hogar"), (5, "Deportes")]
    productos = [
        (1, 1, "Smartphone X12", 75000, 50), (2, 1, "Laptop ProBook", 320000, 20),
        (3, 1, "Auriculares BT", 18500, 80), (4, 2, "Remera básica", 3500, 200),
        (5, 2, "Campera invierno", 12000, 60), (6, 3, "Café molido 500g", 2800, 300),
        (7, 3, "Granola artesanal", 1900, 150), (8, 4, "Silla ergonómica", 45000, 25),
        (9, 4, "Lámpara LED", 8700, 90), (10, 5, "Pelota de fútbol", 6500, 70),
        (11, 5, "Mochila deportiva", 9800, 45),
    ]
    clientes = [
        (1, "Ana", "García", "ana.garcia@email.com", "Av. Colón 123, Córdoba", day(2024, 1, 15)),
        (2, "Luis", "Martínez", "luis.m@email.com", "Bv. San Juan 456, Córdoba", day(2024, 2, 20)),
        (3, "Sofía", "López", "sofia.lopez@email.com", "Calle 9 de Julio 789, Córdoba", day(2024, 3, 5)),
        (4, "Carlos", "Fernández", "carlos.f@email.com", "Av. Vélez Sársfield 10, Cba.", day(2024, 4, 10)),
        (5, "Valeria", "Ruiz", "valeria.r@email.com", "Los Robles 22, Villa Allende", day(2024, 5, 18)),
        (6, "Mateo", "Díaz", "mateo.diaz@email.com", "Italia 333, Córdoba", day(2024, 6, 1)),
        (7, "Luciana", "Torres", "luciana.t@email.com", "Hipólito Yrigoyen 55, Cba.", day(2024, 7, 22)),
    ]
    usuarios = [(1, "admin", "admin"), (2, "vendedor1", "vendedor"), (3, "vendedor2", "vendedor"),
                (4, "supervisor", "supervisor")]
    ventas = [
        (1, 1, 2, ts(2024, 8, 1, 10, 30), 93500, "entregada"), (2, 2, 2, ts(2024, 8, 5, 14), 15500, "entregada"),
        (3, 3, 3, ts(2024, 8, 10, 9, 15), 326500, "confirmada"), (4, 4, 2, ts(2024, 9, 1, 11), 45000, "entregada"),
        (5, 1, 3, ts(2024, 9, 15, 16, 45), 19300, "confirmada"), (6, 5, 2, ts(2024, 10, 2, 13, 20), 4700, "cancelada"),
        (7, 6, 3, ts(2024, 10, 10, 10), 28300, "pendiente"), (8, 7, 2, ts(2024, 10, 20, 17, 30), 12000, "confirmada"),
    ]
    lines = [
        (1, 1, 1, 75000), (1, 3, 1, 18500), (2, 4, 2, 3500), (2, 6, 3, 2800), (3, 2, 1, 320000), (3, 6, 1, 2800),
        (4, 8, 1, 45000), (5, 9, 1, 8700), (5, 3, 1, 18500), (6, 10, 1, 6500), (6, 7, 2, 1900), (7, 11, 1, 9800),
        (7, 5, 1, 12000), (7, 9, 1, 8700), (8, 5, 1, 12000),
    ]
    return {
        "categorias": frame([(i, n, None) for i, n in categorias], S.CATEGORIAS),
        "productos": frame([(i, c, n, None, D(p), s, True) for i, c, n, p, s in productos], S.PRODUCTOS),
        "clientes": frame([(i, f, l, e, None, a, d) for i, f, l, e, a, d in clientes], S.CLIENTES),
        "usuarios": frame([(i, u, "x" * 64, r, True, None) for i, u, r in usuarios], S.USUARIOS),
        "ventas": frame([(i, c, u, t, D(a), e, None) for i, c, u, t, a, e in ventas], S.VENTAS),
        "detalle_ventas": frame([(n, v, p, q, D(a)) for n, (v, p, q, a) in enumerate(lines, 1)], S.DETALLE_VENTAS),
    }
