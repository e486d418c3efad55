import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwork import schema as S
from tillwork.functions import money
from tillwork.operators import carts as C

NOW = dt.datetime(2025, 1, 1, 12)


def basket(*pairs):
    return "[" + ",".join(f'{{"id_producto":{p},"cantidad":{q}}}' for p, q in pairs) + "]"


@pytest.fixture(scope="module")
def carts(spark):
    data = [
        (1, 3, 2, basket((3, 1), (9, 2)), "ok"), (2, 4, 2, basket((2, 999)), "stock"),
        (3, 9999, 2, basket((1, 1)), "cliente"), (4, 1, 2, "[]", "vacio"), (5, 1, 2, None, "nulo"),
        (6, 1, 77, basket((1, 1)), "usuario"), (7, 1, 2, basket((1, 1), (99, 1)), "falta"),
        (8, 1, 2, basket((1, 30), (1, 30)), "repetido"), (9, 1, 2, basket((4, 2), (4, 3)), "repetido ok"),
        (10, None, 2, basket((1, 1)), "sin cliente"), (11, 1, 2, basket((99, 1), (2, 999)), "dos fallas"),
    ]
    return spark.createDataFrame([(*d, NOW + dt.timedelta(minutes=d[0])) for d in data], S.CARTS)


def test_check_stock(carts, seed):
    got = {r.cart_id: (r.codigo, r.mensaje) for r in C.check_stock(carts, seed["productos"]).collect()}
    assert got[1] == (0, C.STOCK_OK)
    assert got[2] == (2, 'Stock insuficiente para "Laptop ProBook": solicitado=999, disponible=20.')
    assert got[7] == (1, "Producto id=99 no existe o no está activo.")
    assert got[11][0] == 1 and got[8][0] == 0 and got[4][0] == 0


def test_inactive_product(spark, carts, seed):
    off = seed["productos"].withColumn("activo", F.col("id_producto") != 3)
    assert C.check_stock(carts.where("cart_id = 1"), off).first().codigo == 1


def test_price(carts, seed):
    got = {r[0]: r[1:] for r in rows(C.price_carts(carts, seed["productos"], seed["ventas"]), "cart_id",
                                     "monto_bruto", "total_items", "descuento_pct", "total_neto")}
    assert got[1] == (35900, 3, 0, 35900)
    assert got[9] == (17500, 5, 3, 16975)


def test_validate(carts, seed):
    v = C.validate_carts(carts, seed["clientes"], seed["usuarios"], seed["productos"], seed["ventas"])
    got = {r.cart_id: r for r in v.collect()}
    assert {k: r.codigo for k, r in got.items()} == {
        1: 0, 2: 4, 3: 2, 4: 1, 5: 1, 6: 3, 7: 4, 8: 99, 9: 0, 10: 2, 11: 4}
    assert got[3].mensaje == "Cliente id=9999 no encontrado."
    assert got[6].mensaje == "Usuario id=77 no encontrado o inactivo."
    assert got[2].total_neto == 0 and got[2].monto_bruto is None
    assert got[1].total_neto == Decimal("35900.00")


def test_to_sales_and_stock(carts, seed):
    v = C.validate_carts(carts, seed["clientes"], seed["usuarios"], seed["productos"], seed["ventas"])
    headers, lines = C.to_sales(v, seed["productos"], F.lit(NOW).cast("timestamp_ntz"), last_id=8)
    got = rows(headers.orderBy("id_venta"), "id_venta", "cart_id", "total", "estado")
    assert got == [(9, 1, 35900, "confirmada"), (10, 9, 16975, "confirmada")]
    assert headers.where("id_venta = 10").first().mensaje == (
        "Venta registrada correctamente. ID=10 | Bruto=$17,500.00 | Descuento=3.00% | Total neto=$16,975.00")
    assert sorted(rows(lines)) == [(9, 3, 1, 18500), (9, 9, 2, 8700), (10, 4, 2, 3500), (10, 4, 3, 3500)]
    stock = dict(rows(C.apply_stock(seed["productos"], lines), "id_producto", "stock"))
    assert (stock[3], stock[9], stock[4], stock[1]) == (79, 88, 195, 50)


def test_scenarios(spark, seed):
    s = spark.createDataFrame([("a", Decimal(30000), 2, 1), ("b", Decimal(50000), 2, 1), ("c", Decimal(100000), 6, 2),
                               ("d", Decimal(200000), 8, 1)],
                              "escenario string, monto decimal(12,2), items int, id_cliente int")
    got = rows(C.discount_scenarios(s, seed["ventas"]).orderBy("escenario"))
    assert got == [("a", 0, 30000), ("b", 5, 47500), ("c", 13, 87000), ("d", 18, 164000)]


def test_loyalty_and_ceiling(spark):
    df = spark.createDataFrame([(1, 6), (1, 5), (None, 9)], "c int, n int").select(
        money.discount_pct(F.lit(200000).cast(S.MONEY), F.lit(5), F.col("c"), F.col("n")).alias("p"),
        money.discount_pct(F.lit(200000).cast(S.MONEY), F.lit(5), F.col("c"), F.col("n"), ceiling="20").alias("q"))
    assert rows(df) == [(23, 20), (18, 18), (18, 18)]


def test_net_total(spark):
    df = spark.sql("select cast(g as decimal(12,2)) g, cast(p as decimal(5,2)) p from values "
                   "(200000, 18), (-1, 5), (100, -3), (100, 150), (0.05, 50) t(g, p)")
    want = [164000, 0, 100, 0, 0.03]
    assert [r[0] for r in rows(df.select(money.net_total(F.col("g"), F.col("p"))))] == want
    spark.createDataFrame([], S.VENTAS).createOrReplaceTempView("v")
    money.register_sql_functions(spark, "v")
    assert [r[0] for r in rows(df.selectExpr("fn_calcular_total_venta(g, p)"))] == want


def test_share_rounds_like_exact_arithmetic(spark):
    from fractions import Fraction
    import random
    rnd = random.Random(5)
    data = [(Decimal(rnd.randint(-10**e, 10**e)) / 100, Decimal(rnd.randint(-10**f, 10**f)) / 100,
             Decimal(rnd.randint(1, 10**g)) / 100) for e in (4, 7, 12) for f in (4, 7, 12) for g in (2, 4, 8, 13, 17)
            for _ in range(25)] + [(Decimal("1"), Decimal("0.05"), Decimal("10")), (Decimal("-1"), Decimal("0.05"), Decimal("10")),
                                   (Decimal("1"), Decimal("1"), Decimal("0"))]
    # near halves of a cent, with a whole above two hundred thousand million
    data += [(Decimal("9576782480.33"), Decimal("4905015075.89"), Decimal("213991339334.03"))]
    limit = 10 ** 15
    data = [d for d in data if d[2] == 0 or (abs(d[0] * d[1] / d[2]) < limit and abs(d[0] * (d[2] - d[1]) / d[2]) < limit
                                             and abs((d[2] - d[1]) * 100 / d[2]) < limit)]
    df = spark.createDataFrame(data, "a decimal(12,2), p decimal(12,2), w decimal(18,2)")
    got = money.apportion(df, "a", "p", "w", "pct", "y", "x").collect()

    def half_away(q):
        n = int(abs(q) * 100 + Fraction(1, 2))
        return Decimal(n if q >= 0 else -n) / 100
    assert len(got) > 500
    for r in got:
        if r.w == 0:
            assert r.x is None and r.y is None
        else:
            q = Fraction(r.a) * Fraction(r.p) / Fraction(r.w)
            assert r.x == half_away(q) and r.y == half_away(Fraction(r.a) - q)
            assert r.pct == half_away(100 - Fraction(r.p) * 100 / Fraction(r.w))


def test_allocation(spark, seed):
    items = spark.createDataFrame(
        [(i, 0, 8, q, NOW + dt.timedelta(hours=h)) for i, (q, h) in enumerate([(10, 0), (10, 0), (10, 1), (4, 30)], 1)],
        "cart_id int, pos int, id_producto int, cantidad int, submitted_at timestamp_ntz")
    got = C.allocate_stock(items, seed["productos"])
    assert rows(got.orderBy("cart_id"), "demanda_acumulada", "asignado") == [
        (10, True), (20, True), (30, False), (34, False)]
    assert rows(C.first_oversold(got), "id_producto", "cart_id", "demanda_acumulada") == [(8, 3, 30)]


def test_replay_is_what_one_after_another_gives(spark, seed):
    import random
    rnd, lines = random.Random(4), []
    for cart in range(1, 120):
        for pos in range(rnd.randint(1, 4)):
            lines.append((cart, pos, rnd.choice([1, 2, 8, 11, 99 if cart % 40 == 0 else 8]),
                          rnd.choice([1, 2, 5, 9, 30, None if cart % 30 == 0 else 3, 0 if cart % 35 == 0 else 4]),
                          NOW + dt.timedelta(hours=rnd.randint(0, 9))))
    stock = {r.id_producto: r.stock for r in seed["productos"].collect()}
    want = {}
    first = {c: min(t for k, _, _, _, t in lines if k == c) for c, *_ in lines}
    lines = [(c, p, i, q, first[c]) for c, p, i, q, _ in lines]
    for cart in sorted(first, key=lambda c: (first[c], c)):
        own = [(i, q) for c, _, i, q, _ in lines if c == cart]
        need = {}
        for i, q in own:
            need[i] = need.get(i, 0) + (q or 0)
        want[cart] = all(q is not None and q > 0 and i in stock for i, q in own) and all(n <= stock[i] for i, n in need.items())
        if want[cart]:
            for i, n in need.items():
                stock[i] -= n
    df = spark.createDataFrame(lines, "cart_id int, pos int, id_producto int, cantidad int, submitted_at timestamp_ntz")
    got = C.replay_stock(df, seed["productos"]).collect()
    assert {r.cart_id: r.aceptado for r in got} == want and len(got) == len(want)
    assert 1 < max(r.ronda for r in got) < 20 and {r.ronda == 0 for r in got} == {True, False}


def test_a_replay_round_moves_undecided_lines_only(spark, seed, monkeypatch):
    moved, keep = [], C.settle
    monkeypatch.setattr(C, "settle", lambda df, label: moved.append((label, kept := keep(df, label))) or kept)
    # product 1 is sold out by the third cart; all others but the last two wait for nobody
    lines = [(c, 0, 1 if c < 40 else 2, 10, NOW + dt.timedelta(hours=c)) for c in range(1, 60)]
    df = spark.createDataFrame(lines, "cart_id int, pos int, id_producto int, cantidad int, submitted_at timestamp_ntz")
    goods = seed["productos"].withColumn("stock", F.lit(25))
    got = {r.cart_id: r.aceptado for r in C.replay_stock(df, goods).collect()}
    assert got == {c: c in (1, 2, 40, 41) for c in range(1, 60)}
    waiting = [kept.count() for label, kept in moved if label == "waiting"]
    # the first round decides the four that fit, the second refuses all others
    assert waiting == [59, 55]


def test_cancel(spark, seed):
    req = spark.createDataFrame([(7, "por teléfono"), (1, "tarde"), (99, None), (6, "ya"), (8, None), (8, "a"), (8, "b"),
                                 (7, "antes, pero después")], "id_venta int, motivo string")
    req = req.coalesce(1).withColumn("orden", F.monotonically_increasing_id())
    results, after, stock = C.cancel_sales(seed["ventas"], seed["detalle_ventas"], seed["productos"], req,
                                           F.lit(NOW).cast("timestamp_ntz"))
    assert sorted(rows(results, "id_venta", "codigo")) == [(1, 2), (6, 2), (7, 0), (7, 2), (8, 0), (8, 2), (8, 2), (99, 1)]
    assert results.where("id_venta = 1").first().mensaje == (
        'La venta id=1 tiene estado "entregada" y no puede cancelarse.')
    sale = after.where("id_venta = 7").first()
    assert (sale.estado, sale.observaciones) == ("cancelada", " | CANCELADA: por teléfono (2025-01-01 12:00:00)")
    assert after.where("id_venta = 1").first().observaciones is None and after.count() == 8
    got = dict(rows(stock, "id_producto", "stock"))
    assert (got[11], got[5], got[9], got[1]) == (46, 62, 91, 50)


def test_single_orders(spark, seed):
    o = spark.createDataFrame([(1, 2, 2, 3, 1), (2, 99, 2, 3, 1), (3, 2, 99, 3, 1), (4, 2, 2, 99, 1), (5, 2, 2, 3, 81),
                               (6, 2, 2, 3, 0), (7, 2, 2, 3, -4), (8, 2, 2, 3, None)],
                              "pedido_id int, id_cliente int, id_usuario int, id_producto int, cantidad int")
    judged = C.validate_single_orders(o, seed["clientes"], seed["usuarios"], seed["productos"])
    assert sorted(rows(judged, "pedido_id", "codigo", "total")) == [(1, 0, 18500), (2, 1, 0), (3, 2, 0), (4, 3, 0), (5, 4, 0),
                                                                  (6, 99, 0), (7, 99, 0), (8, 99, 0)]
    headers, lines = C.single_orders_to_sales(judged, seed["productos"], F.lit(NOW).cast("timestamp_ntz"), last_id=8)
    assert rows(headers, "id_venta", "total") == [(9, 18500)] and rows(lines) == [(9, 3, 1, 18500)]
    assert headers.first().mensaje == "Pedido registrado vía vista_pedidos_completos. Venta id=9"


def test_lines_the_tables_refuse(spark, seed):
    """Zero, negative or no quantity, and amounts of too many digits: that cart alone gets 99."""
    quantities = [1, 0, -3, None, 2_000_000_000]
    carts = spark.createDataFrame([(i, 2, 2, None, NOW) for i in range(6)],
                                  "cart_id int, id_cliente int, id_usuario int, observacion string, submitted_at timestamp_ntz")
    items = spark.createDataFrame([(i, 0, 3, q) for i, q in enumerate(quantities)],
                                  "cart_id int, pos int, id_producto int, cantidad int")
    plenty = seed["productos"].withColumn("stock", F.lit(2_100_000_000))
    judged = C.validate_carts(carts, seed["clientes"], seed["usuarios"], plenty, seed["ventas"], items)
    assert sorted(rows(judged, "cart_id", "codigo")) == [(0, 0), (1, 99), (2, 99), (3, 99), (4, 99), (5, 1)]
    priced = dict(rows(C.price_carts(carts, plenty, seed["ventas"], items), "cart_id", "monto_bruto"))
    assert priced[0] == 18500 and priced[4] is None
