"""Batches of carts, single orders and cancellations judged against one snapshot of the tables.

Every cart sees the same stock, as each single call would. Items are folded per cart and
product, then per cart; both steps aggregate before they shuffle. Products join by key
with one row each on their side, so a best-seller is a split join, never a gathered group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwork import schema as S
from tillwork.functions import money
from tillwork.functions.text import money_text, show
from tillwork.operators.sequence import in_stretches, number_rows, running_total, running_totals
from tillwork.operators.skew import own_exchange
from tillwork.session import settle

# --- Fixed values: result codes and their texts --------------------------------------
STOCK_OK = "Stock verificado: disponibilidad suficiente en todos los productos."
EMPTY_CART = "El carrito está vacío. Debe incluir al menos un producto."
UNEXPECTED = "Error inesperado de base de datos. Transacción revertida."
FACADE_NOTE = "Insertado vía sp_insertar_pedido_via_vista (fachada de vista_pedidos_completos)"
FACADE_OK = "Pedido registrado vía vista_pedidos_completos. Venta id="
OK, EMPTY, NO_CLIENT, NO_USER, NO_STOCK, OVERSOLD = 0, 1, 2, 3, 4, 99
MISSING, SHORT = 1, 2


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _client_missing(col: str) -> Column:
    return _text("Cliente id=", show(F.col(col)), " no encontrado.")


def _user_missing(col: str) -> Column:
    return _text("Usuario id=", show(F.col(col)), " no encontrado o inactivo.")


def _product_missing(col: str) -> Column:
    return _text("Producto id=", show(F.col(col)), " no existe o no está activo.")


def _too_few(name: str, asked: str, stock: str) -> Column:
    return _text('Stock insuficiente para "', show(F.col(name)), '": solicitado=', show(F.col(asked)),
                 ", disponible=", show(F.col(stock)), ".")
# --------------------------------------------------------------------------------------


def parse_carts(carts: DataFrame) -> DataFrame:
    """JSON carts as items (cart_id, pos, id_producto, cantidad); an empty cart has none."""
    return (carts.select("cart_id", F.posexplode(F.from_json("items_json", S.CART_ITEMS)).alias("pos", "item"))
            .select("cart_id", "pos", "item.id_producto", "item.cantidad"))


def _judged_items(items: DataFrame, productos: DataFrame) -> DataFrame:
    """Items with price and stock of their product, and the code of their own check."""
    known = productos.select("id_producto", F.col("nombre").alias("_name"), F.col("precio").alias("_price"),
                             F.col("stock").alias("_stock"), F.col("activo").alias("_active"))
    code = (F.when(~F.coalesce("_active", F.lit(False)), MISSING)
            .when(F.col("_stock") < F.col("cantidad"), SHORT).otherwise(OK))
    text = (F.when(~F.coalesce("_active", F.lit(False)), _product_missing("id_producto"))
            .when(F.col("_stock") < F.col("cantidad"), _too_few("_name", "cantidad", "_stock")))
    return (items.join(known, "id_producto", "left")
            .withColumn("_fault", F.when(code > 0, F.struct("pos", code.alias("code"), text.alias("text")))))


def _line_amount(price: str, quantity: str) -> Column:
    """Price times quantity; NULL where that has more digits than an amount may have."""
    return (F.col(price) * F.col(quantity)).try_cast(S.MONEY)


def summarise_items(items: DataFrame, productos: DataFrame) -> DataFrame:
    """Per cart: first failing item, gross, units, number of lines, whether the demand for some
    product over all its lines exceeds the stock, and whether the tables would refuse a line:
    no quantity, one of zero or less, or an amount of too many digits."""
    per_product = _judged_items(items, productos).groupBy("cart_id", "id_producto").agg(
        F.min("_fault").alias("fault"),
        F.sum("cantidad").alias("units"),
        F.sum(_line_amount("_price", "cantidad")).alias("gross"),
        F.max("_stock").alias("stock"), F.count("*").alias("lines"),
        F.bool_or(F.coalesce(F.col("cantidad") <= 0, F.lit(True))
                  | (F.col("_price").isNotNull() & _line_amount("_price", "cantidad").isNull())).alias("refused"))
    return per_product.groupBy("cart_id").agg(
        F.min("fault").alias("_fault"),
        F.sum("gross").try_cast(S.WIDE).alias("monto_bruto"),
        F.sum("units").alias("total_items"), F.sum("lines").alias("_lines"), F.bool_or("refused").alias("_refused"),
        F.coalesce(F.bool_or(F.col("units") > F.col("stock")), F.lit(False)).alias("_oversold"))


def check_stock(carts: DataFrame, productos: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Code and message per cart: 1 missing or inactive, 2 not enough, 0 available."""
    items = parse_carts(carts) if items is None else items
    first = _judged_items(items, productos).groupBy("cart_id").agg(F.min("_fault").alias("_fault"))
    return carts.select("cart_id").join(first, "cart_id", "left").select(
        "cart_id", F.coalesce(F.col("_fault.code"), F.lit(OK)).alias("codigo"),
        F.coalesce(F.col("_fault.text"), F.lit(STOCK_OK)).alias("mensaje"))


def delivered_counts(ventas: DataFrame) -> DataFrame:
    return (ventas.where(F.col("estado") == S.DELIVERED).groupBy("id_cliente")
            .agg(F.count("*").alias("entregas")))


def with_discount(df: DataFrame, delivered: DataFrame, gross: str = "monto_bruto", items: str = "total_items",
                  **tiers) -> DataFrame:
    """Adds ``descuento_pct`` and ``total_neto``."""
    pct = money.discount_pct(F.col(gross), F.col(items), F.col("id_cliente"), F.col("entregas"), **tiers)
    return (df.join(own_exchange(delivered, "id_cliente"), "id_cliente", "left").withColumn("descuento_pct", pct)
            .withColumn("total_neto", money.net_total(F.col(gross), F.col("descuento_pct"))).drop("entregas"))


def discount_scenarios(scenarios: DataFrame, ventas: DataFrame) -> DataFrame:
    """Discount and net total for rows of (escenario, monto, items, id_cliente)."""
    return (with_discount(scenarios, delivered_counts(ventas), "monto", "items")
            .select("escenario", "descuento_pct", "total_neto"))


def price_carts(carts: DataFrame, productos: DataFrame, ventas: DataFrame,
                items: DataFrame | None = None) -> DataFrame:
    """Gross, item count, discount and net per cart at current prices.

    A cart with a line amount, or a total, of too many digits has no gross and no net.
    """
    items = parse_carts(carts) if items is None else items
    lines = items.join(productos.select("id_producto", "precio"), "id_producto", "left")
    sums = lines.groupBy("cart_id").agg(
        F.when(~F.bool_or((F.col("precio") * F.col("cantidad")).isNotNull() & _line_amount("precio", "cantidad").isNull()),
               F.sum(_line_amount("precio", "cantidad")).try_cast(S.WIDE)).alias("monto_bruto"),
        F.sum("cantidad").alias("total_items"))
    return with_discount(carts.select("cart_id", "id_cliente").join(sums, "cart_id"), delivered_counts(ventas))


def validate_carts(carts: DataFrame, clientes: DataFrame, usuarios: DataFrame, productos: DataFrame,
                   ventas: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Code, message and price of every cart; the first failing check decides.

    Rejected carts carry zero total and discount. 99 is the cart whose lines pass the checks but
    which the tables would refuse: together they ask for more of a product than there is,
    a quantity is missing or not positive, or an amount has too many digits.
    """
    items = parse_carts(carts) if items is None else items
    customers = (clientes.select("id_cliente").distinct().join(delivered_counts(ventas), "id_cliente", "left")
                 .select("id_cliente", F.coalesce("entregas", F.lit(0)).alias("entregas")))
    staff = usuarios.where(F.col("activo")).select("id_usuario").distinct().withColumn("_user", F.lit(True))
    seen = (carts.join(summarise_items(items, productos), "cart_id", "left")
            .join(own_exchange(customers, "id_cliente"), "id_cliente", "left")
            .join(own_exchange(staff, "id_usuario"), "id_usuario", "left"))
    checks = [
        (F.col("_lines").isNull(), EMPTY, F.lit(EMPTY_CART)),
        (F.col("entregas").isNull(), NO_CLIENT, _client_missing("id_cliente")),
        (F.col("_user").isNull(), NO_USER, _user_missing("id_usuario")),
        (F.col("_fault").isNotNull(), NO_STOCK, F.col("_fault.text")),
        (F.col("_oversold") | F.col("_refused") | F.col("monto_bruto").try_cast(S.MONEY).isNull(),
         OVERSOLD, F.lit(UNEXPECTED)),
    ]
    code, text = F, F
    for failed, number, message in checks:
        code, text = code.when(failed, number), text.when(failed, message)
    priced = (seen.withColumn("codigo", code.otherwise(OK)).withColumn("mensaje", text.otherwise(F.lit("")))
              .withColumn("_pct", money.discount_pct(F.col("monto_bruto"), F.col("total_items"),
                                                     F.col("id_cliente"), F.col("entregas"))))
    ok = F.col("codigo") == OK
    return priced.select(
        *carts.columns, "codigo", "mensaje",
        F.when(ok, F.col("monto_bruto")).alias("monto_bruto"),
        F.when(ok, F.col("total_items")).alias("total_items"),
        F.when(ok, F.col("_pct")).otherwise(F.lit(0).cast("decimal(5,2)")).alias("descuento_pct"),
        F.when(ok, money.net_total(F.col("monto_bruto"), F.col("_pct")))
        .otherwise(F.lit(0).cast(S.MONEY)).alias("total_neto"))


def to_sales(priced: DataFrame, productos: DataFrame, run_ts: Column, last_id: int | Column = 0,
             items: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted carts as sale headers and lines; ids continue after ``last_id`` in cart order.

    Carts are judged once, here: numbering, headers and lines read what is stored of that.
    """
    priced = settle(priced, "judged-carts")
    items = parse_carts(priced) if items is None else items
    accepted = number_rows(priced.where(F.col("codigo") == OK), "cart_id", "id_venta", last_id)
    headers = accepted.select(
        "cart_id", "id_venta", "id_cliente", "id_usuario", run_ts.alias("fecha_venta"),
        F.col("total_neto").alias("total"), F.lit(S.CONFIRMED).alias("estado"),
        F.col("observacion").alias("observaciones"),
        _text("Venta registrada correctamente. ID=", show(F.col("id_venta")),
              " | Bruto=$", money_text(F.col("monto_bruto")), " | Descuento=", show(F.col("descuento_pct")),
              "% | Total neto=$", money_text(F.col("total_neto"))).alias("mensaje"))
    lines = (items.join(accepted.select("cart_id", "id_venta"), "cart_id")
             .join(productos.select("id_producto", F.col("precio").alias("precio_unitario")), "id_producto")
             .select("id_venta", "id_producto", "cantidad", "precio_unitario"))
    return headers, lines


def apply_stock(productos: DataFrame, lines: DataFrame, sign: int = -1) -> DataFrame:
    """Products with the quantities of ``lines`` taken off (or, with +1, put back)."""
    moved = lines.groupBy("id_producto").agg(F.sum("cantidad").alias("_moved"))
    stock = F.col("stock") + F.lit(sign) * F.coalesce("_moved", F.lit(0))
    return (productos.join(moved, "id_producto", "left").withColumn("stock", stock.cast("bigint"))
            .drop("_moved").select(*productos.columns))


def allocate_stock(items: DataFrame, productos: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Running demand per product in the order of submission, against its stock.

    Conservative: a refused item still counts towards the demand of those after it; ``replay_stock``
    counts those alone that got theirs. ``items`` carries submitted_at, cart_id and pos. A
    best-seller's queue is cut into stretches of equal size, or by ``chunk``.
    """
    demand = running_total(items, ["id_producto"], ["submitted_at", "cart_id", "pos"], chunk,
                           F.col("cantidad").cast("bigint"), "demanda_acumulada")
    stock = productos.where(F.col("activo")).select("id_producto", "stock")
    return (demand.join(stock, "id_producto", "left")
            .withColumn("asignado", F.coalesce(F.col("demanda_acumulada") <= F.col("stock"), F.lit(False))))


def replay_stock(items: DataFrame, productos: DataFrame) -> DataFrame:
    """cart_id, aceptado, ronda: what taking the carts one after another, whole or not at all, would give.

    Decided in rounds over all carts at once. One whose items fit even if every undecided cart before it
    is served is accepted; one that has an item that does not fit after the accepted ones alone is
    refused; both are certain. The earliest undecided cart is always decided, so rounds end, and most
    carts need few of them. A cart with a missing product, or a quantity that is missing or not
    above zero, is refused at once (round 0). The queue is stored in stretches once; a round moves the lines
    of carts that were undecided before the last one: those accepted since come off what is left for the
    lines after them, and are gone with the refused.
    """
    stock = productos.where(F.col("activo")).select("id_producto", F.col("stock").alias("_stock"))
    lines = items.join(stock, "id_producto", "left")
    sound = F.coalesce((F.col("cantidad") > 0) & F.col("_stock").isNotNull(), F.lit(False))
    per = settle(lines.groupBy("cart_id", "id_producto").agg(
        F.min("submitted_at").alias("submitted_at"), F.sum(F.col("cantidad").cast("bigint")).alias("_q"),
        F.min("_stock").cast("bigint").alias("_left"), F.bool_and(sound).alias("_sound")), "queue")
    refused = settle(per.where(~F.col("_sound")).select("cart_id").distinct(), "replay")
    judged = [refused.select("cart_id", F.lit(False).alias("aceptado"), F.lit(0).alias("ronda"))]
    whole = per.where("_sound").drop("_sound").join(refused, "cart_id", "left_anti")
    queue = in_stretches(whole, ["id_producto"], ["submitted_at", "cart_id"])
    rows, left, number = queue.withColumn("_served", F.lit(False)), queue, 0
    while left.limit(1).count():
        number += 1
        served = F.col("_served")
        demand = running_totals(rows, ["id_producto"], ["submitted_at", "cart_id"],
                                {"_all": F.when(served, 0).otherwise(F.col("_q")), "_sure": F.when(served, F.col("_q")).otherwise(0)})
        waiting = settle(demand.where(~served).withColumn("_left", F.col("_left") - F.col("_sure")).withColumn(
            "_fits", F.col("_all") <= F.col("_left")).drop("_served", "_all", "_sure"), "waiting")
        seen = waiting.groupBy("cart_id").agg(F.bool_and("_fits").alias("_fits"),
                                              F.bool_or(F.col("_q") > F.col("_left")).alias("_breaks"))
        now = settle(seen.select("cart_id", F.when(F.col("_fits"), True).when(F.col("_breaks"), False).alias("aceptado")), "replay")
        judged.append(now.where("aceptado IS NOT NULL").withColumn("ronda", F.lit(number)))
        left = now.where("aceptado IS NULL")
        rows = (waiting.drop("_fits").join(now, "cart_id").where("aceptado IS NULL OR aceptado")
                .withColumn("_served", F.coalesce("aceptado", F.lit(False))).drop("aceptado"))
    return reduce(DataFrame.unionByName, judged)


def first_oversold(allocated: DataFrame) -> DataFrame:
    """Per product, the first cart whose demand no longer fits."""
    when = F.struct("submitted_at", "cart_id", "pos", "demanda_acumulada", "stock")
    return (allocated.where(~F.col("asignado")).groupBy("id_producto").agg(F.min(when).alias("w"))
            .select("id_producto", F.col("w.cart_id").alias("cart_id"),
                    F.col("w.submitted_at").alias("submitted_at"),
                    F.col("w.demanda_acumulada").alias("demanda_acumulada"), F.col("w.stock").alias("stock")))


def cancel_requests(ventas: DataFrame, requests: DataFrame, order: str = "orden") -> DataFrame:
    """Code and message per request (id_venta, motivo, orden): 1 unknown, 2 too late, 0 cancelled.

    Requests for one sale are judged in ``order``, which no two of them share: the first cancels
    an open sale, those after it find it cancelled. The first is folded per sale before it is
    joined back, so a sale asked for very often is a split join.
    """
    first = requests.groupBy("id_venta").agg(F.min(order).alias("_first"))
    known = (ventas.select("id_venta", F.col("estado").alias("_state")).withColumn("_known", F.lit(True))
             .join(first, "id_venta"))
    seen = requests.join(own_exchange(known, "id_venta"), "id_venta", "left")
    again = F.col("_state").isin(S.PENDING, S.CONFIRMED) & (F.col(order) > F.col("_first"))
    seen = seen.withColumn("_state", F.when(again, S.CANCELLED).otherwise(F.col("_state")))
    id_text = show(F.col("id_venta"))
    open_state = F.col("_state").isin(S.PENDING, S.CONFIRMED)
    code = F.when(F.col("_known").isNull(), 1).when(~open_state, 2).otherwise(0)
    text = (F.when(F.col("_known").isNull(), _text("Venta id=", id_text, " no encontrada."))
            .when(~open_state, _text("La venta id=", id_text, ' tiene estado "', F.col("_state"),
                                     '" y no puede cancelarse.'))
            .otherwise(_text("Venta id=", id_text, " cancelada correctamente. Stock restaurado.")))
    return seen.select(*requests.columns, code.alias("codigo"), text.alias("mensaje"))


def cancel_sales(ventas: DataFrame, lines: DataFrame, productos: DataFrame, requests: DataFrame,
                 run_ts: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Request results, sales after cancellation, products after their stock came back.

    A sale asked for twice is cancelled once, for the reason of the first request.
    """
    results = cancel_requests(ventas, requests)
    done = results.where(F.col("codigo") == 0).select("id_venta", F.coalesce("motivo", F.lit("sin motivo")).alias("_why"))
    note = _text(F.coalesce("observaciones", F.lit("")), " | CANCELADA: ", F.col("_why"), " (",
                 run_ts.cast("string"), ")")
    after = (ventas.join(done, "id_venta", "left")
             .withColumn("observaciones", F.when(F.col("_why").isNotNull(), note).otherwise(F.col("observaciones")))
             .withColumn("estado", F.when(F.col("_why").isNotNull(), S.CANCELLED).otherwise(F.col("estado")))
             .select(*ventas.columns))
    freed = lines.join(own_exchange(done.select("id_venta"), "id_venta"), "id_venta", "left_semi")
    return results, after, apply_stock(productos, freed, +1)


def validate_single_orders(orders: DataFrame, clientes: DataFrame, usuarios: DataFrame,
                           productos: DataFrame) -> DataFrame:
    """One-product orders: 1 client, 2 user, 3 product, 4 stock, 0 taken. No discount applies.

    99 is the order that the tables would refuse: no quantity, one of zero or less, or a total
    of too many digits.
    """
    customers = clientes.select("id_cliente").distinct().withColumn("_client", F.lit(True))
    staff = usuarios.where(F.col("activo")).select("id_usuario").distinct().withColumn("_user", F.lit(True))
    goods = productos.where(F.col("activo")).select(
        "id_producto", F.col("nombre").alias("_name"), F.col("precio").alias("_price"), F.col("stock").alias("_stock"))
    seen = (orders.join(goods, "id_producto", "left").join(own_exchange(customers, "id_cliente"), "id_cliente", "left")
            .join(own_exchange(staff, "id_usuario"), "id_usuario", "left"))
    checks = [
        (F.col("_client").isNull(), 1, _client_missing("id_cliente")),
        (F.col("_user").isNull(), 2, _user_missing("id_usuario")),
        (F.col("_name").isNull(), 3, _product_missing("id_producto")),
        (F.col("_stock") < F.col("cantidad"), 4, _too_few("_name", "cantidad", "_stock")),
        (F.coalesce(F.col("cantidad") <= 0, F.lit(True)) | _line_amount("_price", "cantidad").isNull(),
         OVERSOLD, F.lit(UNEXPECTED)),
    ]
    code, text = F, F
    for failed, number, message in checks:
        code, text = code.when(failed, number), text.when(failed, message)
    return (seen.withColumn("codigo", code.otherwise(0)).withColumn("mensaje", text)
            .select(*orders.columns, "codigo", "mensaje",
                    F.when(F.col("codigo") == 0, _line_amount("_price", "cantidad"))
                    .otherwise(F.lit(0).cast(S.MONEY)).alias("total")))


def single_orders_to_sales(judged: DataFrame, productos: DataFrame, run_ts: Column, order_id: str = "pedido_id",
                           last_id: int | Column = 0) -> tuple[DataFrame, DataFrame]:
    """Accepted one-product orders as sale headers and lines, with the message each order gets."""
    taken = number_rows(judged.where(F.col("codigo") == 0), order_id, "id_venta", last_id)
    headers = taken.select(
        "id_venta", "id_cliente", "id_usuario", run_ts.alias("fecha_venta"), "total",
        F.lit(S.CONFIRMED).alias("estado"), F.lit(FACADE_NOTE).alias("observaciones"),
        _text(FACADE_OK, show(F.col("id_venta"))).alias("mensaje"))
    lines = (taken.join(productos.select("id_producto", F.col("precio").alias("precio_unitario")), "id_producto")
             .select("id_venta", "id_producto", "cantidad", "precio_unitario"))
    return headers, lines
