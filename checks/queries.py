"""Every operator run over whole test tables, by name.

Outputs are plain: amounts as DOUBLE, counts as BIGINT, calendar parts as INT.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwork import schema as S, settle, shared_folder, tune
from tillwork.functions import money
from tillwork.operators import audit as A, carts as C, changes as G, constraints as K, validation as V, views as Q
from tillwork.plans import imports as I, reports as R, star as D
from tillwork.sources import files, snapshots as N
from tillwork.sources.checksums import BucketSnapshot
from tillwork.sources.testtables import Activity, DirtyFeeds, TestTables
from tillwork.streaming.imports import import_stream, incoming
from tillwork.streaming.prices import STATE_STORE, price_change_stream

RUN_DATE = dt.date(2025, 6, 1)
MARK = dt.datetime(1998, 1, 1)
BANDS = [("930", "ECONOMICO"), ("970", "MEDIO")]  # the test prices lie between 900 and 1000

REGISTRY: dict[str, Callable[[TestTables], DataFrame]] = {}


def query(name: str):
    def add(build):
        REGISTRY[name] = build
        return build
    return add


def plain(df: DataFrame) -> DataFrame:
    def fit(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType)):
            return c.cast("int").alias(f.name)
        return c
    return df.select(*[fit(f) for f in df.schema.fields])


def ntz(value: dt.datetime):
    return F.lit(value).cast("timestamp_ntz")


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


class Star:
    """Dimensions and fact of one set of tables, planned lazily."""

    def __init__(self, t: TestTables):
        self.calendar = D.dim_date_of(t["ventas"])
        self.dim_c = D.dim_customer(t["clientes"], t["ventas"])
        self.dim_p = D.dim_product(t["productos"], t["categorias"], bands=BANDS)
        self.fact = D.fact_sales(t["ventas"], t["detalle_ventas"], self.dim_c, self.dim_p)


_STORED: dict[tuple[str, str], str] = {}


class StoredStar:
    """The star as its load leaves it, once per session and tables; reports read these files."""

    def __init__(self, t: TestTables):
        key = (t.spark.sparkContext.applicationId, t.folder)
        if key not in _STORED:
            folder = shared_folder(t.spark, "star")
            D.run_etl(t, folder, bands=BANDS)
            _STORED[key] = folder
        read = lambda name: t.spark.read.parquet(f"{_STORED[key]}/{name}")
        self.calendar, self.fact = read("DimTiempo"), read("HechoVentas")
        self.dim_c, self.dim_p = read("DimCliente"), read("DimProducto")


# --- sources and sinks ---------------------------------------------------------------

@query("s1_read_products_csv")
def _(t):
    path = shared_folder(t.spark, "productos-csv")
    (DirtyFeeds(t).productos().write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path))
    good, _bad = files.split_corrupt(files.read_products_csv(t.spark, path, row_id="fila"), "Productos")
    return good


@query("s2_read_clients_json")
def _(t):
    path = shared_folder(t.spark, "clientes-json")
    DirtyFeeds(t).clientes().withColumn("fila", F.col("fila").cast("string")).write.json(path)
    good, _bad = files.split_corrupt(files.read_clients_json(t.spark, path, lines=True, row_id="fila"), "Clientes")
    return good


@query("s3_snapshot_full")
def _(t):
    path = shared_folder(t.spark, "ventas-full")
    N.snapshot_full(t["ventas"], path)
    return N.read_snapshot(t.spark, path, t["ventas"].schema)


def _full_log(t):
    old = t["ventas"].where(F.col("fecha_venta") <= ntz(MARK))
    return N.log_snapshot(old, N.FULL, "Ventas", "ventas_FULL", ntz(MARK))


@query("s4_snapshot_diff")
def _(t):
    return N.snapshot_diff(t["ventas"], _full_log(t), "Ventas", "fecha_venta")


@query("s5_restore")
def _(t):
    """The table at the mark with its open sales unpriced, then brought up to date."""
    v = t["ventas"]
    full = v.where(F.col("fecha_venta") <= ntz(MARK)).withColumn(
        "total", F.when(F.col("estado") == S.CONFIRMED, F.lit(0).cast(S.MONEY)).otherwise(F.col("total")))
    diff = v.where((F.col("fecha_venta") > ntz(MARK)) | (F.col("estado") == S.CONFIRMED))
    return N.restore(full, diff, "id_venta")


def _bucketed(t, label, df):
    found = BucketSnapshot(t.spark, shared_folder(t.spark, label), "id_venta", t["ventas"].schema, buckets=16)
    found.write(df)
    return found


def _then_and_now(t):
    """Sales up to the mark with the confirmed ones unpriced, and all sales without the cancelled ones."""
    v = t["ventas"]
    unpriced = F.when(F.col("estado") == S.CONFIRMED, F.lit(0).cast(S.MONEY)).otherwise(F.col("total"))
    return v.where(F.col("fecha_venta") <= ntz(MARK)).withColumn("total", unpriced), v.where(F.col("estado") != S.CANCELLED)


@query("s4_snapshot_changes")
def _(t):
    then, now = _then_and_now(t)
    return _bucketed(t, "ventas-cubos", then).changes_to(now).withColumnRenamed("_borrada", "borrada")


@query("s5_restore_changes")
def _(t):
    """Three differentials over a snapshot: new sales, some unpriced; deletions; prices, and sales since."""
    then, now = _then_and_now(t)
    v, later = t["ventas"], F.col("fecha_venta") > ntz(MARK)
    kept = lambda df: df.withColumn("_borrada", F.lit(False))
    soon = F.col("fecha_venta") <= ntz(MARK + dt.timedelta(days=90))
    blank = v.limit(0)
    gone = kept(blank).unionByName(v.where((F.col("estado") == S.CANCELLED) & (~later | soon)).select(
        "id_venta", F.lit(True).alias("_borrada")), allowMissingColumns=True)
    snapshot = _bucketed(t, "ventas-cubos", then)
    snapshot.apply([kept(v.where(later & soon).withColumn("total", F.lit(0).cast(S.MONEY))), gone,
                    kept(now.where(later | (F.col("estado") == S.CONFIRMED)))])
    return snapshot.rows()


@query("s7_differing_buckets")
def _(t):
    then, now = _then_and_now(t)
    return _bucketed(t, "ventas-antes", then).differing_rows(_bucketed(t, "ventas-ahora", now))


@query("s6_snapshot_log")
def _(t):
    log = _full_log(t)
    diff = N.snapshot_diff(t["ventas"], log, "Ventas", "fecha_venta")
    log = (log.unionByName(N.log_snapshot(t["productos"], N.FULL, "Productos", "productos_FULL", at("1998-01-02")))
           .unionByName(N.log_snapshot(diff, N.DIFFERENTIAL, "Ventas", "ventas_DIFF", at("1999-01-01"))))
    return N.snapshot_report(log)


@query("s7_row_counts")
def _(t):
    return N.row_counts({n: t[n] for n in ("clientes", "categorias", "productos", "usuarios", "ventas",
                                           "detalle_ventas")})


@query("s7_differing_rows")
def _(t):
    changed = t["ventas"].withColumn("estado", F.when(F.col("fecha_venta") > ntz(MARK), S.PENDING)
                                     .otherwise(F.col("estado")))
    return N.differing_rows(t["ventas"], changed)


# --- import validation ---------------------------------------------------------------

def _products(t, policy):
    feeds = DirtyFeeds(t)
    return I.validate_products(feeds.productos(), t["categorias"], feeds.catalogo(), policy)


def _clients(t, policy):
    feeds = DirtyFeeds(t)
    return I.validate_clients(feeds.clientes(), feeds.registrados(), RUN_DATE, policy)


def _verdict(df: DataFrame, *values: str) -> DataFrame:
    kept = [F.when(F.col("estado") != S.ROW_ERROR, F.col(c)).alias(c) for c in values]
    return df.select("fila", "estado", "observacion", F.try_element_at("issues", F.lit(-1))["regla"].alias("regla"),
                     F.size("issues").cast("bigint").alias("problemas"), *kept)


PRODUCT_VALUES = ["id_categoria", "nombre", "precio", "stock", "activo"]
CLIENT_VALUES = ["nombre", "apellido", "email", "telefono", "fecha_registro"]


@query("v16_validate_products_strict")
def _(t):
    return _verdict(_products(t, I.STRICT), *PRODUCT_VALUES)


@query("v16_validate_products_lenient")
def _(t):
    return _verdict(_products(t, I.LENIENT), *PRODUCT_VALUES)


@query("v16_validate_clients_strict")
def _(t):
    return _verdict(_clients(t, I.STRICT), *CLIENT_VALUES)


@query("v16_validate_clients_lenient")
def _(t):
    return _verdict(_clients(t, I.LENIENT), *CLIENT_VALUES)


@query("s8_load_valid")
def _(t):
    return V.load_valid(_products(t, I.STRICT), S.NUEVO_PRODUCTO)


@query("v17_issue_log")
def _(t):
    log = I.import_reports(_products(t, I.STRICT), _clients(t, I.STRICT))["problemas"]
    return log.drop("accion")


@query("v18_status_summary")
def _(t):
    return I.import_reports(_products(t, I.STRICT), _clients(t, I.STRICT))["resumen"]


@query("v18_status_names")
def _(t):
    return I.import_reports(_products(t, I.STRICT), _clients(t, I.STRICT))["registros"]


@query("v19_import_counters")
def _(t):
    return I.import_reports(_products(t, I.LENIENT), _clients(t, I.LENIENT))["contadores"]


@query("v20_error_rate")
def _(t):
    return I.import_reports(_products(t, I.STRICT), _clients(t, I.STRICT))["tasa_error"]


@query("v21_issue_types")
def _(t):
    return I.import_reports(_products(t, I.LENIENT), _clients(t, I.LENIENT))["tipos"]


@query("v22_revalidate")
def _(t):
    """After the unknown category was created, the rejected rows run again."""
    feeds = DirtyFeeds(t)
    more = t["categorias"].select("id_categoria").unionByName(
        t["categorias"].agg(F.lit(99).alias("id_categoria")))
    again = V.revalidate(_products(t, I.STRICT),
                         lambda df: I.validate_products(df, more, feeds.catalogo(), I.STRICT))
    return _verdict(again, *PRODUCT_VALUES)


@query("v23_constraint_audit")
def _(t):
    return K.constraint_audit(t)


def _dirty(t) -> dict[str, DataFrame]:
    """The tables with a fault of every kind; each kind hits rows by a remainder of their keys."""
    def spoil(df, key, again, faults):
        twice = df.where(F.col(key) % again == 0)
        for column, rest, value in faults:
            changed = F.when(F.col(key) % rest[0] == rest[1], F.lit(value).cast(df.schema[column].dataType))
            df, twice = (x.withColumn(column, changed.otherwise(F.col(column))) for x in (df, twice))
        return df.unionByName(twice)

    return {
        "clientes": spoil(t["clientes"], "id_cliente", 10, [("nombre", (9, 1), None)]),
        "categorias": spoil(t["categorias"], "id_categoria", 3, [("nombre", (5, 1), None)]),
        "productos": spoil(t["productos"], "id_producto", 13, [
            ("id_categoria", (17, 2), 1000), ("precio", (19, 3), -1), ("stock", (23, 4), -1), ("nombre", (29, 5), None)]),
        "usuarios": spoil(t["usuarios"], "id_usuario", 3, [("rol", (4, 1), "jefe"), ("activo", (5, 2), None)]),
        "ventas": spoil(t["ventas"], "id_venta", 31, [
            ("id_cliente", (37, 7), -1), ("id_usuario", (41, 8), -1), ("total", (43, 9), -5), ("estado", (47, 10), "perdida"),
            ("fecha_venta", (53, 11), None)]),
        "detalle_ventas": spoil(t["detalle_ventas"].withColumn("_p", F.col("id_producto")), "_p", 10 ** 9, [
            ("id_venta", (11, 1), -1), ("id_producto", (13, 2), -1), ("cantidad", (17, 3), 0), ("precio_unitario", (19, 4), -1),
            ("cantidad", (23, 5), None)]).drop("_p"),
    }


@query("v23_constraint_audit_dirty")
def _(t):
    return K.constraint_audit(_dirty(t))


# --- views and lookups ---------------------------------------------------------------

@query("q1_active_products")
def _(t):
    return Q.active_products(t["productos"], t["categorias"])


@query("q2_customer_contacts")
def _(t):
    return Q.customer_contacts(t["clientes"])


@query("q3_sales_summary")
def _(t):
    return Q.sales_summary(t["ventas"])


@query("q4_sale_detail")
def _(t):
    return Q.sale_detail(t)


@query("q5_sales_by_customer")
def _(t):
    return Q.sales_by_customer(t["clientes"], t["ventas"])


@query("q6_product_ranking")
def _(t):
    return Q.product_ranking(t)


@query("q7_seller_performance")
def _(t):
    return Q.seller_performance(t["usuarios"], t["ventas"])


@query("q8_complete_orders")
def _(t):
    return Q.complete_orders(t)


@query("q9_check_option")
def _(t):
    ok, refused = Q.check_option(t["productos"], F.col("activo"))
    pick = lambda df, v: df.select("id_producto", "nombre", F.lit(v).alias("aceptado"))
    return pick(ok, True).unionByName(pick(refused, False))


@query("q10_with_subtotal")
def _(t):
    return Q.with_subtotal(t["detalle_ventas"])


@query("q11_sale_list")
def _(t):
    return Q.sale_list(t["ventas"], t["clientes"], t["usuarios"])


@query("q12_stock_of_sold")
def _(t):
    return Q.stock_of_sold(t["productos"], t["detalle_ventas"], t["ventas"].where(F.col("fecha_venta") == at("1998-01-01")))


@query("q13_latest")
def _(t):
    return Q.latest(t["ventas"], ["fecha_venta", "id_venta"], 10)


@query("q14_project_for_role")
def _(t):
    return Q.project_for_role(t["usuarios"], "usuarios", "rol_auditor")


# --- pricing, stock and sales --------------------------------------------------------

@query("c1_discount")
def _(t):
    return (C.price_carts(Activity(t).carts(), t["productos"], t["ventas"], Activity(t).items())
            .select("cart_id", "id_cliente", "monto_bruto", "total_items", "descuento_pct"))


@query("c2_net_total")
def _(t):
    pct = ((F.month("fecha_venta") - 1) * 10).cast("decimal(5,2)")
    return t["ventas"].select("id_venta", "total", pct.alias("pct"), money.net_total(F.col("total"), pct).alias("neto"))


@query("c3_discount_scenarios")
def _(t):
    s = t["ventas"].select(F.col("id_venta").alias("escenario"), F.col("total").alias("monto"),
                           F.month("fecha_venta").alias("items"), "id_cliente")
    return C.discount_scenarios(s, t["ventas"])


@query("c4_check_stock")
def _(t):
    return C.check_stock(Activity(t).carts(), t["productos"], Activity(t).items())


@query("c4_check_stock_json")
def _(t):
    return C.check_stock(Activity(t).json_carts(), t["productos"])


@query("c5_price_carts")
def _(t):
    return C.price_carts(Activity(t).carts(), t["productos"], t["ventas"], Activity(t).items())


def _judged(t):
    return C.validate_carts(Activity(t).carts(), t["clientes"], t["usuarios"], t["productos"], t["ventas"],
                            Activity(t).items())


@query("c6_validate_carts")
def _(t):
    return _judged(t).drop("observacion", "submitted_at")


@query("c6_validate_carts_json")
def _(t):
    return C.validate_carts(Activity(t).json_carts(), t["clientes"], t["usuarios"], t["productos"], t["ventas"]).select(
        "cart_id", "codigo", "mensaje", "total_neto")


def _sold(t):
    last = t["ventas"].agg(F.max("id_venta")).scalar()
    return C.to_sales(_judged(t), t["productos"], at("2025-06-01"), last, Activity(t).items())


@query("c7_sale_headers")
def _(t):
    return _sold(t)[0]


@query("c7_sale_lines")
def _(t):
    return _sold(t)[1]


@query("c8_apply_stock")
def _(t):
    sold = t["detalle_ventas"].join(t["ventas"].where(F.col("estado") == S.CONFIRMED), "id_venta", "left_semi")
    return C.apply_stock(t["productos"], sold).select("id_producto", "stock")


@query("c9_allocate_stock")
def _(t):
    got = C.allocate_stock(Activity(t).queued_items(), t["productos"])
    return got.select("cart_id", "pos", "id_producto", "cantidad", "demanda_acumulada", "stock", "asignado")


@query("c9_first_oversold")
def _(t):
    return C.first_oversold(C.allocate_stock(Activity(t).queued_items(), t["productos"]))


@query("c9_replay_stock")
def _(t):
    return C.replay_stock(Activity(t).queued_items(), t["productos"])


def _cancelled(t):
    return C.cancel_sales(t["ventas"], t["detalle_ventas"], t["productos"], Activity(t).cancellations(), at("2025-06-01"))


@query("c10_cancel_requests")
def _(t):
    return _cancelled(t)[0]


@query("c10_sales_after_cancel")
def _(t):
    return _cancelled(t)[1].select("id_venta", "estado", "observaciones")


@query("c10_stock_after_cancel")
def _(t):
    return _cancelled(t)[2].select("id_producto", "stock")


@query("c11_single_orders")
def _(t):
    return C.validate_single_orders(Activity(t).single_orders(), t["clientes"], t["usuarios"], t["productos"])


def _singles_sold(t):
    judged = settle(C.validate_single_orders(Activity(t).single_orders(), t["clientes"], t["usuarios"], t["productos"]), "judged-orders")
    return C.single_orders_to_sales(judged, t["productos"], at("2025-06-01"), last_id=t["ventas"].agg(F.max("id_venta")).scalar())


@query("c11_single_sale_headers")
def _(t):
    return _singles_sold(t)[0]


@query("c11_single_sale_lines")
def _(t):
    return _singles_sold(t)[1]


# --- change tracking and audit -------------------------------------------------------

@query("a1_sale_audit")
def _(t):
    new = G.new_rows(t["ventas"], t["ventas"].where(F.col("fecha_venta") <= ntz(MARK)), "id_venta")
    return G.sale_audit(new, "db_admin", at("2025-06-01"))


@query("a2_price_changes")
def _(t):
    up = F.when(F.col("descripcion") == "MEDIUM", F.lit("1.10")).otherwise(F.lit("1.00")).cast("decimal(3,2)")
    new = t["productos"].withColumn("precio", F.round(F.col("precio") * up, 2).cast(S.PRICE))
    return G.price_changes(t["productos"], new)


def _prices(t):
    return t.raw("events").where(F.col("event_type") == "purchase").select(
        "user_id", "ts", "event_id", F.col("value").cast(S.PRICE).alias("precio"))


@query("a3_price_history")
def _(t):
    return G.price_history(_prices(t), "user_id", ["ts", "event_id"])


@query("a4_audit_deletes")
def _(t):
    return A.audit_deletes(Activity(t).delete_requests(), t["ventas"])


@query("a5_protected_products")
def _(t):
    kept, free = A.protected_products(t["productos"], t["detalle_ventas"])
    pick = lambda df, v: df.select("id_producto", F.lit(v).alias("protegido"))
    return pick(kept, True).unionByName(pick(free, False))


def _feed(t, **kw):
    return A.audit_feed(Activity(t).trail(), until=at("2030-01-01"), **kw)


@query("a6_audit_feed")
def _(t):
    return _feed(t)


@query("a6_audit_feed_filtered")
def _(t):
    return _feed(t, since="2024-01-05", user="USER_1")


@query("a7_audit_summary")
def _(t):
    return A.audit_summary(Activity(t).trail())


@query("a8_delete_report")
def _(t):
    return A.delete_report(A.audit_deletes(Activity(t).delete_requests(), t["ventas"]))


@query("a9_privilege_report")
def _(t):
    return A.privilege_report(Activity(t).grants())


@query("a10_top_threats")
def _(t):
    return A.top_threats(Activity(t).trail()["logins"])


@query("a11_config_report")
def _(t):
    action = F.element_at(F.array(*map(F.lit, ["DELETE", "GRANT_REVOKE", "FAILED_LOGIN"])), (F.col("id_usuario") % 3 + 1).cast("int"))
    config = t["usuarios"].select(
        F.concat(F.lit("audit_"), "username").alias("nombre_audit"), action.alias("accion"), F.lower(action).alias("tabla_destino"), "activo",
        at("2025-06-01").alias("fecha_creacion"), F.col("rol").alias("creado_por"), F.lit(None).cast("string").alias("descripcion"))
    return A.audit_config_report(config)


@query("a11_events_by_destination")
def _(t):
    feed = A.audit_feed(Activity(t).trail(), until=at("2030-01-01"))
    config = t.spark.createDataFrame(
        [("ventas", "DELETE", "audit_delete_ventas", True, None, "db_admin", None),
         ("ventas", "GRANT_REVOKE", "audit_permisos", True, None, "db_admin", None),
         ("ventas", "FAILED_LOGIN", "audit_login_fallidos", False, None, "db_admin", None)], S.AUDIT_CONFIG)
    return (A.categorise(feed, A.audit_config_report(config, active_only=True).withColumnRenamed("nombre_audit", "n"))
            .groupBy("tabla_destino").agg(F.count("*").alias("eventos")))


@query("a12_failure_streaks")
def _(t):
    return A.failure_streaks(Activity(t).logins()).drop("exitoso")


# --- star schema ---------------------------------------------------------------------

@query("d1_dim_date")
def _(t):
    return Star(t).calendar


@query("d1_extend_dim_date")
def _(t):
    """A calendar up to the mark, then extended to all days of the sales."""
    old = D.dim_date_of(t["ventas"].where(F.col("fecha_venta") <= ntz(MARK)))
    return D.extend_dim_date(old, D.dim_date_of(t["ventas"]))


@query("d2_dim_customer")
def _(t):
    return Star(t).dim_c


@query("d3_dim_product")
def _(t):
    return Star(t).dim_p


@query("d4_fact_sales")
def _(t):
    return Star(t).fact


@query("d4_rounding_residual")
def _(t):
    return D.rounding_residual(StoredStar(t).fact)


@query("d5_run_etl")
def _(t):
    return D.run_etl(t, shared_folder(t.spark, "dw"), bands=BANDS).drop("cargada")


# --- reports -------------------------------------------------------------------------

@query("r1_monthly_sales")
def _(t):
    s = StoredStar(t)
    return R.monthly_sales(s.fact, s.calendar)


@query("r2_top_products")
def _(t):
    s = StoredStar(t)
    return R.top_products(s.fact, s.dim_p)


@query("r2_product_sales")
def _(t):
    s = StoredStar(t)
    return R.product_sales(s.fact, s.dim_p)


@query("r3_category_rollup")
def _(t):
    s = StoredStar(t)
    return R.category_rollup(s.fact, s.dim_p)


@query("r4_customer_ranking")
def _(t):
    s = StoredStar(t)
    return R.customer_ranking(s.fact, s.dim_c)


@query("r5_quarterly_change")
def _(t):
    s = StoredStar(t)
    return R.quarterly_change(s.fact, s.calendar)


@query("r6_month_category_oltp")
def _(t):
    return R.month_category_oltp(t)


@query("r7_month_category_dw")
def _(t):
    s = StoredStar(t)
    return R.month_category_dw(s.fact, s.calendar, s.dim_p)


@query("r8_reconcile")
def _(t):
    s = StoredStar(t)
    return R.reconcile(R.month_category_oltp(t), R.month_category_dw(s.fact, s.calendar, s.dim_p),
                       ["periodo", "categoria"])


@query("r9_concentration")
def _(t):
    s = StoredStar(t)
    return R.concentration(R.product_sales(s.fact, s.dim_p))


@query("r10_extremes")
def _(t):
    s = StoredStar(t)
    return R.extremes(R.monthly_sales(s.fact, s.calendar), "periodo", "monto_neto")


@query("r11_segment_check")
def _(t):
    s = StoredStar(t)
    return R.segment_check(R.customer_ranking(s.fact, s.dim_c), top=2000)


# --- streaming -----------------------------------------------------------------------

def _imported(t) -> str:
    """The import stream run over five files that arrive one after another, each a trigger of its own;
    rows of a file in their order, but those of one size in a file whose records have a field too many."""
    feeds, folder = DirtyFeeds(t), shared_folder(t.spark, "import")
    rows = feeds.productos()
    part = F.pmod(F.call_function("div", F.col("fila"), F.lit(7)), F.lit(4))
    odd = t.raw("part").where(F.col("p_size") == 15).select(F.col("p_partkey").alias("fila"))
    whole, long = rows.join(odd, "fila", "left_anti"), rows.join(odd, "fila", "left_semi").withColumn("sobra", F.lit("x"))

    def put(df):
        (df.coalesce(1).sortWithinPartitions("fila").drop("fila").write.mode("append").option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(f"{folder}/in"))

    for number in range(4):
        put(whole.where(part == number))
        if number == 1:
            put(long)
    stream = incoming(t.spark, f"{folder}/in", S.STAGING_PRODUCTOS, files_per_trigger=1)
    check = lambda batch, existing: I.validate_products(batch, t["categorias"], existing, I.LENIENT)
    writer = import_stream(stream, check, feeds.catalogo(), "nombre", S.NUEVO_PRODUCTO, f"{folder}/out", f"{folder}/state")
    writer.start().awaitTermination()
    return f"{folder}/out"


@query("t1_import_stream")
def _(t):
    return t.spark.read.parquet(f"{_imported(t)}/accepted").drop("batch")


@query("t1_rejected_rows")
def _(t):
    why = F.element_at("issues", -1)
    return t.spark.read.parquet(f"{_imported(t)}/rejected").select(
        "nombre", F.col("crudo.descripcion").alias("descripcion"), F.col("crudo.precio").alias("precio"),
        why["regla"].alias("regla"), why["valor"].alias("valor"))


@query("t2_price_stream")
def _(t):
    """Purchases in four parts by time; the query is run again from its checkpoint after each."""
    folder = shared_folder(t.spark, "prices")
    for key, value in STATE_STORE.items():
        t.spark.conf.set(key, value)
    bought = t.raw("events").where(F.col("event_type") == "purchase").select(
        "user_id", "ts", "event_id", F.col("value").cast(S.PRICE).alias("precio"))
    first, last = (bought.agg(of(F.unix_seconds(F.col("ts").cast("timestamp")))).scalar() for of in (F.min, F.max))
    part = F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - first) * 4 / (last - first + 1))
    for number in range(4):
        bought.where(part == number).write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(bought.schema).parquet(f"{folder}/in")
        price_change_stream(stream, "user_id", "ts", "event_id", "precio", folder, f"{folder}/state").start().awaitTermination()
    return t.spark.read.parquet(f"{folder}/changes")


def bound(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(REGISTRY[name](TestTables(tune(spark), folder)))
    run.__name__ = name
    return run
