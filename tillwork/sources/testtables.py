"""The given test tables seen as the sales model.

Sales are orders, sale lines are line items, products are parts, categories are brands
and sellers are suppliers; an order belongs to the seller of its priority desk. Each
mapping is a projection of whole tables, so pruning and pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork import schema as S
from tillwork.operators import audit

# Order status to sale state.
STATES = {"F": S.DELIVERED, "O": S.CONFIRMED, "P": S.CANCELLED}
# Columns of the files. Stating them saves a job per table that reads footers.
FILES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


class TestTables(dict):
    """Loads a mapped table on first use, so a query lists only the files it needs."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(FILES[name]).parquet(f"{self.folder}/{name}.parquet")

    def __missing__(self, name: str) -> DataFrame:
        self[name] = getattr(self, f"_{name}")()
        return self[name]

    def _categorias(self) -> DataFrame:
        return self.raw("part").select(_brand().alias("id_categoria"), F.col("p_brand").alias("nombre")).distinct()

    def _productos(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id_producto"), _brand().alias("id_categoria"),
            F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("nombre"),
            F.col("p_type").alias("descripcion"), F.col("p_retailprice").cast(S.PRICE).alias("precio"),
            (F.col("p_size") * 10).alias("stock"), (F.col("p_type") != "PROMO").alias("activo"))

    def _clientes(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self.raw("customer").join(nation, "c_nationkey", "left").select(
            F.col("c_custkey").alias("id_cliente"),
            F.substring_index("c_name", "#", 1).alias("nombre"), F.substring_index("c_name", "#", -1).alias("apellido"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.com")).alias("email"),
            F.lit(None).cast("string").alias("telefono"),
            F.concat_ws(", ", "c_mktsegment", "n_name").alias("direccion"),
            F.date_add(F.lit("1994-01-01").cast("date"), F.col("c_nationkey") * 30).alias("fecha_registro"))

    def _usuarios(self) -> DataFrame:
        rol = F.when(F.col("s_nationkey") == 0, "admin").when(F.col("s_nationkey") == 1, "supervisor")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id_usuario"), F.col("s_name").alias("username"),
            F.sha2("s_name", 256).alias("password_hash"), rol.otherwise("vendedor").alias("rol"),
            (F.col("s_acctbal") >= 1000).alias("activo"), F.lit(None).cast("timestamp_ntz").alias("ultimo_login"))

    def _ventas(self) -> DataFrame:
        state = F
        for code, name in STATES.items():
            state = state.when(F.col("o_orderstatus") == code, name)
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id_venta"), F.col("o_custkey").alias("id_cliente"),
            _desk().alias("id_usuario"), F.col("o_orderdate").alias("fecha_venta"),
            F.col("o_totalprice").cast(S.MONEY).alias("total"), state.alias("estado"),
            F.lit(None).cast("string").alias("observaciones"))

    def _detalle_ventas(self) -> DataFrame:
        qty = F.col("l_quantity").cast("int")
        # whole cents per unit, half up, before the value becomes a decimal
        amount = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
        unit = F.call_function("div", amount * 2 + qty, qty * 2)
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("id_venta"), F.col("l_partkey").alias("id_producto"), qty.alias("cantidad"),
            (unit.cast("decimal(10,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(S.PRICE).alias("precio_unitario"))


def _brand() -> Column:
    return F.substring_index("p_brand", "#", -1).cast("int")


def _desk() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("bigint")


def _buyer() -> Column:
    """The order's customer; one order in thirteen names a customer nobody knows."""
    return F.col("o_custkey") + F.when(F.col("o_orderkey") % 13 == 0, 10_000_000).otherwise(0)


class DirtyFeeds:
    """Import feeds made from whole tables: text columns, with faults that depend on a
    column of the row, so that every rule meets cases of its own."""

    def __init__(self, t: TestTables):
        self.t = t

    @staticmethod
    def _part_name() -> Column:
        block = F.floor(F.col("p_partkey") / 200).cast("bigint").cast("string")
        return F.concat_ws(" ", "p_name", "p_brand", block)

    def productos(self) -> DataFrame:
        price = F.col("p_retailprice").cast(S.PRICE).cast("string")
        size = F.col("p_size")
        return self.t.raw("part").select(
            F.col("p_partkey").alias("fila"),
            F.when(size == 2, "99").when(size == 3, "x1").when(size != 1, F.substring_index("p_brand", "#", -1))
            .alias("id_categoria"),
            F.when(size == 4, "  ").otherwise(self._part_name()).alias("nombre"),
            F.col("p_type").alias("descripcion"),
            F.when(size == 5, "PRECIO_INVALIDO").when(size == 6, F.concat(F.lit("-"), price))
            .when(size == 7, F.replace(price, F.lit("."), F.lit(","))).when(size != 8, price).alias("precio"),
            F.when(size == 9, "n/a").when(size == 10, "-5").when(size != 11, (size * 10).cast("string")).alias("stock"),
            F.when(size == 12, "si").when(size == 14, "FALSE").when(size != 13, "1").alias("activo"))

    def catalogo(self) -> DataFrame:
        """Names already on sale: those of the promotional parts, in capitals."""
        return self.t.raw("part").where(F.col("p_type") == "PROMO").select(F.upper(self._part_name()).alias("nombre"))

    @staticmethod
    def _mail() -> Column:
        return F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.com"))

    def clientes(self) -> DataFrame:
        nation = F.col("c_nationkey")
        shared = F.concat(F.lower("c_mktsegment"), F.lit("."), F.floor(F.col("c_custkey") / 50).cast("bigint").cast("string"),
                          F.lit("@dup.com"))
        given = F.date_add(F.lit("1994-01-01").cast("date"), nation * 30).cast("string")
        return self.t.raw("customer").select(
            F.col("c_custkey").alias("fila"),
            F.when(nation == 0, "").otherwise(F.substring_index("c_name", "#", 1)).alias("nombre"),
            F.when(nation != 1, F.substring_index("c_name", "#", -1)).alias("apellido"),
            F.when(nation == 2, "sin-arroba").when(nation == 4, shared).when(nation != 3, self._mail()).alias("email"),
            F.when(nation == 5, " ").otherwise(F.col("c_mktsegment")).alias("telefono"),
            F.col("c_mktsegment").alias("direccion"),
            F.when(nation == 6, "2025-30-99").when(nation == 7, "15/03/2024").when(nation == 8, "12/25/2024")
            .when(nation == 9, "20240315").when(nation == 10, "2999-01-01").when(nation == 11, "").otherwise(given)
            .alias("fecha_registro"))

    def registrados(self) -> DataFrame:
        """Addresses already registered: those of customers in debt, in capitals."""
        return self.t.raw("customer").where("c_acctbal < 0").select(F.upper(self._mail()).alias("email"))


class Activity:
    """Carts, requests and audit events read from orders, line items and the event log."""

    def __init__(self, t: TestTables):
        self.t = t

    def carts(self) -> DataFrame:
        """Every order as a cart; its lines are the items."""
        return self.t.raw("orders").select(
            F.col("o_orderkey").alias("cart_id"), _buyer().alias("id_cliente"), _desk().alias("id_usuario"),
            F.col("o_orderpriority").alias("observacion"), F.col("o_orderdate").alias("submitted_at"))

    @staticmethod
    def _position() -> Column:
        # line numbers repeat within an order; the rest of the row settles the order
        return (F.col("l_linenumber").cast("bigint") * 10_000_000_000 + F.col("l_partkey") * 100
                + F.col("l_quantity").cast("int"))

    def items(self) -> DataFrame:
        """Lines as items; some parts come without a quantity, with none, a negative or a huge one."""
        part = F.col("l_partkey")
        qty = (F.when(part % 97 == 0, 0).when(part % 89 == 0, -3).when(part % 101 == 0, 2_000_000_000)
               .when(part % 83 != 0, F.col("l_quantity").cast("int")))
        return self.t.raw("lineitem").select(F.col("l_orderkey").alias("cart_id"), self._position().alias("pos"),
                                             part.alias("id_producto"), qty.alias("cantidad"))

    def queued_items(self) -> DataFrame:
        when = self.carts().select("cart_id", "submitted_at")
        return self.items().join(when, "cart_id")

    def json_carts(self) -> DataFrame:
        """Every order as a JSON cart of its lines; low-priority ones are empty."""
        lines = self.items().groupBy("cart_id").agg(F.array_sort(F.collect_list(
            F.struct("pos", "id_producto", "cantidad"))).alias("_l"))
        text = F.to_json(F.transform("_l", lambda x: F.struct(x["id_producto"].alias("id_producto"),
                                                              x["cantidad"].alias("cantidad"))))
        return self.t.raw("orders").join(lines, F.col("o_orderkey") == F.col("cart_id"), "left").select(
            F.col("o_orderkey").alias("cart_id"), _buyer().alias("id_cliente"), _desk().alias("id_usuario"),
            F.when((F.col("o_orderpriority") == "5-LOW") | F.col("_l").isNull(), "[]").otherwise(text).alias("items_json"),
            F.col("o_orderpriority").alias("observacion"), F.col("o_orderdate").alias("submitted_at"))

    def single_orders(self) -> DataFrame:
        return self.t.raw("orders").select(
            F.col("o_orderkey").alias("pedido_id"), _buyer().alias("id_cliente"), _desk().alias("id_usuario"),
            F.col("o_custkey").alias("id_producto"), (F.dayofmonth("o_orderdate") - 3).alias("cantidad"))

    def cancellations(self) -> DataFrame:
        """Every returned line asks for the cancellation of its order; seventh lines name one that is unknown."""
        unknown = F.when(F.col("l_linenumber") == 7, 1_000_000_000).otherwise(0)
        reason = F.concat(F.lit("dev "), F.col("l_linenumber").cast("string"), F.lit("/"), F.col("l_partkey").cast("string"))
        return self.t.raw("lineitem").where(F.col("l_returnflag") == "R").select(
            (F.col("l_orderkey") + unknown).alias("id_venta"), reason.alias("motivo"), self._position().alias("orden"))

    def logins(self) -> DataFrame:
        """Errors are failed logins, everything else is a successful one."""
        return self.t.raw("events").select(
            F.col("event_id").alias("id_evento"), _user().alias("usuario"), (F.col("event_type") != "error").alias("exitoso"),
            F.col("ts").alias("fecha_evento"))

    def delete_requests(self) -> DataFrame:
        who = F.when(F.col("event_type") == "signup", "db_admin@localhost").otherwise(_user())
        return self.t.raw("events").select(
            F.col("event_id").alias("id_evento"), F.col("event_id").alias("id_venta"), who.alias("usuario_bd"),
            F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("host_origen"), F.col("ts").alias("fecha_evento"))

    def grants(self) -> DataFrame:
        rows = self.t.raw("events").where(F.col("event_type") == "click").select(
            F.col("event_id").alias("id_evento"), F.when(F.col("value") >= 10, "GRANT").otherwise("REVOKE").alias("accion"),
            F.lit("SELECT").alias("privilegio"), F.lit("ventas").alias("objeto"), _user().alias("beneficiario"),
            F.lit("db_admin").alias("otorgado_por"), (F.col("value") >= 20).alias("with_grant_option"),
            F.when(F.col("value") < 1, "ERROR").otherwise("EXITOSO").alias("resultado"),
            F.lit(None).cast("string").alias("detalle_error"), F.col("ts").alias("fecha_evento"))
        statement = audit.grant_statement(*[F.col(c) for c in ("accion", "privilegio", "objeto", "beneficiario",
                                                         "with_grant_option")])
        return rows.withColumn("sentencia_sql", statement)

    def trail(self) -> dict[str, DataFrame]:
        done, refused = audit.split_deletes(self.delete_requests(), self.t["ventas"])
        streaks = audit.failure_streaks(self.logins())
        failed = streaks.select("id_evento", F.col("usuario").alias("usuario_intento"),
                                F.concat(F.lit("10.0.0."), F.substring_index("usuario", "_", -1)).alias("host_origen"),
                                "intentos_cuenta", "bloqueado", F.lit(None).cast("string").alias("descripcion"),
                                "fecha_evento")
        return {"deletes": done, "blocked": refused, "grants": self.grants(), "logins": failed}


def _user() -> Column:
    return F.concat(F.lit("user_"), F.col("user_id").cast("string"))
