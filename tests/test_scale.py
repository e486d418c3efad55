"""What has to hold for the plans at any size: no Python workers, no cartesian products, no
row-wise window over a whole table, filters and columns that reach the files, skew that splits."""
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import REGISTRY, Star
from tillwork.operators import carts as C, views as Q
from tillwork.plans import imports as I, star as D
from tillwork.sources.testtables import Activity, DirtyFeeds

LAZY = [n for n in REGISTRY if n[0] in "acdqrv" and n != "d5_run_etl"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_plan_is_relational(small, name):
    plan = plan_of(REGISTRY[name](small))
    assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct", plan)


def test_only_needed_columns_and_rows_are_read(small):
    plan = plan_of(Q.sales_by_customer(small["clientes"], small["ventas"]))
    orders = next(l for l in plan.splitlines() if "o_orderkey" in l and "FileScan" in l)
    assert "o_orderpriority" not in orders and "o_orderstatus" in orders


def test_filters_reach_the_scan(small):
    plan = plan_of(Q.complete_orders(small, sale=7))
    assert "EqualTo(o_orderkey,7)" in plan and "EqualTo(l_orderkey,7)" in plan


SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000", "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def tight(spark):
    """Limits so low that the small test tables count as skewed."""
    before = {k: spark.conf.get(k, None) for k in SMALL_LIMITS}
    for k, v in SMALL_LIMITS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def heat(df, key, value=1):
    """A third of the rows under one key."""
    kind = dict(df.dtypes)[key]
    spread = df.repartition(8)
    return spread.withColumn(key, F.when(F.hash(*df.columns) % 3 == 0, F.lit(value).cast(kind)).otherwise(F.col(key)))


def test_hot_sale_is_split(tight, small):
    hot = heat(small["detalle_ventas"], "id_venta")
    out = D.apportioned_lines(small["ventas"].withColumn("estado", F.lit("confirmada")), hot)
    out = out.select("id_venta", "monto_neto_linea")
    assert len(out.collect()) == hot.count() and "skew=true" in plan_of(out)


def test_hot_import_key_is_split(tight, small):
    feeds = DirtyFeeds(small)
    wide = feeds.productos().crossJoin(tight.range(40)).withColumn("fila", F.col("fila") * 100 + F.col("id")).drop("id")
    hot = heat(wide, "nombre", "el mismo nombre")
    out = I.validate_products(hot, small["categorias"], feeds.catalogo(), I.LENIENT)
    out = out.select("fila", "estado")
    assert len(out.collect()) == hot.count() and "skew=true" in plan_of(out)


def test_hot_client_is_split(tight, small):
    hot = heat(Activity(small).carts(), "id_cliente")
    out = C.price_carts(hot, small["productos"], small["ventas"], Activity(small).items())
    out = out.select("cart_id", "descuento_pct")
    assert out.collect() and "skew=true" in plan_of(out)


def test_hot_product_is_split(tight, small):
    hot = heat(Activity(small).items(), "id_producto")
    out = C.check_stock(Activity(small).carts(), small["productos"], hot)
    assert out.collect() and "skew=true" in plan_of(out)


def test_fact_windows_are_bounded(small):
    """The fact itself needs no window; only key numbering does, in blocks."""
    s = Star(small)
    plan = plan_of(D.apportioned_lines(small["ventas"], small["detalle_ventas"]))
    assert "Window" not in plan
    assert "Window" in plan_of(s.dim_c)


def test_import_keys_are_hashed(tight, small):
    """A sort on a collated key would ask for its bytes at every comparison."""
    feeds = DirtyFeeds(small)
    plan = plan_of(I.validate_products(feeds.productos(), small["categorias"], feeds.catalogo(), I.STRICT))
    assert plan.lower().count("shuffledhashjoin [collationkey") == 2 and "sortmergejoin [collationkey" not in plan.lower()
