"""Price changes as they happen, per key, across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from tillwork.functions.dates import hour_slice
from tillwork.operators.changes import change_columns, price_history
from tillwork.sources.storage import exists

#: Where the value state of ``price_change_stream`` lives: on the executors' disks, not in their heaps,
#: changes alone uploaded to the checkpoint. A session setting, read when the query starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class LastPrice(StatefulProcessor):
    """Holds one key's last price; hands on the events whose price differs from the one before.

    An event of a later batch counts as later. Events of one batch come in any order, so a key's rows of
    one batch are sorted in the task; the trigger limit of the source bounds them.
    """

    def __init__(self, ts: str, event_id: str, price: str, kind: T.DataType):
        self.order, self.price, self.kind = [ts, event_id], price, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", T.StructType([T.StructField("price", self.kind, True)]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = self.last.get()[0] if self.last.exists() else None
        for row in sorted(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in self.order)):
            new = row[self.price]
            # the first price of a key is no change; a missing price on either side is none either
            if old is not None and new is not None and old != new:
                yield Row(**row.asDict(), _old=old)
            old = new
        if old is None:
            self.last.clear()
        else:
            self.last.update((old,))

    def close(self) -> None:
        pass


def price_change_stream(stream: DataFrame, key: str, ts: str, event_id: str, price: str, out: str,
                        checkpoint: str) -> DataStreamWriter:
    """Writes one row per price change to ``out/changes``, exactly once.

    An event of a later batch counts as later, whatever its timestamp, as an update would. The last
    price of each key is value state in the state store, so a batch costs what it touches and a
    restarted query goes on from its checkpoint. Set ``STATE_STORE`` on the session first. Events without
    a key have no price before them and are left out.
    """
    kind = T.StructType([*[stream.schema[c] for c in (key, ts, event_id, price)], T.StructField("_old", stream.schema[price].dataType)])
    rows = stream.select(key, ts, event_id, price).where(F.col(key).isNotNull()).groupBy(key).transformWithState(
        LastPrice(ts, event_id, price, stream.schema[price].dataType), kind, "append", "none")
    changes = rows.select(key, ts, event_id, *change_columns(F.col("_old"), F.col(price)))
    return (changes.writeStream.format("parquet").outputMode("append").option("path", f"{out}/changes")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True))


def price_change_batches(stream: DataFrame, key: str, ts: str, event_id: str, price: str, out: str,
                         checkpoint: str, compact_every: int = 50) -> DataStreamWriter:
    """The same without a state store: the last prices are tables beside the changes.

    Each key a batch touched is appended with its last price, and all are folded every ``compact_every``
    batches; a batch reads the folders since the last fold.
    """
    spark = stream.sparkSession
    kept = [key, ts, event_id, price]
    kind = T.StructType([stream.schema[c] for c in kept])
    state = f"{out}/last"

    def newest(df: DataFrame, *order: str) -> DataFrame:
        return (df.groupBy(key).agg(F.max_by(F.struct(ts, event_id, price), F.struct(*order)).alias("r"))
                .select(key, "r.*"))

    def earlier(folded: int, batch_id: int) -> DataFrame:
        there = [f"{state}/batch={b}" for b in range(folded, batch_id) if exists(spark, f"{state}/batch={b}")]
        found = spark.read.schema(kind).option("basePath", state)
        if not there:
            return spark.createDataFrame([], kind).withColumn("batch", F.lit(0).cast("bigint"))
        return found.parquet(*there).withColumn("batch", F.col("batch").cast("bigint"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*kept).where(F.col(key).isNotNull())
        folded = (max(batch_id - 1, 0) // compact_every) * compact_every
        before = earlier(folded, batch_id)
        touched = before.join(rows.select(key).distinct(), key, "left_semi")
        series = (newest(touched, "batch").select(*kept).withColumn("_seq", F.lit(0))
                  .unionByName(rows.withColumn("_seq", F.lit(1))))
        slice_of = F.when(F.col("_seq") == 0, F.lit(-(2 ** 31))).otherwise(hour_slice(F.col(ts)))
        changes = price_history(series, key, ["_seq", ts, event_id], slice_of, price).drop("_seq")
        changes.write.mode("overwrite").parquet(f"{out}/changes/batch={batch_id}")
        last = newest(rows, ts, event_id)
        if batch_id and batch_id % compact_every == 0:
            # all known keys under this batch; from here on, readers start at its folder
            merged = before.unionByName(last.select(*kept).withColumn("batch", F.lit(batch_id).cast("bigint")))
            last = newest(merged, "batch")
        last.select(*kept).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True))
