"""Continuous import: files are validated as they land and split into two sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tillwork import schema as S
from tillwork.functions.text import match_key
from tillwork.operators.validation import ISSUE, load_valid
from tillwork.sources.files import CORRUPT, CSV, short_rows_stay, split_corrupt, with_corrupt
from tillwork.streaming.keyindex import KeyIndex


def incoming(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv",
             files_per_trigger: int = 100) -> DataFrame:
    """Files of text columns as a stream, read as the batch readers read them: a malformed record is a row
    with ``_corrupt`` set. The trigger limit bounds each batch."""
    reader = spark.readStream.schema(with_corrupt(schema)).option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        return short_rows_stay(reader.options(**CSV).csv(folder))
    return reader.option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT).json(folder)


def import_stream(stream: DataFrame, validate: Callable[[DataFrame, DataFrame], DataFrame], target: DataFrame,
                  key: str, kind: T.StructType, out: str, checkpoint: str, entity: str = "Productos",
                  canon: Callable[[Column], Column] = match_key) -> DataStreamWriter:
    """A writer that validates each batch and stores accepted and rejected rows.

    ``validate(rows, existing)`` is one of the import plans with its lookups bound. Existing keys are
    those of ``target``, as it was when the stream first ran, plus everything accepted by earlier
    batches. They are kept in a ``KeyIndex``, and a batch is told those that share a ``canon`` with one
    of its own, so what it costs follows from its own rows and from the filters of few segments; no two
    keys that ``validate`` takes for one may differ in ``canon``. A batch is read and judged once and
    stored; both sinks read that. Each batch overwrites its own folders, so one that is replayed after
    a failure replaces itself.
    """
    spark = stream.sparkSession
    index = KeyIndex(spark, f"{out}/keys", canon)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/work/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/work/{name}")

    def handle(rows: DataFrame, batch_id: int) -> None:
        index.seed(target.select(key))
        index.drop_merged(batch_id)
        rows = rows if CORRUPT in rows.columns else rows.withColumn(CORRUPT, F.lit(None).cast("string"))
        good, bad = split_corrupt(stored(rows.withColumn("fila", F.monotonically_increasing_id()), "rows"), entity)
        existing = index.lookup(good.select(key), batch_id).withColumnRenamed("valor", key)
        judged = stored(validate(good, existing), "judged")
        load_valid(judged, kind).write.mode("overwrite").parquet(f"{out}/accepted/batch={batch_id}")
        rejected = judged.where(F.col("estado") == S.ROW_ERROR).select("fila", key, "observacion", "issues", "crudo")
        issue = F.struct("regla", "campo", "valor", "problema", "accion", "severidad")
        unread = bad.select("fila", F.lit(None).cast("string").alias(key), F.col("problema").alias("observacion"), F.array(issue).cast(f"array<{ISSUE}>").alias("issues"),
                            F.lit(None).cast(rejected.schema["crudo"].dataType).alias("crudo"))
        rejected.unionByName(unread).write.mode("overwrite").parquet(f"{out}/rejected/batch={batch_id}")
        index.add(batch_id, spark.read.schema(kind).parquet(f"{out}/accepted/batch={batch_id}").select(key))

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True))
