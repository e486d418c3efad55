"""Full and differential snapshots, their log, and restore."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tillwork.sources.checksums import totals
from tillwork.sources.storage import exists, files_below

FULL, DIFFERENTIAL, LOG_MARK = "FULL", "DIFERENCIAL", "LOG_TRANSACCIONES"

# Delimited snapshots have no header, quote where needed, and write NULL as \N.
_CSV = {
    "header": "false", "sep": ",", "quote": '"', "escape": "\\", "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "dateFormat": "yyyy-MM-dd", "encoding": "UTF-8",
}


# Text that itself looks like the NULL mark, with any number of backslashes before the N.
_NULL_LIKE = r"^\\+N$"


def _texts(df: DataFrame, change) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[
        F.when(F.col(c).rlike(_NULL_LIKE), change(F.col(c))).otherwise(F.col(c)).alias(c)
        if kinds[c] == "string" else F.col(c) for c in df.columns])


class IncompleteSnapshot(ValueError):
    """A snapshot lacks files or rows that its manifest names, or was never finished."""


_MANIFEST = "archivo string, bytes long, filas long, suma_a long, suma_b long, mezcla long"


def snapshot_full(df: DataFrame, path: str, fmt: str = "csv", rows_per_file: int = 1_000_000) -> None:
    """Writes the whole table in files of at most ``rows_per_file`` rows: a delimited file is read
    back by one task, since its records may hold line breaks. Note the time before calling: it
    is the watermark of the snapshot, so that changes made meanwhile fall into the next one.

    Last of all comes the manifest: every file with its size, and rows and checksum of the whole,
    taken while the rows were written.
    """
    spark, seen = df.sparkSession, Observation()
    watched = df.observe(seen, *totals(df.columns))
    if fmt == "csv":
        marked = _texts(watched, lambda text: F.concat(F.lit("\\"), text))
        marked.write.options(**_CSV).option("emptyValue", '""').option("maxRecordsPerFile", rows_per_file).csv(path)
    else:
        watched.write.parquet(path)
    found = seen.get
    rows = [(name, size, None, None, None, None) for name, size in files_below(spark, path).items()]
    rows.append((None, None, *[found[c] for c in ("filas", "suma_a", "suma_b", "mezcla")]))
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.json(f"{path}/_manifest")


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", verify: bool = False) -> DataFrame:
    """The table as it was saved. A snapshot without its manifest, or with files missing or of another
    size, is refused; ``verify`` also reads it all and compares rows and checksum."""
    if not exists(spark, f"{path}/_manifest/_SUCCESS"):
        raise IncompleteSnapshot(f"{path} has no manifest")
    manifest = spark.read.schema(_MANIFEST).json(f"{path}/_manifest").collect()
    named = {r["archivo"]: r["bytes"] for r in manifest if r["archivo"] is not None}
    there = files_below(spark, path)
    wrong = sorted(n for n in named.keys() | there.keys() if named.get(n) != there.get(n))
    if wrong:
        raise IncompleteSnapshot(f"{path}: {len(wrong)} files differ from the manifest, the first is {wrong[0]}")
    if fmt != "csv":
        found = spark.read.schema(schema).parquet(path)
    else:  # records may hold line breaks inside quotes
        raw = spark.read.schema(schema).options(**_CSV).option("emptyValue", "").option("multiLine", True).csv(path)
        found = _texts(raw, lambda text: F.substring(text, 2, 2 ** 31 - 1))
    if verify:
        whole = next(r for r in manifest if r["archivo"] is None)
        if found.agg(*totals(found.columns)).first() != tuple(whole[c] for c in ("filas", "suma_a", "suma_b", "mezcla")):
            raise IncompleteSnapshot(f"{path}: rows differ from the manifest")
    return found


def last_full(log: DataFrame, table: str) -> Column:
    """Start of the latest full snapshot of a table, as a scalar the scan can filter on."""
    return (log.where((F.col("tipo") == FULL) & (F.col("tabla_afectada") == table))
            .agg(F.max("fecha_inicio")).scalar())


def snapshot_diff(df: DataFrame, log: DataFrame, table: str, ts_col: str) -> DataFrame:
    """Rows changed after the last full snapshot began; none if there was no full snapshot."""
    return df.where(F.col(ts_col) > last_full(log, table))


def restore(full: DataFrame, diffs: DataFrame | list[DataFrame], key: str, ts_col: str | None = None,
            deleted: DataFrame | None = None) -> DataFrame:
    """The full snapshot with the differential rows put over it by primary key.

    Of several differentials the newest row per key by ``ts_col`` wins, found by an aggregate
    that combines before shuffling. ``deleted`` holds keys removed since.
    """
    diffs = diffs if isinstance(diffs, list) else [diffs]
    over = reduce(DataFrame.unionByName, diffs)
    if len(diffs) > 1:
        columns = over.columns
        over = (over.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(ts_col)).alias("row"))
                .select(*[F.col(f"row.{c}").alias(c) for c in columns]))
    result = full.join(over.select(key), key, "left_anti").select(*full.columns).unionByName(over)
    if deleted is not None:
        result = result.join(deleted.select(key), key, "left_anti").select(*full.columns)
    return result


def log_snapshot(df: DataFrame, kind: str, table: str | None, path: str | None, started_at: Column) -> DataFrame:
    """One log row with the number of rows saved."""
    return df.agg(F.count("*").alias("filas_respaldadas")).select(
        F.lit(kind).alias("tipo"), F.lit(table).cast("string").alias("tabla_afectada"),
        F.lit(path).cast("string").alias("archivo"), "filas_respaldadas",
        started_at.cast("timestamp_ntz").alias("fecha_inicio"))


def snapshot_report(log: DataFrame, kind: str | None = None) -> DataFrame:
    rows = log if kind is None else log.where(F.col("tipo") == kind)
    return rows.orderBy("fecha_inicio", F.asc_nulls_first("tabla_afectada"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side the other lacks, counted; both zero means equal, duplicates included."""
    right = b.select(*a.columns)
    return row_counts({"solo_a": a.exceptAll(right), "solo_b": right.exceptAll(a)})
