"""Import files: product CSV and customer JSON, read as text with a row number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwork import schema as S

CORRUPT = "_corrupt"

#: Headered UTF-8; a quote inside a quoted field is doubled.
CSV = {"header": "true", "encoding": "UTF-8", "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def with_corrupt(kind: T.StructType) -> T.StructType:
    return T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])


def _numbered(df: DataFrame, first: int) -> DataFrame:
    """Row number in reading order. Within one split it is dense and starts at ``first``;
    across splits it stays unique and ordered, which is all the rules need. Feeds that
    need their own numbering carry an id column instead."""
    return df.withColumn("fila", F.monotonically_increasing_id() + first)


def _own_number(df: DataFrame, row_id: str) -> DataFrame:
    number = F.col(row_id).try_cast("bigint").alias("fila")
    return df.select(number, *[c for c in df.columns if c != row_id])


def read_products_csv(spark: SparkSession, path: str, row_id: str | None = None,
                      schema: T.StructType = S.STAGING_PRODUCTOS) -> DataFrame:
    """Headered UTF-8 CSV, every field text, empty means missing. The header counts as row 1.

    A row with fewer fields than the header has its last ones missing, as the rules then say;
    one with more fields is a malformed record.

    ``row_id`` names a column of the file to use as row number.
    """
    fields = [T.StructField(row_id, T.StringType()), *schema.fields] if row_id else schema.fields
    raw = short_rows_stay(spark.read.schema(with_corrupt(T.StructType(fields))).options(**CSV).csv(path))
    if row_id:
        return _own_number(raw, row_id)
    return _numbered(raw, 2)


def short_rows_stay(raw: DataFrame) -> DataFrame:
    """The reader fills what fields it can and marks rows of any other length; short ones are no fault."""
    fields = [c for c in raw.columns if c != CORRUPT]
    # counted as the reader counts: a field may hold quoted commas
    row = F.from_csv(F.col(CORRUPT), F.lit(", ".join(f"f{i} string" for i in range(len(fields) + 1))), {"mode": "PERMISSIVE", "escape": '"'})
    longer = row[f"f{len(fields)}"].isNotNull()
    parsed = F.coalesce(*[F.col(c) for c in fields]).isNotNull()
    return raw.withColumn(CORRUPT, F.when(longer | ~parsed, F.col(CORRUPT)))


def read_clients_json(spark: SparkSession, path: str, lines: bool = False, row_id: str | None = None,
                      schema: T.StructType = S.STAGING_CLIENTES) -> DataFrame:
    """JSON arrays of customer objects, one array per file, or one object per line.

    An array is parsed by one task as a whole, so large feeds should be many files or use
    ``lines``, which splits. A malformed file or line becomes a row with ``_corrupt`` set.
    """
    fields = [T.StructField(row_id, T.StringType()), *schema.fields] if row_id else schema.fields
    raw = (spark.read.schema(with_corrupt(T.StructType(fields))).option("multiLine", not lines)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path))
    if row_id:
        return _own_number(raw, row_id)
    return _numbered(raw, 1)


def split_corrupt(raw: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the unreadable ones in the shape of the issue log."""
    # Always true, but it keeps the data columns in the scan: the readers find out about a
    # malformed record by parsing it, and refuse to fill the corrupt column on its own.
    parsed = F.length(F.concat_ws("", *[c for c in raw.columns if c not in (CORRUPT, "fila")])) >= 0
    good = raw.where(F.col(CORRUPT).isNull() & parsed).drop(CORRUPT)
    bad = raw.where(F.col(CORRUPT).isNotNull() & parsed).select(
        F.lit(entity).alias("entidad"), "fila", F.lit("archivo").alias("identificador"),
        F.lit(S.ROW_ERROR).alias("estado"), F.lit("archivo_malformado").alias("regla"),
        F.lit("archivo").alias("campo"), F.col(CORRUPT).alias("valor"),
        F.lit("registro malformado").alias("problema"), F.lit("descartado").alias("accion"),
        F.lit("error").alias("severidad"))
    return good, bad
