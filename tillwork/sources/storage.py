"""What is stored where, asked of whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``; anything else that is wrong with it stays an error."""
    where, system = _file(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where, system = _file(spark, path)
    system.delete(where, True)


def files_below(spark: SparkSession, path: str) -> dict[str, int]:
    """Names, relative to ``path``, and sizes of its data files; none if it is not there."""
    where, system = _file(spark, path)
    if not system.exists(where):
        return {}
    found, root = {}, system.makeQualified(where).toUri().getPath().rstrip("/") + "/"
    listed = system.listFiles(where, True)
    while listed.hasNext():
        entry = listed.next()
        name = entry.getPath().toUri().getPath().removeprefix(root)
        if not any(part[0] in "._" for part in name.split("/")):
            found[name] = entry.getLen()
    return found
