"""Small operations on any file system that Spark knows, through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's default file system resolves it."""
    found = _system(spark, path).makeQualified(_path(spark, path)).toString()
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and "://" not in found else found


def names(spark: SparkSession, folder: str) -> list[str]:
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return []
    return [status.getPath().getName() for status in system.listStatus(_path(spark, folder))]


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None where there is no such file."""
    if not _system(spark, path).exists(_path(spark, path)):
        return None
    return spark.read.option("wholetext", True).text(path).first()["value"]


def replace_text(spark: SparkSession, path: str, text: str, draft: str) -> None:
    """Write a small file in one step: readers see the old text or the new one, never a part."""
    out = _system(spark, draft).create(_path(spark, draft), True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark._jsc.hadoopConfiguration()
    ) if "://" in path else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context.rename(_path(spark, draft), _path(spark, path), options)
