"""Folders of a store: listing, deleting, and files that are there whole or not at all."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in order; none if their parents are missing."""
    found = _system(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(status.getPath().toString() for status in found or ())


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path."""
    return _system(spark, path).getContentSummary(_path(spark, path)).getLength()


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def commit(spark: SparkSession, path: str, text: str) -> None:
    """A small file under this name, replacing an older one in one step.

    Readers find the old text or the new one: it is written beside the name and renamed onto it.
    """
    jvm, beside = spark._jvm, f"{path}.new"
    stream = _system(spark, path).create(_path(spark, beside), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _system(spark, path).getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(_path(spark, beside), _path(spark, path), options)
