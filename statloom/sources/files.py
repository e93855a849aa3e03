"""Small file operations on whatever storage a path names (local, HDFS, object store)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str, directories: bool) -> list[str]:
    """Names directly under a folder, files or directories; a missing folder is empty."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() == directories)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and rename it over the target."""
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}"
    )
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(fs.makeQualified(part), fs.makeQualified(target), options)


def make_until_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that is removed when the session's file system is closed, if it is still there."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
