"""Folders of any file system Spark reaches, through the session's JVM: classic sessions only, not Spark Connect."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, filesystem = hadoop_path(spark, path)
    return filesystem.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it isn't there."""
    folder, filesystem = hadoop_path(spark, path)
    if not filesystem.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in filesystem.listStatus(folder))


def delete(spark: SparkSession, path: str) -> None:
    folder, filesystem = hadoop_path(spark, path)
    filesystem.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if there is none."""
    file, filesystem = hadoop_path(spark, path)
    if not filesystem.exists(file):
        return None
    stream = filesystem.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: whoever reads it sees the old text or the new one.

    Written beside its place and renamed over it; on stores without renames a file appears
    whole when it is closed.
    """
    file, filesystem = hadoop_path(spark, path)
    if filesystem.getUri().getScheme() not in ("file", "hdfs", "viewfs"):
        _write(filesystem, file, text)
        return
    jvm = spark._jvm
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    _write(filesystem, beside, text)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(filesystem.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(beside, file, options)


def _write(filesystem, file, text: str) -> None:
    stream = filesystem.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
