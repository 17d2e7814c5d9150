"""Names, exclusive files and folders, wherever Spark can write."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path and the path itself, as Spark resolves it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def child_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder. Not for folders of data."""
    files, where = _hadoop(spark, path)
    if not files.exists(where):
        return []
    return [child.getPath().getName() for child in files.listStatus(where)]


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already. Of several that try, one succeeds.

    On a distributed file system its master decides. On a local or mounted one the
    operating system does, as Hadoop's own client would look first and create afterwards.
    """
    files, where = _hadoop(spark, path)
    files.mkdirs(where.getParent())
    if files.getUri().getScheme() == "file":
        try:
            os.close(os.open(where.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        files.create(where, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def delete_tree(spark: SparkSession, path: str) -> bool:
    """Delete a folder and what is in it; False if there was none."""
    files, where = _hadoop(spark, path)
    return files.delete(where, True)
