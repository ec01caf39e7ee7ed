"""Small helpers over the Hadoop file system API Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob names anything."""
    path, fs = _resolve(spark, pattern)
    found = fs.globStatus(path)
    return found is not None and len(found) > 0


def names_in(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _resolve(spark, folder)
    if not fs.exists(path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(path)]


def create_marker(spark: SparkSession, path: str) -> None:
    """Create an empty file; fails if it is already there."""
    hadoop_path, fs = _resolve(spark, path)
    fs.create(hadoop_path, False).close()


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing one of that name."""
    hadoop_path, fs = _resolve(spark, path)
    out = fs.create(hadoop_path, True)
    out.write(bytearray(text.encode()))
    out.close()
