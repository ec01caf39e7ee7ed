"""Helpers of this subpackage: reading tables, shared intermediate tables, batches."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import rolehabit
from rolehabit.session import shared_folder

#: Rows of one Arrow batch; texts can be long, so batches are short.
BATCH_ROWS = 256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query under its own name, with its SQL if it has one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(frame: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``frame`` has."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(rolehabit.__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), rolehabit.__name__), "zip", root, rolehabit.__name__)
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def map_batches(
    frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """mapInArrow with batches short enough for long texts."""
    ship(frame.sparkSession)
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return frame.mapInArrow(function, schema)


def stored(frame: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of files, not a recomputation.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    writer = frame.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
