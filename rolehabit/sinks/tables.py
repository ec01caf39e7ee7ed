"""Intermediate results as Parquet in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def written(frame: DataFrame, folder: str) -> DataFrame:
    """Write a frame, replacing the folder, and go on from what was written.

    Later steps then neither repeat the work nor lose it with an executor.
    """
    schema = frame.schema
    frame.write.mode("overwrite").parquet(folder)
    return frame.sparkSession.read.schema(schema).parquet(folder)
