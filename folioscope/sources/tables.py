"""Reading the tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet file or directory of one table."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
