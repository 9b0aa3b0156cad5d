"""Typed access to the driver tables (one Parquet file per table)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df
