"""Driver tables (parquet, one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_utc, let_workers_import

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    let_workers_import(spark)
    return spark.read.parquet(table_path(sf_dir, name))
