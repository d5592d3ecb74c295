"""Reading the given Parquet tables.

Reads are lazy and typed: every table has a declared schema (``schemas``) that
is checked against the Parquet footer and passed to the reader.  Catalyst
prunes columns to what a plan uses (``ReadSchema``) and pushes filters into
the scan (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .paths import hadoop_path

TABLES = tuple(schemas.TABLES)


class Tables:
    """``Tables(spark, root)("orders")`` -> DataFrame over ``root/orders.parquet``.

    ``root`` may be a local folder or any Hadoop-compatible URI; a table may be
    a single file or a folder of part files.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(f"unknown table {name!r}")
        return schemas.read(self.spark, name, self.path(name))

    def exists(self, name: str) -> bool:
        fs, p = hadoop_path(self.spark, self.path(name))
        return bool(fs.exists(p))
