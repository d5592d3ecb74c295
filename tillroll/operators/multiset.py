"""Multisets of rows: UNION ALL, EXCEPT, EXCEPT ALL, INTERSECT ALL as algebra on counts.

A multiset is a DataFrame of distinct rows with their number (``count``).
Chains stay small whatever the numbers are: a row that occurs a billion times is one
row, added up before the shuffle, and rows are only spread out by ``rows_of`` at
the end.  NULLs are equal, as in SQL's set operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "count"


def counted(df: DataFrame, n: Column | None = None) -> DataFrame:
    """The multiset of the rows of ``df``, each as often as it occurs (or ``n`` times, a column of ``df`` that is then dropped)."""
    times = F.lit(1) if n is None else n
    with_n = df.withColumn("_times", times)
    cols = [c for c in df.columns if n is None or c != COUNT]
    return with_n.groupBy(*cols).agg(F.sum("_times").cast("long").alias(COUNT)).where(F.col(COUNT) > 0)


def _beside(a: DataFrame, b: DataFrame, both: Column) -> DataFrame:
    """Rows of either side with ``both`` of their numbers ``_a`` and ``_b``, where above 0."""
    cols = [c for c in a.columns if c != COUNT]
    if set(cols) != set(b.columns) - {COUNT}:
        raise ValueError(f"different columns: {cols} and {b.columns}")
    zero = F.lit(0).cast("long")
    left = a.select(*cols, F.col(COUNT).alias("_a"), zero.alias("_b"))
    right = b.select(*cols, zero.alias("_a"), F.col(COUNT).alias("_b"))
    sums = left.unionByName(right).groupBy(*cols).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    return sums.select(*cols, both.cast("long").alias(COUNT)).where(F.col(COUNT) > 0)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return _beside(a, b, F.col("_a") + F.col("_b"))


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each row as often as it occurs more in ``a`` than in ``b``."""
    return _beside(a, b, F.greatest(F.col("_a") - F.col("_b"), F.lit(0)))


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that ``b`` lacks, once each."""
    return _beside(a, b, F.when((F.col("_a") > 0) & (F.col("_b") == 0), 1).otherwise(0))


def intersect_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return _beside(a, b, F.least("_a", "_b"))


def rows_of(a: DataFrame) -> DataFrame:
    """The rows themselves, each as often as its number says."""
    cols = [c for c in a.columns if c != COUNT]
    return a.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COUNT))).alias("_i")).drop("_i")
