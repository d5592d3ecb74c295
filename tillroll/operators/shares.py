"""Shares and ratios: pivoted percentages per group, ratio of sums, and
before/after comparisons around an anchor date.

All of them are one grouped aggregate with conditional sums: the pivot is a
set of ``sum(case when dim = v ...)`` columns computed in the same pass, so
there is one shuffle of partial aggregates per query, whatever the number of
pivot values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sem import ratio_round


def pivot_shares(df: DataFrame, groups: Sequence[str], dim: str, measure: str,
                 values: Mapping[str, str], digits: int = 2, scale: int = 2) -> DataFrame:
    """Per group, ``round(100 * sum(measure where dim = v) / sum(measure), digits)``
    for each ``out_name -> v`` in ``values`` (NULL when a value is absent).
    ``measure`` is exact with ``scale`` decimals; rounding is exact, half away."""
    sums = [F.sum(F.when(F.col(dim) == v, F.col(measure))).alias(f"_s{i}") for i, v in enumerate(values.values())]
    agg = df.groupBy(*groups).agg(F.sum(measure).alias("_all"), *sums)
    return agg.select(*groups, *[
        ratio_round(F.col(f"_s{i}") * 100, F.col("_all"), digits, scale, scale).alias(name)
        for i, name in enumerate(values)])


def ratio_of_sums(df: DataFrame, groups: Sequence[str], dim: str, values: Mapping[str, str],
                  num: str, den: str, digits: int = 0, num_scale: int = 2) -> DataFrame:
    """Per group and dim value: ``round(sum(num) / sum(den), digits)`` -- the
    ratio of totals, not the mean of per-row ratios."""
    aggs = []
    for i, v in enumerate(values.values()):
        aggs += [F.sum(F.when(F.col(dim) == v, F.col(num))).alias(f"_n{i}"),
                 F.sum(F.when(F.col(dim) == v, F.col(den))).alias(f"_d{i}")]
    agg = df.groupBy(*groups).agg(*aggs)
    return agg.select(*groups, *[
        ratio_round(F.col(f"_n{i}"), F.col(f"_d{i}"), digits, num_scale, 0).alias(name)
        for i, name in enumerate(values)])


def before_after(df: DataFrame, groups: Sequence[str], is_before, is_after, measure: str,
                 scale: int = 2) -> DataFrame:
    """Per group: total ``measure`` before and after, the change, and the
    change as a percentage of before (2 decimals, exact)."""
    agg = df.groupBy(*groups).agg(F.sum(F.when(is_before, F.col(measure))).alias("before_sales"),
                                  F.sum(F.when(is_after, F.col(measure))).alias("after_sales"))
    change = F.col("after_sales") - F.col("before_sales")
    return agg.select(*groups,
                      F.col("before_sales").cast("double").alias("before_sales"),
                      F.col("after_sales").cast("double").alias("after_sales"),
                      change.cast("double").alias("sales_change"),
                      ratio_round(change * 100, F.col("before_sales"), 2, scale, scale).alias("change_pct"))
