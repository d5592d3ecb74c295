"""Exact distinct counts that can be stored, merged and taken apart by period.

A period's ids are a set of bitmaps, one per 32,768 consecutive ids
(``bitmap_construct_agg``: partial aggregation, 4 KB a bitmap).  Merging is a
bitwise or, so the ids of a quarter, or of all periods, come from the stored
states without a second look at the rows, which ``count(distinct)`` needs for
every other grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_states(df: DataFrame, periods: Sequence[Column], id_col: str) -> DataFrame:
    """One row per period and id range: the columns ``periods``, ``bucket`` and ``ids`` (a bitmap).  NULL ids don't count."""
    i = F.col(id_col).cast("long")
    known = df.where(F.col(id_col).isNotNull())
    return known.groupBy(*periods, F.bitmap_bucket_number(i).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(i)).alias("ids"))


def merge(states: DataFrame, periods: Sequence[str | Column] = ()) -> DataFrame:
    """The states of coarser ``periods`` (none: of everything); also adds up states of later loads."""
    return states.groupBy(*periods, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def count_ids(states: DataFrame, periods: Sequence[str], out: str) -> DataFrame:
    """``periods``, ``out``: distinct ids of each period (states merged to one per period and range)."""
    return states.groupBy(*periods).agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0)).cast("long").alias(out))
