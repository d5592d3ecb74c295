"""Ranking: first/last rows per key (ties kept), full RANK(), n-th row, top-n.

A window ``PARTITION BY key`` puts every row of a key into one task, so one
hot key (a third of all rows) would make one task read a third of the data.
These operators avoid that:

* ``rows_at_extreme`` (``rank() == 1``) finds each key's extreme by a partial
  aggregate (one row per key and task is shuffled) and keeps the rows that equal
  it by a semi join: no window, no sort per key, and rows that tie stay spread;
* ``nth_in_group`` (``row_number() = n``) filters right above the window, so a
  task keeps only its own best rows per key before the one shuffle (``WindowGroupLimit``);
* ``rank_within`` cuts keys with many rows into ranges of their order (``sequence.rank``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import sequence

LANES = 4096


def rows_at_extreme(df: DataFrame, keys: str | Sequence[str], order_col: str,
                    largest: bool = False) -> DataFrame:
    """Rows whose ``order_col`` equals the min (max if ``largest``) of their key
    group -- ``rank() over (partition by keys order by order_col) = 1`` with
    ties kept and duplicates preserved.  NULL values rank last in both
    directions (a key with only NULLs returns all its rows)."""
    keys = sequence.keys_of(keys)
    extreme = (F.max if largest else F.min)(order_col).alias("_extreme")
    best = df.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(extreme)
    same = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]
    return df.join(best, [*same, F.col(order_col).eqNullSafe(F.col("_extreme"))], "left_semi")


def rank_within(df: DataFrame, keys: str | Sequence[str], order_col: str, out: str = "rank", descending: bool = False,
                where: Column | None = None, rows: int | None = None, sample: DataFrame | None = None) -> DataFrame:
    """``rank() over (partition by keys order by order_col)`` as column ``out``
    (long); NULL ``order_col`` values sort last ascending and first
    descending, as in SQL.  With ``where`` only the rows it holds for are
    ranked (among themselves), the others get NULL.  ``rows`` and ``sample``: see ``sequence``."""
    keys = sequence.keys_of(keys)
    if where is None:
        return sequence.rank(df, keys, order_col, out, descending, rows, sample)
    flagged = df.withColumn("_ranked", F.coalesce(where, F.lit(False)))
    # rows that aren't ranked need no order: where keys are cut, they are spread by a hash
    lanes = F.when(~F.col("_ranked"), F.pmod(F.xxhash64(*df.columns), F.lit(LANES)).cast("int"))
    if sample is not None:  # as if all its rows were ranked, so enough keys are cut
        sample = sample.withColumn("_ranked", F.lit(True))
    ranked = sequence.rank(flagged, [*keys, "_ranked"], order_col, out, descending, rows, sample, lanes)
    return ranked.withColumn(out, F.when(F.col("_ranked"), F.col(out))).drop("_ranked")


def nth_in_group(df: DataFrame, keys: str | Sequence[str], order_cols: Sequence[str],
                 n: int) -> DataFrame:
    """The n-th row per key under a total order (``row_number() = n``); keys
    with fewer than ``n`` rows are absent.  A task keeps at most n rows per
    key before the single shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*sequence.keys_of(keys)).orderBy(*[F.asc_nulls_last(c) for c in order_cols])
    return df.withColumn("_row", F.row_number().over(w)).where(F.col("_row") == n).drop("_row")


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """Global top-n under ``order`` (planned as TakeOrderedAndProject: each
    task keeps its own n best, the driver merges n x tasks rows)."""
    return df.orderBy(*order).limit(n)
