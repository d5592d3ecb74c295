"""Calendar spines, zero-filled contributions, running balances and values
missing from a range.

A spine is key x period built with ``explode(sequence(...))`` on the distinct
keys -- a generator, not a join -- so it is produced where the keys are and
grows linearly with them.  The running window then runs over one key's
*periods* (a handful of rows), never over its raw events.

For a few fixed months the spine needs no join or window at all:
``month_columns`` sums each as its own column in one grouped pass (every key
gets a row, NULL for months without events).  For a whole calendar
``running_rows`` sums per (key, month) first and lays the months out per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def month_spine(keys: DataFrame, key: str, first_month: dt.date, months: int,
                out: str = "month", number_col: str | None = None) -> DataFrame:
    """``key x {first_month, +1 month, ...}`` (``months`` periods) for every
    distinct key; ``number_col`` (1-based period number) if requested."""
    start = F.lit(first_month)
    seq = F.sequence(start, F.add_months(start, months - 1), F.expr("interval 1 month"))
    distinct = keys.select(key).distinct()
    if number_col:
        return distinct.select(key, F.posexplode(seq).alias("_pos", out)).select(
            key, out, (F.col("_pos") + 1).cast("long").alias(number_col))
    return distinct.select(key, F.explode(seq).alias(out))


def fill_on_spine(spine: DataFrame, values: DataFrame, on: list[str]) -> DataFrame:
    """Left join per-period values onto the spine (missing periods -> NULL)."""
    return spine.join(values, on, "left")


def running_total(df: DataFrame, key: str, order_col: str, value: str, out: str) -> DataFrame:
    """``sum(value) over (partition by key order by order_col rows unbounded
    preceding)``: NULL until the first non-NULL value of the key."""
    w = Window.partitionBy(key).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def missing_in_range(spark: SparkSession, present: DataFrame, column: str, lo: int, hi: int) -> DataFrame:
    """Integers ``lo..hi`` that do not occur in ``present[column]``."""
    seen = present.select(F.col(column).cast("long").alias("id")).distinct()
    return spark.range(lo, hi + 1).join(seen, "id", "left_anti").select(F.col("id").alias(column))


def _add_months(d: dt.date, k: int) -> dt.date:
    y, m = divmod(d.month - 1 + k, 12)
    return dt.date(d.year + y, m + 1, 1)


def calendar(first_month: dt.date, months: int) -> list[dt.date]:
    """First days of ``months`` consecutive months from ``first_month``."""
    start = first_month.replace(day=1)
    return [_add_months(start, k) for k in range(months)]


def month_columns(df: DataFrame, key: str, date_col: str, value, first_month: dt.date,
                  months: int, prefix: str = "_m", closing: bool = False) -> DataFrame:
    """One row per key with ``<prefix>0 .. <prefix>{months-1}``: the sum of
    ``value`` over the key's rows in each calendar month (NULL when none), or
    with ``closing`` over all rows up to the month's end.
    Every key present in ``df`` gets a row; one grouped pass (partial
    aggregation before the shuffle)."""
    m = F.trunc(F.to_date(F.col(date_col)), "month")
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(key).agg(*[F.sum(F.when(m <= F.lit(d) if closing else m == F.lit(d), v)).alias(f"{prefix}{i}")
                                 for i, d in enumerate(calendar(first_month, months))])


def running_rows(monthly: DataFrame, key: str, month: str, value: str, first: Column, last: Column,
                 amount: str = "amount", running: str = "running") -> DataFrame:
    """Spine rows (key, month, amount, running) from one row per (key, month):
    every key gets every month from ``first`` to ``last``; ``amount`` is the
    month's ``value`` with 0 for none, ``running`` the sum of the months up to
    it, NULL until the key's first month with rows.  A key holds its months
    only, so the work grows with the rows and not with the calendar's square."""
    known = F.when(F.col(month).isNotNull(), F.struct(F.col(month), F.col(value)))
    per_key = monthly.groupBy(key).agg(F.map_from_entries(F.collect_list(known)).alias("_by_month"))
    grid = per_key.select(key, "_by_month", F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias(month))
    grid = grid.select(key, month, F.try_element_at("_by_month", F.col(month)).alias("_net"))
    return running_total(grid, key, month, "_net", running).select(
        key, month, F.coalesce("_net", F.lit(0)).alias(amount), running)
