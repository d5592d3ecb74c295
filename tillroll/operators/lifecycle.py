"""Subscription lifecycles: state in force at a date (as-of snapshot), the
state before each event (transitions), the n-th event, time between states.

The snapshot and "not the first event" tests are grouped aggregates over a
struct of the ordering columns (partial aggregation before the shuffle), not
windows, so a customer with a third of all events does not become one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sequence


def snapshot_as_of(df: DataFrame, key: str, order_cols: Sequence[str], time_col: str,
                   at: Column, state_cols: Sequence[str]) -> DataFrame:
    """The row in force at ``at`` for every key: the last row (by
    ``order_cols``) with ``time_col <= at``.  Equal to keeping rows with
    ``start <= at and (next start > at or no next)`` when starts are unique
    per key.  Returns ``key`` + ``state_cols``."""
    packed = F.struct(*[F.col(c).alias(c) for c in state_cols])
    last = (df.filter(F.col(time_col) <= at).groupBy(key)
              .agg(F.max_by(packed, sequence.place(order_cols)).alias("_s")))
    return last.select(key, *[F.col(f"_s.{c}").alias(c) for c in state_cols])


def after_first(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """Rows that have a predecessor in their key (``lag(...) is not null``):
    every row except the first one of each key."""
    first = df.groupBy(F.col(key).alias("_k")).agg(F.min(sequence.place(order_cols)).alias("_first"))
    return (df.join(first, df[key].eqNullSafe(first["_k"]))          # a NULL key is a group too
              .filter(sequence.place(order_cols) > F.col("_first")).drop("_k", "_first"))


def with_previous_state(df: DataFrame, key: str, order_cols: Sequence[str], state: str,
                        out: str) -> DataFrame:
    """Add the previous row's ``state`` per key (NULL on the first row)."""
    return sequence.previous_value(df, key, order_cols, state, out)


def first_times(df: DataFrame, key: str, state: str, time_col: str, states: dict) -> DataFrame:
    """Per key, the first ``time_col`` in each of several states, side by
    side (``out_name -> state value``; NULL when never in it): one grouped
    pass instead of one aggregate and one join per state."""
    return df.filter(F.col(state).isin(*states.values())).groupBy(key).agg(
        *[F.min(F.when(F.col(state) == v, F.col(time_col))).alias(name) for name, v in states.items()])


def period_label(period: Column, width: int, unit: str = "days") -> Column:
    """``'<p*w> - <p*w+w> <unit>'`` for an integral bucket number ``p``."""
    start = (period * width).cast("long")
    return F.concat(start.cast("string"), F.lit(" - "), (start + width).cast("string"), F.lit(f" {unit}"))
