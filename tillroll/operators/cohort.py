"""Cohorts around an anchor date: membership flags, before/after windows,
points rules with multipliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_member_flag(events: DataFrame, anchors: DataFrame, key: str, date_col: str,
                     anchor_col: str, out: str = "member",
                     yes: str = "Y", no: str = "N") -> DataFrame:
    """Left-join each event to its key's anchor date; ``out`` is ``yes`` from
    the anchor date on, ``no`` before it or when the key has no anchor."""
    j = events.join(anchors, key, "left")
    flag = F.when(F.col(anchor_col).isNull() | (F.col(date_col) < F.col(anchor_col)), no).otherwise(yes)
    return j.withColumn(out, flag)


def anchored(events: DataFrame, anchors: DataFrame, key: str, date_col: str,
             anchor_col: str, side: str) -> DataFrame:
    """Events of keys that have an anchor, restricted to one side of it:
    ``side='on_or_after'`` (date >= anchor) or ``'before'`` (date < anchor)."""
    j = events.join(anchors, key)
    cond = F.col(date_col) >= F.col(anchor_col) if side == "on_or_after" else F.col(date_col) < F.col(anchor_col)
    return j.filter(cond)


def same_month(date_col: str, anchor_col: str) -> Column:
    """Event falls in the calendar month (and year) of the anchor date."""
    return ((F.year(date_col) == F.year(anchor_col)) & (F.month(date_col) == F.month(anchor_col)))


def points(amount: str | Column, base: int, bonus_rules: Sequence[tuple[Column, int]]) -> Column:
    """``amount * multiplier``: the multiplier of the first matching rule,
    else ``base``.  Rules are ``(condition, multiplier)``."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    expr = None
    for cond, mult in bonus_rules:
        expr = (F.when(cond, amount * mult) if expr is None else expr.when(cond, amount * mult))
    return amount * base if expr is None else expr.otherwise(amount * base)
