"""Delivery facts: delivered items, pickup delays, speeds, ratings, revenue.

Revenue and fees are aggregated at the *order* grain before totals, so a
per-order fee is counted once however many items the order has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sem

DELIVERED = "n/a"          # cancellation value of a delivered order after cleaning


def delivered_orders(runner_orders: DataFrame) -> DataFrame:
    return runner_orders.filter(F.col("cancellation") == DELIVERED)


def only_delivered(items: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Items whose order was delivered (``EXISTS`` -> left semi join)."""
    return items.join(delivered_orders(runner_orders).select("order_id"), "order_id", "left_semi")


def pickup_ts(c: str | Column = "pickup_time") -> Column:
    """Pickup text (``yyyy-MM-dd HH:mm:ss``) as a zone-less timestamp, read
    directly (independent of the session time zone); NULL for ``n/a``."""
    return sem.col(c).try_cast("timestamp_ntz")


def pickup_minutes(pickup: str | Column = "pickup_time", ordered: str | Column = "order_time") -> Column:
    """Minute field of ``age(pickup, order_time)`` as an integer."""
    return sem.age_minute_part(pickup_ts(pickup), sem.col(ordered)).cast("long")


def measure(c: str | Column, scale: int = 1) -> Column:
    """Cleaned numeric text (``'15.3'``) as an exact decimal."""
    return sem.col(c).try_cast(f"decimal(18,{scale})")


def unit_price(pizza_col: str = "pizza_id", prices: dict[int, int] | None = None, default: int = 10) -> Column:
    prices = prices or {1: 12}
    expr = None
    for k, v in prices.items():
        expr = F.when(F.col(pizza_col) == k, v) if expr is None else expr.when(F.col(pizza_col) == k, v)
    return expr.otherwise(default)


def order_grain(items: DataFrame) -> DataFrame:
    """One row per (order, customer, order time) with the order's item count
    (``count(*) over (partition by order_id)``) -- an aggregate, then a window
    over the few attribute combinations of one order."""
    per = items.groupBy("order_id", "customer_id", "order_time").agg(F.count(F.lit(1)).alias("_n"))
    return per.withColumn("pizza_count", F.sum("_n").over(Window.partitionBy("order_id"))).drop("_n")


RATING_SEED = 1


def seeded_ratings(runner_orders: DataFrame, seed: int = RATING_SEED, scale: int = 5) -> DataFrame:
    """A rating 1..scale per delivered order, a deterministic draw per order
    id (the same on every run and partitioning)."""
    return delivered_orders(runner_orders).select(
        "order_id", sem.seeded_unit_draw("order_id", seed, scale).alias("rating"))


def with_rating(delivered: DataFrame, seed: int = RATING_SEED, scale: int = 5) -> DataFrame:
    """Delivered orders with their ``rating`` column (same draw as ``seeded_ratings``)."""
    return delivered.withColumn("rating", sem.seeded_unit_draw("order_id", seed, scale))


def rating_sql(key: str, seed: int = RATING_SEED, scale: int = 5) -> str:
    """The same draw in SQL (integer arithmetic only)."""
    m = 2147483648
    h1 = f"((({key}) % {m}) * 1103515245 + 12345 + {seed}) % {m}"
    h2 = f"xor({h1}, ({h1}) >> 13)"
    h3 = f"(({h2}) * 1103515245 + 12345) % {m}"
    return f"(1 + ((({h3}) * {scale}) >> 31))"
