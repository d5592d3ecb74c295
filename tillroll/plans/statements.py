"""Statements that write: ratings stored once and joined later, and the cleaning of stored raw orders in place.

These keys write when called, as their subject is the write; every other query only reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, facts
from ..sources import schemas
from ..sources.store import StoredTable
from .delivery import CO, RO, delivery_fact
from .oracle import with_views
from .registry import ORACLE, statement

WRITE_ID = "ratings of all delivered orders"


def _insert_ratings(spark: SparkSession, place: str, runner_orders: DataFrame) -> StoredTable:
    """DROP TABLE IF EXISTS, CREATE TABLE, INSERT ... SELECT, the insert sent twice as a retried job would."""
    StoredTable(spark, place).drop()
    ratings = StoredTable.create(spark, place, schemas.RELATIONS["ratings"])
    for _ in range(2):
        ratings.append(facts.seeded_ratings(runner_orders), WRITE_ID)
    return ratings


@statement("insert_ratings", ORACLE["seeded_ratings"])
def insert_ratings(spark: SparkSession, place: str, runner_orders: DataFrame) -> DataFrame:
    """A stored rating per delivered order; an insert done twice counts once."""
    return _insert_ratings(spark, place, runner_orders).read()


@statement("delivery_fact_stored", ORACLE["delivery_fact"])
def delivery_fact_stored(spark: SparkSession, place: str, customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """The delivery fact joined with the stored ratings table."""
    return delivery_fact(customer_orders, runner_orders, _insert_ratings(spark, place, runner_orders).read())


def missing(c: str):
    """Text that stands for no value: '', 'null' or NULL."""
    return F.col(c).isNull() | F.col(c).isin("", "null")


def clean_stored_customer_orders(orders: StoredTable) -> list[str]:
    """UPDATE extras and exclusions of a stored table of raw items; the folders rewritten."""
    return orders.update(*[(missing(c), {c: F.lit("none")}) for c in ("extras", "exclusions")])


def clean_stored_runner_orders(orders: StoredTable) -> list[str]:
    """UPDATE cancellation, pickup time and the two measures of a stored table of raw deliveries; the folders rewritten."""
    codes = [(F.col("cancellation") == raw, {"cancellation": F.lit(code)}) for raw, code in clean.CANCELLATION_CODES.items()]
    measures = [(F.col(c) != "n/a", {c: F.regexp_substr(F.col(c), F.lit(clean.MEASURE_PATTERN))}) for c in ("distance", "duration")]
    return orders.update(*codes, (missing("cancellation"), {"cancellation": F.lit("n/a")}),
                         (F.col("pickup_time") == "null", {"pickup_time": F.lit("n/a")}), *measures)


def _stored(spark: SparkSession, place: str, rows: DataFrame, partition_by: str) -> StoredTable:
    StoredTable(spark, place).drop()
    t = StoredTable.create(spark, place, rows.schema, partition_by)
    t.append(rows, "raw")
    return t


@statement("update_customer_orders", with_views(
    f"select order_id, customer_id, pizza_id, exclusions, extras, order_time from {CO}", CO))
def update_customer_orders(spark: SparkSession, place: str, raw_customer_orders: DataFrame) -> DataFrame:
    """Items stored raw, then cleaned in place."""
    t = _stored(spark, place, raw_customer_orders, "pizza_id")
    clean_stored_customer_orders(t)
    return t.read().drop("item_id")


@statement("update_runner_orders", with_views(
    f"select order_id, runner_id, pickup_time, distance, duration, cancellation from {RO}", RO))
def update_runner_orders(spark: SparkSession, place: str, raw_runner_orders: DataFrame) -> DataFrame:
    """Deliveries stored raw, then cleaned in place."""
    t = _stored(spark, place, raw_runner_orders, "runner_id")
    clean_stored_runner_orders(t)
    return t.read()
