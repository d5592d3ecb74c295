"""Declared schemas: what every table must look like, checked before any job runs.

``read`` compares the declared fields with the Parquet footer and hands the
declared schema to the reader, so a column of another type, or a missing one,
fails by name when a query is built and not inside a task.  Further columns
of a file are allowed; they are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.types import StructType


class SchemaMismatch(ValueError):
    """A table, its column, and the declared and found types."""

    def __init__(self, table: str, column: str, declared: str, found: str | None):
        self.table, self.column, self.declared, self.found = table, column, declared, found
        what = "is missing" if found is None else f"has type {found}"
        super().__init__(f"table {table}: column {column} {what}, declared {declared}")


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
          "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType()}


def _type(name: str) -> T.DataType:
    digits = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    return T.DecimalType(*map(int, digits.groups())) if digits else _TYPES[name]


def _schema(columns: str) -> StructType:
    """``name type, name type`` (read here: a schema needs no session)."""
    return StructType([T.StructField(*(f(x) for f, x in zip((str, _type), c.split()))) for c in columns.split(", ")])


# The given tables.
TABLES = {name: _schema(ddl) for name, ddl in {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}.items()}

# The business relations (what a user's own tables must offer).
RELATIONS = {name: _schema(ddl) for name, ddl in {
    "sales": "customer_id bigint, order_date date, product_id bigint",
    "menu": "product_id bigint, product_name string, price decimal(18,2)",
    "members": "customer_id bigint, join_date date",
    "customer_nodes": "customer_id bigint, region_id int, node_id string, seq bigint, start_date date, end_date date",
    "regions": "region_id int, region_name string",
    "customer_transactions": "customer_id bigint, txn_date date, txn_type string, txn_amount decimal(18,2)",
    "weekly_sales": "week_date string, region string, platform string, segment string, customer_type string, "
                    "transactions bigint, sales decimal(28,2)",
    "subscriptions": "customer_id bigint, plan_id int, start_date timestamp_ntz, event_id bigint",
    "plans": "plan_id int, plan_name string",
    "runners": "runner_id bigint, registration_date date",
    "customer_orders": "order_id bigint, customer_id bigint, pizza_id int, exclusions string, extras string, "
                       "order_time timestamp_ntz, item_id bigint",
    "runner_orders": "order_id bigint, runner_id bigint, pickup_time string, distance string, duration string, "
                     "cancellation string",
    "pizza_names": "pizza_id int, pizza_name string",
    "pizza_recipes": "pizza_id int, toppings string",
    "pizza_toppings": "topping_id int, topping_name string",
    "ratings": "order_id bigint, rating bigint",
}.items()}


def check(table: str, declared: StructType, found: StructType) -> None:
    """Raise ``SchemaMismatch`` for the first declared field that ``found`` lacks or has with another type."""
    have = {f.name: f.dataType for f in found.fields}
    for f in declared.fields:
        kind = have.get(f.name)
        if kind is None or kind != f.dataType:
            raise SchemaMismatch(table, f.name, f.dataType.simpleString(), None if kind is None else kind.simpleString())


def read(spark: SparkSession, table: str, path: str, declared: StructType | None = None) -> DataFrame:
    """The Parquet table at ``path`` under its declared schema."""
    declared = TABLES[table] if declared is None else declared
    check(table, declared, spark.read.parquet(path).schema)   # the footer
    return spark.read.schema(declared).parquet(path)


def conform(table: str, df: DataFrame, declared: StructType | None = None) -> DataFrame:
    """``df`` with exactly the declared columns, checked when the plan is made."""
    declared = RELATIONS[table] if declared is None else declared
    check(table, declared, df.schema)
    return df.select(*declared.names)
