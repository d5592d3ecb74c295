"""Registry of named queries.

Every business query is a plain function of business relations (DataFrames
named like the parameters: ``sales``, ``menu``, ``members``, ...).  The
registry binds those parameters to relations derived from a folder of test
tables, giving the ``(spark, root) -> DataFrame`` callables of the driver
contract, and keeps the independent oracle SQL of each key.
"""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean
from ..session import checkpoint_dir
from ..sources import bindings as b
from ..sources import dims, schemas
from ..sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, Callable[..., DataFrame]] = {}


# Relations with a prepared copy -> (binding, cleaner).
PREPARED = {
    "sales": ("sales", None),
    "members": ("members", None),
    "customer_nodes": ("customer_nodes", None),
    "weekly_sales": ("weekly_sales", None),
    "clean_weekly_sales": ("weekly_sales", clean.clean_weekly_sales),
    "runners": ("runners", None),
    "raw_customer_orders": ("customer_orders", None),
    "customer_orders": ("customer_orders", clean.clean_customer_orders),
    "raw_runner_orders": ("runner_orders", None),
    "runner_orders": ("runner_orders", clean.clean_runner_orders),
}


def prepare(spark: SparkSession, root: str) -> list[str]:
    """Write the shared copies of the relations that queries over ``root`` read; the names that were not up to date.

    Optional: queries give the same results without it, each deriving what it reads.
    """
    t = Tables(spark, root)
    return [name for name, (binding, cleaner) in PREPARED.items() if b.prepare_table(t, binding, cleaner)]


def relation(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The business relation ``name`` derived from the tables under ``root``, with its declared columns."""
    t = Tables(spark, root)
    loaders = {
        "menu": lambda: b.menu(t),
        "regions": lambda: b.regions(t),
        "customer_transactions": lambda: b.customer_transactions(t),
        "subscriptions": lambda: b.subscriptions(t),
        "plans": lambda: dims.plans(spark),
        "pizza_names": lambda: dims.pizza_names(spark),
        "pizza_recipes": lambda: dims.pizza_recipes(spark),
        "pizza_toppings": lambda: dims.pizza_toppings(spark),
    }
    df = b.table(t, *PREPARED[name]) if name in PREPARED else loaders[name]()
    schema = name.removeprefix("raw_")
    if schema in schemas.RELATIONS:
        schemas.check(name, schemas.RELATIONS[schema], df.schema)
    return df


def query(key: str, oracle: str | None = None):
    """Register ``fn(<relations>)`` under ``key``: its parameters name the
    business relations it reads (``spark`` receives the session)."""
    def deco(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        # parameters without a default name relations; defaults are business
        # parameters (thresholds, dates, item names) a caller may override
        params = [n for n, p in inspect.signature(fn).parameters.items() if p.default is inspect.Parameter.empty]

        def bound(spark: SparkSession, root: str) -> DataFrame:
            args = {p: spark if p == "spark" else relation(spark, root, p) for p in params}
            return fn(**args)
        bound.__name__ = bound.__qualname__ = f"{key}_on_tables"
        bound.__doc__ = fn.__doc__
        QUERIES[key] = bound
        OPERATORS[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def statement(key: str, oracle: str):
    """Register ``fn(<relations>, place)`` whose subject is a statement that writes (INSERT, UPDATE): ``place`` is
    a folder of its own under the shared folder, the same on every call."""
    def deco(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        params = [n for n in inspect.signature(fn).parameters if n not in ("spark", "place")]

        def bound(spark: SparkSession, root: str) -> DataFrame:
            of = hashlib.sha256(root.encode()).hexdigest()[:12]
            place = f"{checkpoint_dir(spark).rstrip('/')}/tillroll-stored/{spark.sparkContext.applicationId}/{key}-{of}"
            return fn(spark=spark, place=place, **{p: relation(spark, root, p) for p in params})
        bound.__name__ = bound.__qualname__ = f"{key}_on_tables"
        bound.__doc__ = fn.__doc__
        QUERIES[key], OPERATORS[key], ORACLE[key] = bound, fn, oracle
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register themselves."""
    from . import bank, delivery, loyalty, retail, statements, subscriptions  # noqa: F401
