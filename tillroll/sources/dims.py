"""Small fixed dimensions of the business schemas.

The test tables have no source for these, so they are declared here.  Their
size is fixed by construction (a handful of rows), which is what licenses
``broadcast`` on them: the bound is proven, not guessed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: plan, pizza and topping names of the business schemas (recipes and topping names are our own choice) ---
# Subscription plans: id, name.
PLANS = [
    (0, "trial"),
    (1, "basic monthly"),
    (2, "pro monthly"),
    (3, "pro annual"),
    (4, "churn"),
]
# Pizza types: id, name.
PIZZA_NAMES = [
    (1, "Meatlovers"),
    (2, "Vegetarian"),
]
# Standard recipe per pizza type: id, comma-separated topping ids.
PIZZA_RECIPES = [
    (1, "1, 2, 3, 4, 5, 6, 8, 10"),
    (2, "4, 6, 7, 9, 11, 12"),
]
# Toppings: id, name.
PIZZA_TOPPINGS = [
    (1, "Bacon"),
    (2, "BBQ Sauce"),
    (3, "Beef"),
    (4, "Cheese"),
    (5, "Chicken"),
    (6, "Mushrooms"),
    (7, "Onions"),
    (8, "Pepperoni"),
    (9, "Peppers"),
    (10, "Salami"),
    (11, "Tomatoes"),
    (12, "Tomato Sauce"),
]
# ---------------------------------------------------------------------------

def fixed_dim(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal dimension as an inline table (a JVM-side local relation, no
    Python worker), broadcast because its few rows are written here."""
    fields = [f.strip().split() for f in schema.split(",")]
    names = ", ".join(n for n, _ in fields)
    casts = ", ".join(f"cast({n} as {t}) as {n}" for n, t in fields)
    df = spark.sql(f"SELECT {casts} FROM {values_sql(rows, names)}")
    return F.broadcast(df)


def plans(spark: SparkSession) -> DataFrame:
    return fixed_dim(spark, PLANS, "plan_id int, plan_name string")


def pizza_names(spark: SparkSession) -> DataFrame:
    return fixed_dim(spark, PIZZA_NAMES, "pizza_id int, pizza_name string")


def pizza_recipes(spark: SparkSession) -> DataFrame:
    return fixed_dim(spark, PIZZA_RECIPES, "pizza_id int, toppings string")


def pizza_toppings(spark: SparkSession) -> DataFrame:
    return fixed_dim(spark, PIZZA_TOPPINGS, "topping_id int, topping_name string")


def values_sql(rows: list[tuple], columns: str) -> str:
    """The same dimension as a SQL ``VALUES`` relation (for the oracle)."""
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({columns}))"
