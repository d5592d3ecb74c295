"""Independent SQL for the oracle check (DuckDB dialect).

Each query's SQL is written against the business relations; ``with_views``
prepends the relations it names (and what they depend on) as CTEs built from
the raw test tables, so the SQL runs on a DuckDB connection that has only the
raw tables registered.
"""

from __future__ import annotations

from ..sources import dims
from ..sources.bindings import SQL as BINDING_SQL

DIM_SQL = {
    "plans": dims.values_sql(dims.PLANS, "plan_id, plan_name"),
    "pizza_names": dims.values_sql(dims.PIZZA_NAMES, "pizza_id, pizza_name"),
    "pizza_recipes": dims.values_sql(dims.PIZZA_RECIPES, "pizza_id, toppings"),
    "pizza_toppings": dims.values_sql(dims.PIZZA_TOPPINGS, "topping_id, topping_name"),
}

# Cleaned relations, written independently of the Spark cleaners.
DERIVED_SQL = {
    "clean_customer_orders": (("customer_orders",), """select order_id, customer_id, pizza_id,
        case when exclusions is null or exclusions in ('', 'null') then 'none' else exclusions end exclusions,
        case when extras is null or extras in ('', 'null') then 'none' else extras end extras,
        order_time, item_id from customer_orders"""),
    "clean_runner_orders": (("runner_orders",), """select order_id, runner_id,
        case when pickup_time = 'null' then 'n/a' else pickup_time end pickup_time,
        case when distance = 'n/a' then 'n/a'
             else nullif(regexp_extract(distance, '[0-9]+(\\.[0-9]+)?', 0), '') end distance,
        case when duration = 'n/a' then 'n/a'
             else nullif(regexp_extract(duration, '[0-9]+(\\.[0-9]+)?', 0), '') end duration,
        case when cancellation = 'Restaurant Cancellation' then 'restaurant'
             when cancellation = 'Customer Cancellation' then 'customer'
             when cancellation is null or cancellation in ('null', '') then 'n/a'
             else cancellation end cancellation
        from runner_orders"""),
    "clean_weekly_sales": (("weekly_sales",), """select
        d week_date, cast(date_part('week', d) as bigint) week_number,
        cast(date_part('month', d) as bigint) month_number,
        cast(date_part('year', d) as bigint) calendar_year,
        region, platform,
        case when segment = 'null' then 'Unknown' else segment end segment,
        case when right(segment, 1) = '1' then 'Young Adults'
             when right(segment, 1) = '2' then 'Middle Aged'
             when right(segment, 1) in ('3', '4') then 'Retirees' else 'Unknown' end age_band,
        case when left(segment, 1) = 'C' then 'Couples'
             when left(segment, 1) = 'F' then 'Families' else 'Unknown' end demographic,
        customer_type, transactions, sales
        from (select *, cast(strptime(week_date, '%d/%m/%y') as date) d from weekly_sales)"""),
}


def _resolve(names, out):
    for n in names:
        if n in out:
            continue
        if n in DERIVED_SQL:
            _resolve(DERIVED_SQL[n][0], out)
            out[n] = DERIVED_SQL[n][1]
        elif n in BINDING_SQL:
            out[n] = BINDING_SQL[n]
        elif n in DIM_SQL:
            out[n] = DIM_SQL[n]
        else:
            raise KeyError(n)
    return out


def with_views(body: str, *names: str) -> str:
    """``WITH <views named> <body>``; ``body`` may start with its own WITH."""
    views = _resolve(names, {})
    ctes = ",\n".join(f"{n} AS ({sql})" for n, sql in views.items())
    body = body.strip()
    if body[:15].lower() == "with recursive ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].lower() == "with ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def round_ratio_sql(num: str, den: str, digits: int, num_scale: int = 0, den_scale: int = 0) -> str:
    """Exact half-away-from-zero ``round(num/den, digits)`` as a DOUBLE, with
    integer arithmetic on HUGEINT (no float intermediate)."""
    n = f"cast(({num}) * {10 ** num_scale} as hugeint)"
    d = f"cast(({den}) * {10 ** den_scale} as hugeint)"
    top = f"abs({n}) * {10 ** (den_scale + digits)}"
    bottom = f"abs({d}) * {10 ** num_scale}"
    q = f"((2 * {top} + {bottom}) // (2 * {bottom})) * sign({n}) * sign({d})"
    expr = f"case when {d} = 0 then null else cast({q} as double) end"
    return expr if digits == 0 else f"({expr}) / {float(10 ** digits)}"
