"""Business-shaped relations derived from the given tables.

The operators are written against five small business schemas (loyalty,
bank, retail, subscriptions, delivery).  The test tables are a TPC-H-like
star plus an event stream, so each business relation is *derived* from them
here by a Spark plan; its size grows with the source tables.  Every binding
is also given as DuckDB SQL (``SQL``) so an independent engine can build the
same rows for the oracle check.

None of the bindings uses a window over an unbounded group: per-row values
come from the row itself (hashes, modular arithmetic) or from plain grouped
aggregates, so a hot customer does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sem import money
from .sinks import materialised, prepare
from .tables import Tables


def _list_text(k: Column, a: Column, b: Column) -> Column:
    """A list-of-ids text column with every spelling the cleaners handle:
    '' / 'null' / NULL / one id / two ids separated by ', '."""
    one = (1 + a % 12).cast("string")
    two = F.concat(one, F.lit(", "), (1 + b % 12).cast("string"))
    r = k % 5
    return (F.when(r == 0, F.lit(""))
            .when(r == 1, F.lit("null"))
            .when(r == 2, F.lit(None).cast("string"))
            .when(r == 3, one)
            .otherwise(two))


# ---------------------------------------------------------------- loyalty
def sales(t: Tables) -> DataFrame:
    li = t("lineitem").select("l_orderkey", "l_partkey")
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("customer_id"),
                    F.to_date("o_orderdate").alias("order_date"),
                    F.col("l_partkey").alias("product_id")))


def menu(t: Tables) -> DataFrame:
    return t("part").select(F.col("p_partkey").alias("product_id"),
                            F.col("p_type").alias("product_name"),
                            money("p_retailprice").alias("price"))


def members(t: Tables) -> DataFrame:
    return (t("orders").filter(F.col("o_orderpriority") == "1-URGENT")
            .groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(F.min(F.to_date("o_orderdate")).alias("join_date")))


# ------------------------------------------------------------------- bank
def _orders_with_region(t: Tables) -> DataFrame:
    o = t("orders")
    c = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t("nation").select("n_nationkey", "n_regionkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey")))


def customer_nodes(t: Tables) -> DataFrame:
    start = F.to_date("o_orderdate")
    return _orders_with_region(t).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("n_regionkey").alias("region_id"),
        F.col("o_orderpriority").alias("node_id"),
        F.col("o_orderkey").alias("seq"),
        start.alias("start_date"),
        F.date_add(start, (F.col("o_orderkey") % 61).cast("int")).alias("end_date"))


def regions(t: Tables) -> DataFrame:
    return t("region").select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))


def customer_transactions(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t("orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("txn_date"),
        F.when(status == "F", "deposit").when(status == "O", "purchase")
         .otherwise("withdrawal").alias("txn_type"),
        money("o_totalprice").alias("txn_amount"))


# ----------------------------------------------------------------- retail
def weekly_sales(t: Tables) -> DataFrame:
    r = t("region").select("r_regionkey", "r_name")
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    rows = _orders_with_region(t).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return (rows.groupBy(
                F.date_format(F.date_trunc("week", "o_orderdate"), "d/M/yy").alias("week_date"),
                F.col("r_name").alias("region"),
                F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Retail")
                 .otherwise("Shopify").alias("platform"),
                F.when(seg == "AUTOMOBILE", F.concat(F.lit("C"), (1 + key % 4).cast("string")))
                 .when(seg == "BUILDING", F.concat(F.lit("F"), (1 + key % 4).cast("string")))
                 .when(seg == "MACHINERY", F.lit(None).cast("string"))
                 .otherwise(F.lit("null")).alias("segment"),
                F.when(key % 3 == 0, "New").when(key % 3 == 1, "Existing")
                 .otherwise("Guest").alias("customer_type"))
            .agg(F.count(F.lit(1)).alias("transactions"),
                 F.sum(money("o_totalprice")).alias("sales")))


# ---------------------------------------------------------- subscriptions
def subscriptions(t: Tables) -> DataFrame:
    e = F.col("event_type")
    return t("events").select(
        F.col("user_id").alias("customer_id"),
        F.when(e == "signup", 0).when(e == "view", 1).when(e == "click", 2)
         .when(e == "purchase", 3).otherwise(4).alias("plan_id"),
        F.col("ts").alias("start_date"),
        F.col("event_id"))


# --------------------------------------------------------------- delivery
def runners(t: Tables) -> DataFrame:
    return (t("events").filter(F.col("event_type") == "signup")
            .groupBy(F.col("user_id").alias("runner_id"))
            .agg(F.min(F.to_date("ts")).alias("registration_date")))


_LINE_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_shipdate")


def customer_orders(t: Tables) -> DataFrame:
    """One row per ordered item.  ``item_id`` identifies the item inside its
    order (a 64-bit hash of the whole line, which is unique in lineitem)."""
    li = t("lineitem").select(*_LINE_COLS)
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    (1 + F.col("l_partkey") % 2).cast("int").alias("pizza_id"),
                    _list_text(F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey") + 3)
                    .alias("exclusions"),
                    _list_text(F.col("l_suppkey"), F.col("l_partkey") + 5, F.col("l_suppkey"))
                    .alias("extras"),
                    F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate"))
                    .alias("order_time"),
                    F.xxhash64(*_LINE_COLS).alias("item_id")))


def runner_orders(t: Tables) -> DataFrame:
    o = t("orders")
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    cancelled = status == "P"
    pickup = F.date_format(F.timestamp_add("MINUTE", key % 1440 + 10 + key % 97, F.col("o_orderdate")),
                           "yyyy-MM-dd HH:mm:ss")
    km_unit = F.when(cust % 3 == 0, "km").when(cust % 3 == 1, " km").otherwise("")
    min_unit = F.when(key % 3 == 0, " minutes").when(key % 3 == 1, "mins").otherwise("minute")
    distance = F.concat((5 + key % 100).cast("string"), F.lit("."), (cust % 10).cast("string"), km_unit)
    duration = F.concat((5 + cust % 50).cast("string"), min_unit)
    return o.select(
        key.alias("order_id"),
        (cust % 10).alias("runner_id"),
        F.when(cancelled, "null").otherwise(pickup).alias("pickup_time"),
        F.when(cancelled, "null").otherwise(distance).alias("distance"),
        F.when(cancelled, "null").otherwise(duration).alias("duration"),
        F.when(cancelled & (key % 2 == 0), "Restaurant Cancellation")
         .when(cancelled, "Customer Cancellation")
         .when(status == "O", "null")
         .when(key % 2 == 0, "").alias("cancellation"))


# ---------------------------------------------------------------------------
# Relations that cost a join or an aggregation: ``prepare`` writes them once per
# version of their sources, queries then read them.
BUILDERS = {
    "sales": (sales, ("lineitem", "orders")),
    "members": (members, ("orders",)),
    "customer_nodes": (customer_nodes, ("orders", "customer", "nation")),
    "weekly_sales": (weekly_sales, ("orders", "customer", "nation", "region")),
    "runners": (runners, ("events",)),
    "customer_orders": (customer_orders, ("lineitem", "orders")),
    "runner_orders": (runner_orders, ("orders",)),
}


def _code_version() -> str:
    """Hash of the code that derives and cleans the relations, so a changed
    derivation never reads a table written by an older one."""
    import hashlib
    import inspect
    import sys

    from ..functions import sem
    from ..operators import clean
    h = hashlib.sha256()
    for mod in (sys.modules[__name__], clean, sem):
        h.update(inspect.getsource(mod).encode())
    return h.hexdigest()[:12]


def _plan(t: Tables, name: str, transform):
    build, sources = BUILDERS[name]
    label = name if transform is None else f"{name}.{transform.__name__}"
    make = (lambda: build(t)) if transform is None else (lambda: transform(build(t)))
    return t.spark, f"{label}.{_CODE_VERSION}", [t.path(s) for s in sources], make


def table(t: Tables, name: str, transform=None) -> DataFrame:
    """The business relation ``name`` (optionally passed through a cleaning
    ``transform``): its prepared copy, or derived as part of the plan."""
    return materialised(*_plan(t, name, transform))


def prepare_table(t: Tables, name: str, transform=None) -> bool:
    """Write the copy that ``table`` reads; False if it is up to date."""
    return prepare(*_plan(t, name, transform))


# ---------------------------------------------------------------------------
# The same relations in DuckDB SQL, for the independent oracle.
def _list_sql(k: str, a: str, b: str) -> str:
    one = f"cast(1 + ({a}) % 12 as varchar)"
    return (f"case ({k}) % 5 when 0 then '' when 1 then 'null' when 2 then null "
            f"when 3 then {one} else concat({one}, ', ', cast(1 + ({b}) % 12 as varchar)) end")


_ORDERS_WITH_REGION_SQL = ("orders join customer on o_custkey = c_custkey "
                           "join nation on c_nationkey = n_nationkey")

SQL = {
    "sales": """select o_custkey customer_id, cast(o_orderdate as date) order_date, l_partkey product_id
        from lineitem join orders on l_orderkey = o_orderkey""",
    "menu": """select p_partkey product_id, p_type product_name,
        cast(p_retailprice as decimal(18,2)) price from part""",
    "members": """select o_custkey customer_id, min(cast(o_orderdate as date)) join_date
        from orders where o_orderpriority = '1-URGENT' group by o_custkey""",
    "customer_nodes": f"""select o_custkey customer_id, n_regionkey region_id, o_orderpriority node_id,
        o_orderkey seq, cast(o_orderdate as date) start_date,
        cast(o_orderdate as date) + cast(o_orderkey % 61 as integer) end_date
        from {_ORDERS_WITH_REGION_SQL}""",
    "regions": "select r_regionkey region_id, r_name region_name from region",
    "customer_transactions": """select o_custkey customer_id, cast(o_orderdate as date) txn_date,
        case o_orderstatus when 'F' then 'deposit' when 'O' then 'purchase' else 'withdrawal' end txn_type,
        cast(o_totalprice as decimal(18,2)) txn_amount from orders""",
    "weekly_sales": f"""select strftime(date_trunc('week', o_orderdate), '%-d/%-m/%y') week_date,
        r_name region,
        case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Retail' else 'Shopify' end platform,
        case c_mktsegment when 'AUTOMOBILE' then concat('C', cast(1 + c_custkey % 4 as varchar))
                          when 'BUILDING' then concat('F', cast(1 + c_custkey % 4 as varchar))
                          when 'MACHINERY' then null else 'null' end segment,
        case c_custkey % 3 when 0 then 'New' when 1 then 'Existing' else 'Guest' end customer_type,
        count(*) transactions, sum(cast(o_totalprice as decimal(18,2))) sales
        from {_ORDERS_WITH_REGION_SQL} join region on n_regionkey = r_regionkey
        group by 1, 2, 3, 4, 5""",
    "subscriptions": """select user_id customer_id,
        case event_type when 'signup' then 0 when 'view' then 1 when 'click' then 2
                        when 'purchase' then 3 else 4 end plan_id,
        ts start_date, event_id from events""",
    "runners": """select user_id runner_id, min(cast(ts as date)) registration_date
        from events where event_type = 'signup' group by user_id""",
    "customer_orders": f"""select l_orderkey order_id, o_custkey customer_id,
        cast(1 + l_partkey % 2 as integer) pizza_id,
        {_list_sql('l_linenumber', 'l_partkey', 'l_suppkey + 3')} exclusions,
        {_list_sql('l_suppkey', 'l_partkey + 5', 'l_suppkey')} extras,
        o_orderdate + to_minutes(cast(o_orderkey % 1440 as bigint)) order_time,
        row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) item_id
        from lineitem join orders on l_orderkey = o_orderkey""",
    "runner_orders": """select o_orderkey order_id, o_custkey % 10 runner_id,
        case when o_orderstatus = 'P' then 'null' else strftime(o_orderdate
            + to_minutes(cast(o_orderkey % 1440 + 10 + o_orderkey % 97 as bigint)), '%Y-%m-%d %H:%M:%S') end pickup_time,
        case when o_orderstatus = 'P' then 'null' else concat(cast(5 + o_orderkey % 100 as varchar), '.',
            cast(o_custkey % 10 as varchar),
            case o_custkey % 3 when 0 then 'km' when 1 then ' km' else '' end) end distance,
        case when o_orderstatus = 'P' then 'null' else concat(cast(5 + o_custkey % 50 as varchar),
            case o_orderkey % 3 when 0 then ' minutes' when 1 then 'mins' else 'minute' end) end duration,
        case when o_orderstatus = 'P' and o_orderkey % 2 = 0 then 'Restaurant Cancellation'
             when o_orderstatus = 'P' then 'Customer Cancellation'
             when o_orderstatus = 'O' then 'null'
             when o_orderkey % 2 = 0 then '' end cancellation
        from orders""",
}


_CODE_VERSION = _code_version()
