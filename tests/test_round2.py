"""Sums per run, the whole calendar, ranks of some rows, and business parameters."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators import ranking, sequence
from tillroll.plans import bank, delivery, subscriptions

D = dt.date


def _walk(rows):
    """(key, first id, sum) per run; a NULL on either side continues the run."""
    out, last = [], {}
    for k, x, i, v, m in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if k not in last or (last[k] is not None and v is not None and last[k] != v):
            out.append([k, i, 0])
        out[-1][2] += m
        last[k] = v
    return sorted(map(tuple, out), key=str)


def test_run_totals_match_a_row_walk(spark):
    rnd = random.Random(5)
    for spread in (3, 30):
        rows = [(rnd.choice([1, 2, None]), rnd.randrange(spread), i, rnd.choice(["a", "b", None]), rnd.randrange(9))
                for i in range(200)]
        df = spark.createDataFrame(rows, "k long, x int, id int, v string, m long")
        for size in (None, 4, 16):
            got = sequence.run_totals(df, "k", ["x", "id"], "v", "m", "total", carry=["id"], rows=size)
            assert sorted(((r.k, r.id, r.total) for r in got.collect()), key=str) == _walk(rows)


def test_run_totals_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k long, x int, v string, m long")
    assert sequence.run_totals(df, "k", ["x"], "v", "m", "total", rows=1).collect() == []


def test_rank_of_some_rows(spark):
    df = spark.createDataFrame([(1, 3, "Y"), (1, 2, "N"), (1, 3, "Y"), (1, 5, "Y"), (None, 1, "Y"), (1, None, "Y")],
                               "k int, d int, f string")
    got = {(r.k, r.d, r.f, r["rank"]) for r in ranking.rank_within(df, "k", "d", where=F.col("f") == "Y").collect()}
    assert got == {(1, 3, "Y", 1), (1, 5, "Y", 3), (1, None, "Y", 4), (1, 2, "N", None), (None, 1, "Y", 1)}


def test_running_balance_covers_every_month_of_the_data(spark):
    tx = spark.createDataFrame([(1, D(2019, 11, 30), "deposit", Decimal("5.00")),
                                (2, D(2020, 2, 1), "purchase", Decimal("2.00"))],
                               "customer_id long, txn_date date, txn_type string, txn_amount decimal(18,2)")
    got = sorted((r.customer_id, r.month, r.balance_contribution, r.ending_balance)
                 for r in bank.monthly_running_balance(tx).where("customer_id = 1").collect())
    assert got == [(1, D(2019, 11, 1), 5.0, 5.0), (1, D(2019, 12, 1), 0.0, 5.0), (1, D(2020, 1, 1), 0.0, 5.0),
                   (1, D(2020, 2, 1), 0.0, 5.0)]
    assert bank.monthly_running_balance(tx).count() == 8
    assert bank.monthly_running_balance(tx.limit(0)).count() == 0


def test_plan_ids_and_prices_are_parameters(spark):
    ev = spark.createDataFrame([(1, 7, dt.datetime(2024, 1, 1), 1), (1, 9, dt.datetime(2024, 1, 2), 2)],
                               "customer_id long, plan_id int, start_date timestamp_ntz, event_id long")
    assert subscriptions.churn_rate(ev, churn_plan=9).first().churn_count == 1
    assert subscriptions.churn_as_second_event(ev, churn_plan=9).first().churn_customers == 1
    assert subscriptions.upgrades_in_year(ev, to_plan=9).first()[0] == 1
    assert subscriptions.downgrades_in_year(ev, from_plan=7, to_plan=9).first()[0] == 1
    plans = spark.createDataFrame([(7, "free"), (9, "paid")], "plan_id int, plan_name string")
    assert subscriptions.next_plan_after_trial(ev, plans, after_plan="free").first().plan_name == "paid"
    items = spark.createDataFrame([(1,), (2,)], "pizza_id int")
    assert delivery.fixed_price_revenue(items, prices={1: 20}, default_price=3).first().revenue == 23


def test_stored_ratings_meet_the_delivery_fact(spark):
    items = spark.createDataFrame([(1, 5, dt.datetime(2020, 1, 1)), (2, 5, dt.datetime(2020, 1, 1))],
                                  "order_id long, customer_id long, order_time timestamp_ntz")
    runs = spark.createDataFrame([(i, 3, "2020-01-01 00:10:00", "10", "20", "n/a") for i in (1, 2)],
                                 "order_id long, runner_id long, pickup_time string, distance string, duration string, "
                                 "cancellation string")
    stored = spark.createDataFrame([(1, 4)], "order_id long, rating long")
    got = {r.order_id: r.rating for r in delivery.delivery_fact(items, runs, ratings=stored).collect()}
    assert got == {1: 4, 2: None}
