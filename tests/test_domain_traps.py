"""Trap rows of the business schemas (hand-computed answers)."""

import datetime as dt
from decimal import Decimal

from tillroll.plans import bank, retail, subscriptions

D = dt.date
T = dt.datetime


def test_runs_region_carry_and_age_borrow(spark):
    nodes = spark.createDataFrame([
        # customer 1: A, A (same run, region changes), B, back to A (new run)
        (1, 1, "A", 1, D(2020, 1, 1), D(2020, 1, 6)),     # 5
        (1, 2, "A", 2, D(2020, 1, 6), D(2020, 1, 10)),    # 4
        (1, 2, "B", 3, D(2020, 1, 10), D(2020, 2, 1)),    # age day field: 1 - 10 + 31 = 22
        (1, 2, "A", 4, D(2020, 2, 1), D(2020, 2, 3)),     # 2
        # customer 2: equal start dates (ordered by seq), month-end borrow
        (2, 2, "C", 6, D(2020, 1, 31), D(2020, 2, 29)),   # 29 - 31 + 31 = 29
        (2, 2, "C", 5, D(2020, 1, 31), D(2020, 3, 1)),    # 1 - 31 + 31 = 1
    ], "customer_id long, region_id int, node_id string, seq long, start_date date, end_date date")
    regions = spark.createDataFrame([(1, "R1"), (2, "R2")], "region_id int, region_name string")
    # runs: 9 (region 1), 22 (region 1), 2 (region 1), 30 (region 2) -> mean 15.75 -> 16
    assert bank.avg_run_duration(nodes).first()[0] == 16
    got = {r.region_name: (r.median, r.pct80, r.pct95) for r in bank.run_duration_percentiles(nodes, regions).collect()}
    # region 1 values [2, 9, 22]: p80 = 9 + 0.6 * 13 = 16.8 -> 17; p95 = 20.7 -> 21
    assert got == {"R1": (9.0, 17.0, 21.0), "R2": (30.0, 30.0, 30.0)}
    # each run's own region instead of the carried one: R1 [9], R2 [2, 22, 30]
    own = {r.region_name: (r.median, r.pct80, r.pct95)
           for r in bank.run_duration_percentiles(nodes, regions, region_of="run").collect()}
    assert own == {"R1": (9.0, 9.0, 9.0), "R2": (22.0, 27.0, 29.0)}
    approx = {r.region_name: r.median for r in bank.run_duration_percentiles(nodes, regions, approx=True).collect()}
    assert approx == {"R1": 9.0, "R2": 30.0}


def test_running_balance_is_null_before_first_activity(spark):
    tx = spark.createDataFrame([
        (1, D(2020, 2, 10), "deposit", Decimal("100.00")),
        (1, D(2020, 3, 5), "purchase", Decimal("30.00")),
        (2, D(2020, 1, 15), "withdrawal", Decimal("50.00")),
    ], "customer_id long, txn_date date, txn_type string, txn_amount decimal(18,2)")
    got = {(r.customer_id, r.month.month): (r.balance_contribution, r.ending_balance)
           for r in bank.monthly_running_balance(tx, first_month=D(2020, 1, 1), months=3).collect()}
    assert got == {(1, 1): (0.0, None), (1, 2): (100.0, 100.0), (1, 3): (-30.0, 70.0),
                   (2, 1): (-50.0, -50.0), (2, 2): (0.0, -50.0), (2, 3): (0.0, -50.0)}


def test_weekly_cleaning_traps(spark):
    raw = spark.createDataFrame([
        ("31/12/95", "ASIA", "Retail", "C3", "New", 3, Decimal("10.00")),
        ("1/1/99", "ASIA", "Retail", "null", "New", 2, Decimal("10.01")),    # ISO week 53 of 1998
        ("5/1/01", "ASIA", "Shopify", None, "Guest", 4, Decimal("1.00")),
    ], "week_date string, region string, platform string, segment string, customer_type string, "
       "transactions long, sales decimal(18,2)")
    got = {r.week_date: r for r in retail.clean_weekly_sales(raw).collect()}
    a, b, c = got[D(1995, 12, 31)], got[D(1999, 1, 1)], got[D(2001, 1, 5)]
    assert (a.week_number, a.month_number, a.calendar_year) == (52, 12, 1995)
    assert (a.segment, a.age_band, a.demographic, a.avg_transaction) == ("C3", "Retirees", "Couples", 3.33)
    assert b.week_number == 53 and b.calendar_year == 1999
    assert (b.segment, b.age_band, b.demographic, b.avg_transaction) == ("Unknown", "Unknown", "Unknown", 5.01)
    assert (c.segment, c.age_band, c.demographic, c.avg_transaction) == (None, "Unknown", "Unknown", 0.25)


def test_snapshot_and_transitions(spark):
    subs = spark.createDataFrame([
        (1, 0, T(2024, 1, 1), 1), (1, 3, T(2024, 1, 15), 2),          # change exactly on the cut-off
        (2, 0, T(2024, 1, 10), 3), (2, 4, T(2024, 1, 20), 4),          # trial -> churn after it
        (3, 1, T(2024, 1, 16), 5),                                      # starts after the cut-off
        (4, 0, T(2024, 1, 2), 6), (4, 2, T(2024, 1, 2, 5), 7), (4, 1, T(2024, 1, 3), 8),  # pro -> basic
    ], "customer_id long, plan_id int, start_date timestamp_ntz, event_id long")
    plans = spark.createDataFrame([(0, "trial"), (1, "basic monthly"), (2, "pro monthly"), (3, "pro annual"),
                                   (4, "churn")], "plan_id int, plan_name string")
    snap = {r.plan_name: (r.customer_count, r.percentage)
            for r in subscriptions.plan_snapshot_as_of(subs, plans, at=T(2024, 1, 15)).collect()}
    assert snap == {"pro annual": (1, 33.3), "trial": (1, 33.3), "basic monthly": (1, 33.3)}
    nxt = {r.plan_name: (r.count_plan, r.percentage) for r in subscriptions.next_plan_after_trial(subs, plans).collect()}
    assert nxt == {"pro annual": (1, 33.0), "churn": (1, 33.0), "pro monthly": (1, 33.0)}
    assert subscriptions.downgrades_in_year(subs, year=2024).first()[0] == 1
    assert subscriptions.upgrades_in_year(subs, year=2024).first()[0] == 1
