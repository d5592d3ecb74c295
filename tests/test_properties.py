"""Properties that must hold on the real test tables, whatever the data."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SMALL), reason="test tables absent")


def test_pivoted_shares_sum_to_hundred(spark):
    q = entry.queries()
    for key, cols in [("platform_share_per_month", ["retail_percentage", "shopify_percentage"]),
                      ("demographic_share_per_year", ["couples_percentage", "families_percentage",
                                                      "unknown_percentage"])]:
        for r in q[key](spark, SMALL).collect():
            total = sum(r[c] or 0.0 for c in cols)
            assert abs(total - 100.0) <= 0.01 * len(cols), (key, r)


def test_running_balance_ends_at_total_contribution(spark):
    df = entry.queries()["monthly_running_balance"](spark, SMALL)
    per = df.groupBy("customer_id").agg(
        F.sum("balance_contribution").alias("total"),
        F.max_by("ending_balance", "month").alias("last"),
        F.count_if(F.col("balance_contribution") != 0).alias("active"))
    bad = per.filter((F.col("active") > 0) & (F.abs(F.col("total") - F.col("last")) > 1e-6)).count()
    assert bad == 0


def test_snapshot_counts_every_customer_started_by_the_date(spark):
    from tillroll.plans import subscriptions as subs
    q = entry.queries()
    snap_total = q["plan_snapshot_as_of"](spark, SMALL).agg(F.sum("customer_count")).first()[0]
    from tillroll.plans.registry import relation
    events = relation(spark, SMALL, "subscriptions")
    started = events.filter(F.col("start_date") <= subs._ts(subs.CUTOFF)).select("customer_id").distinct().count()
    assert snap_total == started
    shares = q["plan_snapshot_as_of"](spark, SMALL).agg(F.sum("percentage")).first()[0]
    assert abs(shares - 100.0) <= 0.05 * 5


def test_runs_partition_the_allocations(spark):
    """Sum of run durations equals the sum of all allocation durations."""
    from tillroll.plans import bank
    from tillroll.plans.registry import relation
    from tillroll.functions import sem
    nodes = relation(spark, SMALL, "customer_nodes")
    runs = bank._runs(nodes)
    total = nodes.agg(F.sum(sem.age_day_part("end_date", "start_date"))).first()[0]
    per_run = runs.groupBy("customer_id", "run_id").agg(F.sum("duration").alias("d"))
    assert per_run.agg(F.sum("d")).first()[0] == total
    # run ids are 1..n without gaps per customer
    gaps = (per_run.groupBy("customer_id").agg(F.max("run_id").alias("mx"), F.count(F.lit(1)).alias("n"))
            .filter(F.col("mx") != F.col("n")).count())
    assert gaps == 0
