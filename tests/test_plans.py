"""Plan-shape guards: properties of the physical plans the scale design
relies on (checked on the plan, without running the queries)."""

import os
import re

import pytest

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(ROOT), reason="test tables absent")


@pytest.fixture(scope="module")
def plan(spark):
    """Static physical plan text of a registered query, shaped as for a large
    input: no runtime re-planning, no size-based broadcast."""
    from tillroll.plans.registry import prepare
    qs = entry.queries()
    prepare(spark, ROOT)

    def get(key):
        old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            text = qs[key](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
            return re.sub(r"#\d+L?", "", text)          # drop expression ids
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
    return get


def test_filters_reach_the_scan(plan):
    assert "GreaterThan(ts,2024-01-15T00:00)" in plan("plan_events_after_date")
    assert "EqualTo(cancellation,n/a)" in plan("successful_orders_per_runner")
    p = plan("before_after_change")
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(week_date," in p


def test_scans_read_only_used_columns(plan):
    p = plan("txn_totals_by_type")
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in p


def test_per_item_lists_do_not_shuffle(plan):
    for key in ("order_ingredient_list", "order_item_label"):
        p = plan(key)
        assert "Exchange hashpartitioning" not in p, key
        assert "BroadcastHashJoin" in p, key          # only the fixed dimensions meet the items


def test_first_and_last_items_need_no_window(plan):
    for key in ("first_item_per_customer", "first_item_after_joining", "last_item_before_joining"):
        p = plan(key)
        assert "Window" not in p and "LeftSemi" in p, key
    assert "WindowGroupLimit" in plan("churn_as_second_event")


def test_snapshot_has_no_window_per_customer(plan):
    # the snapshot's only window is the share over the (at most 5) plan rows
    assert "windowspecdefinition(customer_id" not in plan("plan_snapshot_as_of")


def test_hot_customers_are_cut_into_buckets(plan, monkeypatch):
    """When a sample finds keys with many rows, windows over raw rows are keyed by
    (customer, bucket); those keyed by the customer alone run over carry rows, which are broadcast."""
    from tillroll.operators import sequence
    monkeypatch.setattr(sequence, "BUCKET_ROWS", 16)
    for key in ("avg_run_duration", "next_plan_after_trial", "downgrades_in_year", "member_order_ranking"):
        p = plan(key)
        whole = re.findall(r"windowspecdefinition\(customer_id, ([^)]*)\)", p)
        assert any(w.startswith("_") for w in whole) and "BroadcastHashJoin" in p, key
        assert f"hashpartitioning(customer_id, {'_ranked, ' if key == 'member_order_ranking' else ''}_bucket" in p, key


def test_member_orders_are_sorted_once_by_customer(plan):
    """The join with the members sorts nothing: the window's sort is the only one that a task holds its orders in."""
    p = plan("member_order_ranking")
    assert "ShuffledHashJoin" in p and len(re.findall(r"Sort \[customer_id", p)) == 1


def test_sequences_read_their_input_once(plan):
    for key in ("avg_run_duration", "next_plan_after_trial", "downgrades_in_year"):
        assert plan(key).count("FileScan") == 1, key


def test_top_one_is_take_ordered(plan):
    for key in ("top_item", "largest_delivered_order"):
        assert "TakeOrderedAndProject" in plan(key), key


def test_fixed_dimensions_are_broadcast(plan):
    for key in ("plan_events_after_date", "delivered_per_type"):
        assert "BroadcastExchange" in plan(key), key
