"""Operators against brute force on small fixtures, including a hot key that
holds a large share of the rows."""

import datetime as dt
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tillroll.operators import lifecycle, lists, quantiles, ranking, sequence, spine
from tillroll.sources import dims

from helpers import rows


def _sequence_rows(seed=3, n=600):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randrange(1, 15)      # key 0 is hot
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(0, 20))
        out.append((key, day, i, rnd.choice("ABC")))
    return out


def _brute_runs(data):
    by_key = {}
    for key, day, seq, val in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        by_key.setdefault(key, []).append((seq, val))
    run_of, prev_of = {}, {}
    for key, items in by_key.items():
        run, prev = 0, None
        for j, (seq, val) in enumerate(items):
            if j == 0 or val != prev:
                run += 1
            run_of[seq] = run
            prev_of[seq] = prev if j else None
            prev = val
    return run_of, prev_of


def test_islands_and_previous_value_match_row_walk(spark):
    data = _sequence_rows()
    df = spark.createDataFrame(data, "k long, d date, seq long, v string")
    run_of, prev_of = _brute_runs(data)
    for size in (None, 16, 64):                   # whole keys; key 0 cut into many and into few buckets
        got = sequence.islands(df, "k", ["d", "seq"], "v", out="run", rows=size).select("seq", "run").collect()
        assert {r.seq: r.run for r in got} == run_of
        got = sequence.previous_value(df, "k", ["d", "seq"], "v", "p", rows=size).select("seq", "p").collect()
        assert {r.seq: r.p for r in got} == prev_of


def test_islands_null_continues_the_run(spark):
    # the walk increments only when prev <> cur is TRUE; NULL compares unknown
    df = spark.createDataFrame([(1, 1, "A"), (1, 2, None), (1, 3, "A"), (1, 4, "B"), (1, 5, None)],
                               "k long, seq long, v string")
    got = rows(sequence.islands(df, "k", ["seq"], "v", out="run"), "seq", "run")
    assert got == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 2)]
    many = spark.createDataFrame([(1, i, None if i % 3 == 0 else "A") for i in range(200)], "k long, seq long, v string")
    assert {r.run for r in sequence.islands(many, "k", ["seq"], "v", out="run", rows=8).collect()} == {1}


def test_a_hot_key_is_cut_and_spread(spark):
    """Without any hint a key with a third of the rows lies in many buckets of a bounded size, the others in none."""
    data = _sequence_rows(seed=11, n=3000)
    df = spark.createDataFrame(data, "k long, d date, seq long, v string")
    b, bounds = sequence.with_buckets(df, ["k"], ["d", "seq"], 64)
    sizes = {(r.k, r[sequence.BUCKET]): r["count"] for r in b.groupBy("k", sequence.BUCKET).count().collect()}
    hot = {bucket: n for (k, bucket), n in sizes.items() if k == 0}
    assert None not in hot and 10 <= len(hot) <= bounds and max(hot.values()) <= 5 * 64
    assert sum(hot.values()) == sum(r[0] == 0 for r in data)
    # buckets follow the order: no row of a later bucket comes before one of an earlier bucket
    edges = (b.where("k = 0").groupBy(sequence.BUCKET).agg(F.min(F.struct("d", "seq")).alias("lo"), F.max(F.struct("d", "seq")).alias("hi"))
             .orderBy(sequence.BUCKET).collect())
    assert all(x.hi < y.lo for x, y in zip(edges, edges[1:]))
    # a small table is not even sampled
    assert sequence.with_buckets(df, ["k"], ["d", "seq"])[1] == 0


def test_islands_carry_values_of_the_first_row(spark):
    data = _sequence_rows(seed=4)
    df = spark.createDataFrame(data, "k long, d date, seq long, v string")
    first = {}
    for k, d, seq, _ in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        first.setdefault(k, seq)
    for size in (None, 16):
        got = sequence.islands(df, "k", ["d", "seq"], "v", out="run", rows=size, first={"first_seq": "seq"}).collect()
        assert len(got) == len(data) and all(r.first_seq == first[r.k] for r in got)


def test_row_number_and_prefix_sum_on_a_hot_key(spark):
    data = _sequence_rows(seed=8)
    df = spark.createDataFrame(data, "k long, d date, seq long, v string")
    for descending in (False, True):
        want, sums = {}, {}
        for key in {r[0] for r in data}:
            total = 0
            for n, r in enumerate(sorted((r for r in data if r[0] == key), key=lambda r: r[1:3], reverse=descending), 1):
                want[r[2]], sums[r[2]] = n, total
                total += r[2]
        for size in (None, 16):
            got = sequence.row_number(df, "k", ["d", "seq"], "n", descending, size)
            assert {r.seq: r.n for r in got.collect()} == want
            got = sequence.prefix_sum(df, "k", ["d", "seq"], "seq", "s", descending, size)
            assert {r.seq: r.s for r in got.collect()} == sums


def test_percentile_cont_matches_linear_interpolation(spark):
    rnd = random.Random(5)
    data = [(g, rnd.randrange(0, 40)) for g in range(4) for _ in range(rnd.randrange(1, 300))]
    df = spark.createDataFrame(data, "g int, x long")
    probs = {"p50": 0.5, "p80": 0.8, "p95": 0.95, "p0": 0.0, "p100": 1.0}
    got = {r.g: r for r in quantiles.percentile_cont(df, ["g"], "x", probs).collect()}
    for g in range(4):
        xs = np.array([x for gg, x in data if gg == g], dtype=float)
        for name, p in probs.items():
            assert abs(getattr(got[g], name) - np.percentile(xs, 100 * p)) < 1e-9


def test_rank_within_and_extremes(spark):
    data = [("A", dt.date(2021, 1, 1), "x"), ("A", dt.date(2021, 1, 1), "y"), ("A", dt.date(2021, 1, 3), "z"),
            ("A", dt.date(2021, 1, 7), "w"), ("B", dt.date(2021, 1, 2), "x"), ("B", None, "n")]
    df = spark.createDataFrame(data, "c string, d date, p string")
    ranked = {(r.c, r.p): r.rk for r in ranking.rank_within(df, "c", "d", out="rk").collect()}
    assert ranked == {("A", "x"): 1, ("A", "y"): 1, ("A", "z"): 3, ("A", "w"): 4, ("B", "x"): 1, ("B", "n"): 2}
    desc = {(r.c, r.p): r.rk for r in ranking.rank_within(df, "c", "d", out="rk", descending=True).collect()}
    assert desc[("B", "n")] == 1 and desc[("B", "x")] == 2 and desc[("A", "w")] == 1
    first = rows(ranking.rows_at_extreme(df.filter("d is not null"), "c", "d"), "c", "p")
    assert first == [("A", "x"), ("A", "y"), ("B", "x")]
    last = rows(ranking.rows_at_extreme(df, "c", "d", largest=True), "c", "p")
    assert last == [("A", "w"), ("B", "x")]
    only_nulls = spark.createDataFrame([("Z", None, "a"), ("Z", None, "b")], "c string, d date, p string")
    assert rows(ranking.rows_at_extreme(only_nulls, "c", "d"), "c", "p") == [("Z", "a"), ("Z", "b")]
    assert rows(ranking.rows_at_extreme(df, "c", "d"), "c", "p") == [("A", "x"), ("A", "y"), ("B", "x")]


def test_nth_in_group_and_after_first(spark):
    data = [(1, 10, 0), (1, 5, 1), (1, 7, 2), (2, 3, 3), (3, 1, 4), (3, 1, 5)]
    df = spark.createDataFrame(data, "k int, t int, id int")
    assert rows(ranking.nth_in_group(df, "k", ["t", "id"], 2), "k", "id") == [(1, 2), (3, 5)]
    assert rows(lifecycle.after_first(df, "k", ["t", "id"]), "id") == [(0,), (2,), (5,)]


def test_snapshot_as_of(spark):
    data = [(1, 0, 1), (1, 1, 5), (1, 4, 9), (2, 0, 6), (3, 2, 2)]
    df = spark.createDataFrame(data, "k int, s int, t int")
    got = rows(lifecycle.snapshot_as_of(df, "k", ["t"], "t", F.lit(5), ["s"]))
    assert got == [(1, 1), (3, 2)]     # key 2 starts after the date


def test_month_spine_and_running_total(spark):
    keys = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    sp = spine.month_spine(keys, "k", dt.date(2020, 1, 1), 3, number_col="n")
    assert rows(sp) == [(1, dt.date(2020, 1, 1), 1), (1, dt.date(2020, 2, 1), 2), (1, dt.date(2020, 3, 1), 3),
                        (2, dt.date(2020, 1, 1), 1), (2, dt.date(2020, 2, 1), 2), (2, dt.date(2020, 3, 1), 3)]
    vals = spark.createDataFrame([(1, dt.date(2020, 2, 1), 5), (1, dt.date(2020, 3, 1), -2)], "k int, month date, b int")
    filled = spine.running_total(spine.fill_on_spine(sp.drop("n"), vals, ["k", "month"]), "k", "month", "b", "run")
    got = {(r.k, r.month.month): r.run for r in filled.collect()}
    assert got[(1, 1)] is None and got[(1, 2)] == 5 and got[(1, 3)] == 3 and got[(2, 3)] is None
    missing = rows(spine.missing_in_range(spark, spark.createDataFrame([(2,), (4,)], "w long"), "w", 1, 5))
    assert missing == [(1,), (3,), (5,)]


def _items(spark, data):
    return spark.createDataFrame(data, "order_id long, item_id long, pizza_id int, exclusions string, extras string")


def test_item_labels_and_ingredients(spark):
    data = [(1, 1, 1, "none", "none"),
            (1, 2, 1, "4", "1, 5"),            # extra already in the recipe -> 2x Bacon
            (2, 3, 2, "4, 1", "none"),         # exclusion not in the recipe (1)
            (2, 4, 2, "4, 6, 7, 9, 11, 12", "none")]   # everything excluded -> no ingredient row
    items = _items(spark, data)
    labels = dict(rows(lists.item_labels(items, ["item_id"], dims.pizza_names(spark), dims.PIZZA_TOPPINGS)))
    assert labels == {1: "Meatlovers", 2: "Meatlovers - Exclude Cheese - Extra Bacon, Chicken",
                      3: "Vegetarian - Exclude Cheese, Bacon",
                      4: "Vegetarian - Exclude Cheese, Mushrooms, Onions, Peppers, Tomatoes, Tomato Sauce"}
    literal = dict(rows(lists.item_labels(items, ["item_id"], dims.pizza_names(spark), dims.PIZZA_TOPPINGS,
                                          literal=True)))
    assert literal[1] == "Meatlovers  "
    ing = dict(rows(lists.item_ingredients(items, ["item_id"], dims.pizza_recipes(spark),
                                           dims.pizza_names(spark), dims.PIZZA_TOPPINGS)))
    assert ing == {1: "Meatlovers: BBQ Sauce, Bacon, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami",
                   2: "Meatlovers: BBQ Sauce, 2x Bacon, Beef, 2x Chicken, Mushrooms, Pepperoni, Salami",
                   3: "Vegetarian: Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"}


def test_ingredient_totals_is_multiset_algebra(spark):
    rnd = random.Random(9)
    def lst():
        k = rnd.randrange(4)
        return "none" if k == 0 else ", ".join(str(rnd.randrange(1, 13)) for _ in range(k))
    data = [(i, i, rnd.choice([1, 2]), lst(), lst()) for i in range(300)]
    got = dict(rows(lists.ingredient_totals(_items(spark, data), dims.pizza_recipes(spark),
                                            dims.pizza_toppings(spark), "topping_id", "topping_name", "n")))
    recipe = {p: [int(x) for x in t.split(",")] for p, t in dims.PIZZA_RECIPES}
    base, excl, extra = Counter(), Counter(), Counter()
    for _, _, p, ex, ey in data:
        base.update(recipe[p])
        if ex != "none":
            excl.update(int(x) for x in ex.split(","))
        if ey != "none":
            extra.update(int(x) for x in ey.split(","))
    total = (base - excl) + extra          # Counter '-' floors at zero: EXCEPT ALL
    names = dict(dims.PIZZA_TOPPINGS)
    assert got == {names[k]: v for k, v in total.items() if v > 0}


def test_rank_on_hot_keys_and_ties(spark):
    rnd = random.Random(21)
    # key 0 is hot; half of its rows tie on one value
    data = [(0 if rnd.random() < 0.5 else rnd.randrange(1, 6), rnd.choice([250, rnd.randrange(0, 500)]), i) for i in range(700)]
    df = spark.createDataFrame(data, "k int, x long, id int")
    for desc in (False, True):
        want = {i: 1 + sum(1 for kk, xx, _ in data if kk == k and (xx > x if desc else xx < x)) for k, x, i in data}
        for size in (None, 16, 40):
            got = ranking.rank_within(df, "k", "x", out="r", descending=desc, rows=size).collect()
            assert {r.id: r.r for r in got} == want, (desc, size)
    b, _ = sequence.with_buckets(df.withColumn("t", F.xxhash64("id")), ["k"], ["x", "t"], 16)
    tied = b.where("k = 0 and x = 250").groupBy(sequence.BUCKET).count().collect()
    assert len(tied) > 5 and max(r["count"] for r in tied) < 80      # the tied rows are spread too
    some = ranking.rank_within(df, "k", "x", out="r", where=F.col("id") % 2 == 0, rows=16).collect()
    assert {r.id: r.r for r in some} == {
        i: 1 + sum(1 for kk, xx, j in data if kk == k and xx < x and j % 2 == 0) if i % 2 == 0 else None for k, x, i in data}


def test_all_rows_tie_at_the_extreme(spark):
    """A key whose rows all tie keeps them all, found by a semi join and not by a window over the key."""
    df = spark.createDataFrame([(1, 5, i) for i in range(500)] + [(2, i, 500 + i) for i in range(5)], "k int, x int, id int")
    got = ranking.rows_at_extreme(df, "k", "x")
    assert {r.id for r in got.collect()} == {*range(501)}
    assert {r.id for r in ranking.rows_at_extreme(df, "k", "x", largest=True).collect()} == {*range(500), 504}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "LeftSemi" in plan


def test_percentiles_of_random_doubles(spark):
    rnd = np.random.default_rng(2)
    # one group holds most rows, one a narrow range, one both huge and tiny values, one is NULL
    data = [("a", float(x)) for x in rnd.lognormal(0, 3, 4000)] + [("b", 1 + float(x) * 1e-12) for x in rnd.random(500)]
    data += [("c", float(s * 10.0 ** e)) for s, e in zip(rnd.normal(size=300), rnd.integers(-300, 300, 300))]
    data += [(None, float(x)) for x in rnd.integers(0, 3, 100)] + [("d", 7.5), ("e", None), ("a", None)]
    df = spark.createDataFrame(data, "g string, x double").repartition(4)
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p999": 0.999, "p100": 1.0}
    for bins in (None, 4, quantiles.BINS):
        got = {r.g: r for r in quantiles.percentile_cont(df, ["g"], "x", probs, bins).collect()}
        assert set(got) == {"a", "b", "c", "d", None}
        for g, r in got.items():
            xs = np.array([x for gg, x in data if gg == g and x is not None])
            for name, p in probs.items():
                pos = p * (len(xs) - 1)
                lo, hi = np.sort(xs)[[math.floor(pos), math.ceil(pos)]]
                assert getattr(r, name) == lo + (hi - lo) * (pos - math.floor(pos)), (g, name)
    whole = quantiles.percentile_cont(df, [], "x", {"m": 0.5}).first().m
    assert abs(whole - np.median([x for _, x in data if x is not None])) <= 1e-12 * abs(whole)
    assert quantiles.percentile_cont(df.limit(0), ["g"], "x", probs).count() == 0


def test_item_ingredients_orders_equal_names_by_id(spark):
    items = _items(spark, [(1, 1, 1, "none", "5, 5, 7")])
    recipes = spark.createDataFrame([(1, "6")], "pizza_id int, toppings string")
    pizzas = spark.createDataFrame([(1, "P")], "pizza_id int, pizza_name string")
    got = rows(lists.item_ingredients(items, ["item_id"], recipes, pizzas, [(7, "A"), (5, "A"), (6, "B")]), "ingredients_list")
    assert got == [("P: 2x A, A, B",)]


def test_struct_orders_put_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 0), (1, 5, 1), (1, 7, 2)], "k int, t int, id int")
    assert rows(ranking.nth_in_group(df, "k", ["t", "id"], 2), "id") == [(2,)]
    assert rows(ranking.nth_in_group(df, "k", ["t", "id"], 3), "id") == [(0,)]
    assert rows(lifecycle.after_first(df, "k", ["t", "id"]), "id") == [(0,), (2,)]


def test_sequence_null_order_values_come_last(spark):
    data = [(1, None, 10, "A"), (1, dt.date(2024, 1, 1), 1, "A"), (1, dt.date(2024, 1, 1), 2, "B"),
            (1, dt.date(2024, 1, 2), 3, "B")]
    df = spark.createDataFrame(data, "k long, d date, seq long, v string")
    # order: (01-01,1,A) (01-01,2,B) (01-02,3,B) (NULL,10,A) -> runs 1, 2, 2, 3
    for size in (None, 1):
        got = dict(rows(sequence.islands(df, "k", ["d", "seq"], "v", out="run", rows=size), "seq", "run"))
        assert got == {1: 1, 2: 2, 3: 2, 10: 3}
        prev = dict(rows(sequence.previous_value(df, "k", ["d", "seq"], "v", "p", rows=size), "seq", "p"))
        assert prev == {1: None, 2: "A", 3: "B", 10: "B"}


def test_null_keys_form_their_own_group(spark):
    df = spark.createDataFrame([(None, 1, 0), (None, 2, 1), (None, 3, 2), (1, 1, 3)], "k int, t int, id int")
    assert rows(ranking.rows_at_extreme(df, "k", "t"), "id") == [(0,), (3,)]
    assert rows(ranking.nth_in_group(df, "k", ["t", "id"], 2), "id") == [(1,)]
    assert rows(lifecycle.after_first(df, "k", ["t", "id"]), "id") == [(1,), (2,)]
    seq = spark.createDataFrame([(None, 1, "A"), (None, 2, "B")], "k int, s long, v string")
    assert rows(sequence.islands(seq, "k", ["s"], "v", out="r"), "s", "r") == [(1, 1), (2, 2)]


def test_cut_ranks_with_nulls_match_plain(spark):
    data = [(k, None if i % 7 == 0 else (i * 37) % 101) for k in (None, 1, 2) for i in range(40)]
    df = spark.createDataFrame(data, "k int, x long")
    for desc in (False, True):
        plain = rows(ranking.rank_within(df, "k", "x", out="r", descending=desc), "k", "x", "r")
        for size in (1, 8, 16):
            assert rows(ranking.rank_within(df, "k", "x", out="r", descending=desc, rows=size),
                        "k", "x", "r") == plain, (desc, size)


def test_measures_keep_all_digits_and_ids_split_on_blanks(spark):
    from tillroll.operators import clean, lists

    t = spark.createDataFrame([("104.3km", "1 4"), ("5.3km", "1, 4"), ("20.75 km", " 4,1 ")], "d string, l string")
    got = t.select(clean.extract_measure("d").alias("d"), clean.extract_measure("d", literal=True).alias("lit"),
                   lists.ids("l").alias("l")).collect()
    assert [r.d for r in got] == ["104.3", "5.3", "20.75"]
    assert [r.lit for r in got] == ["10", None, "20.7"]
    assert [list(r.l) for r in got] == [[1, 4], [1, 4], [4, 1]]
