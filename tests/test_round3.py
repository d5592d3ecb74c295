"""As-of joins, stored distinct counts, counted multisets and calendar differences against brute force."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tillroll.functions import search, sem
from tillroll.operators import asof, distinct, lifecycle, multiset
from tillroll.plans import bank, subscriptions

T0 = dt.datetime(2024, 1, 1)


def _events(spark, n=400, seed=3):
    """Key 0 holds a third of the rows, None is a key; several events may share a time."""
    rnd = random.Random(seed)
    data = [(rnd.choice([0, 0, 0, None, 1, 2, 3, 4, 5]), T0 + dt.timedelta(hours=rnd.randrange(500)), i, rnd.randrange(4))
            for i in range(n)]
    return data, spark.createDataFrame(data, "k long, t timestamp_ntz, id long, s int")


def test_as_of_join(spark):
    data, events = _events(spark)
    rnd = random.Random(9)
    probes = [(i, rnd.choice([0, 0, None, 1, 2, 9]), rnd.choice([None, T0 + dt.timedelta(minutes=rnd.randrange(-900, 31_000)), data[i][1]]), "x")
              for i in range(200)] * 2
    df = spark.createDataFrame(probes, "probe long, k long, at timestamp_ntz, s2 string")
    want = []
    for p, k, at, x in probes:
        seen = [(t, i, s) for kk, t, i, s in data if kk == k and at is not None and t <= at]
        t, i, s = max(seen) if seen else (None, None, None)
        want.append((p, k, at, x, s, i))
    for size in (None, 16):
        got = asof.as_of(df, events, "k", "at", "t", ["t", "id"], ["s", "id"], rows=size)
        assert got.columns == ["probe", "k", "at", "s2", "s", "id"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert asof.as_of(df.limit(0), events, "k", "at", "t", ["t", "id"], ["s"]).count() == 0
    assert {r.s for r in asof.as_of(df, events.limit(0), "k", "at", "t", ["t", "id"], ["s"]).collect()} == {None}


def test_counts_at_many_dates_equal_snapshots(spark):
    data, events = _events(spark, seed=5)
    at = [T0 + dt.timedelta(hours=h) for h in (-5, 0, 1, 40, 40, 41, 333, 499, 600)]
    dates = spark.createDataFrame([(t,) for t in at], "d timestamp_ntz")
    want = []
    for t in sorted(set(at)):
        snap = lifecycle.snapshot_as_of(events, "k", ["t", "id"], "t", F.lit(str(t)).cast("timestamp_ntz"), ["s"])
        want += [(t, s, n) for s, n in Counter(r.s for r in snap.collect()).items()]
    for size in (None, 16):
        got = asof.counts_at(events, dates, "k", "t", ["t", "id"], "s", "d", "n", rows=size)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert asof.counts_at(events, dates.limit(0), "k", "t", ["t", "id"], "s", "d", "n").count() == 0
    assert asof.counts_at(events.limit(0), dates, "k", "t", ["t", "id"], "s", "d", "n").count() == 0


def test_snapshots_by_day_of_a_given_table(spark):
    subs = spark.createDataFrame([(1, 0, T0, 1), (1, 3, T0 + dt.timedelta(days=2), 2), (2, 0, T0 + dt.timedelta(hours=1), 3)],
                                 "customer_id long, plan_id int, start_date timestamp_ntz, event_id long")
    dates = spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=2),)], "as_of timestamp_ntz")
    got = rows(subscriptions.plan_snapshots_by_day(subs, dates), "as_of", "plan_id", "customer_count")
    assert got == [(T0, 0, 1), (T0 + dt.timedelta(days=2), 0, 1), (T0 + dt.timedelta(days=2), 3, 1)]


@pytest.mark.parametrize("longest", [1, 15, 16, 17, 300, 5000])
def test_search_in_a_sorted_array(spark, longest):
    rnd = random.Random(longest)
    a = sorted(rnd.randrange(longest) for _ in range(longest))
    df = spark.createDataFrame([(x,) for x in [*range(-1, min(longest, 400) + 1), a[-1], a[0]]], "x int")
    listed = F.array(*[F.lit(v) for v in a])
    for strictly in (False, True):
        got = search.count_at_most(df, listed, F.col("x"), "n", longest, strictly).collect()
        assert all(r.n == sum(v < r.x if strictly else v <= r.x for v in a) for r in got)


def test_stored_distinct_counts_merge(spark):
    rnd = random.Random(2)
    data = [(m, rnd.choice([5, None, rnd.randrange(-40_000, 200_000)])) for m in (1, 2, 3) for _ in range(300)]
    df = spark.createDataFrame(data, "m int, id long").repartition(5)
    states = distinct.id_states(df, [F.col("m")], "id")
    per = dict(rows(distinct.count_ids(states, ["m"], "n")))
    assert per == {m: len({i for mm, i in data if mm == m and i is not None}) for m in (1, 2, 3)}
    everything = distinct.count_ids(distinct.merge(states), [], "n").first().n
    assert everything == len({i for _, i in data if i is not None})
    # coarser periods, and a later load that repeats ids, from the states alone
    half = distinct.merge(states.unionByName(states.where("m = 3")), [(F.col("m") > 1).alias("late")])
    assert dict(rows(distinct.count_ids(half, ["late"], "n")))[True] == len({i for m, i in data if m > 1 and i is not None})
    assert distinct.count_ids(distinct.merge(states.limit(0)), [], "n").first().n == 0


def test_counted_multisets(spark):
    rnd = random.Random(6)

    def some(n):
        return [(rnd.choice([1, 2, 3, None]), rnd.choice(["x", "y", None])) for _ in range(n)] + [(7, "hot")] * (n * 5)
    data = [some(n) for n in (40, 25, 10)]
    a, b, c = (multiset.counted(spark.createDataFrame(d, "i int, s string").repartition(3)) for d in data)
    ca, cb, cc = map(Counter, data)

    def got(m):
        return Counter({(r.i, r.s): r[multiset.COUNT] for r in m.collect()})
    # (a EXCEPT ALL b) UNION ALL c, (a EXCEPT b) UNION ALL c: from the left
    assert got(multiset.union_all(multiset.except_all(a, b), c)) == (ca - cb) + cc
    assert got(multiset.union_all(multiset.except_distinct(a, c), b)) == Counter(k for k in ca if k not in cc) + cb
    assert got(multiset.intersect_all(a, b)) == ca & cb
    assert Counter(map(tuple, multiset.rows_of(multiset.except_all(a, c)).collect())) == ca - cc
    times = spark.createDataFrame([(1, "x", 3), (1, "x", 2), (2, "y", 0)], "i int, s string, count long")
    assert got(multiset.counted(times, F.col("count"))) == Counter({(1, "x"): 5})
    assert multiset.except_all(a, a).count() == 0 and multiset.union_all(a.limit(0), b.limit(0)).count() == 0
    with pytest.raises(ValueError):
        multiset.union_all(a, spark.createDataFrame([(1, 1)], "z int, count long"))


def test_age_against_duckdb(spark):
    import duckdb

    rnd = random.Random(1)
    days = [dt.date(y, m, d) for y in (2019, 2020, 2021) for m, d in ((1, 31), (2, 28), (3, 1), (3, 30), (3, 31), (4, 30), (12, 31), (1, 1))]
    days += [dt.date(2020, 2, 29)]
    pairs = [(dt.datetime.combine(rnd.choice(days), dt.time(rnd.randrange(24), rnd.randrange(60), rnd.randrange(60), rnd.randrange(10 ** 6))),
              dt.datetime.combine(rnd.choice(days), dt.time(rnd.choice([0, 23]), 59, 59))) for _ in range(1500)]
    pairs += [(dt.datetime.combine(a, dt.time()), dt.datetime.combine(b, dt.time())) for a in days for b in days]
    parts = ("year", "month", "day", "hour", "minute")
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a timestamp_ntz, b timestamp_ntz")
    got = df.select("i", *[sem.interval_part(p, sem.age("a", "b")).alias(p) for p in parts],
                    sem.age("a", "b")["micros"].alias("micros")).orderBy("i").collect()
    con = duckdb.connect()
    con.execute("create table p (i int, a timestamp, b timestamp)")
    con.executemany("insert into p values (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    want = con.execute("select i, " + ", ".join(f"date_part('{p}', age(a, b))" for p in parts)
                       + ", date_part('hour', age(a, b)) * 3600000000 + date_part('minute', age(a, b)) * 60000000"
                       " + date_part('microsecond', age(a, b)) from p order by i").fetchall()
    assert [tuple(r) for r in got] == want
    none = spark.createDataFrame([(None, T0)], "a timestamp_ntz, b timestamp_ntz").select(sem.age("a", "b").alias("x")).first()
    assert none.x is None


def test_before_after_windows_reach_into_the_next_year(spark):
    from tillroll.plans import retail

    monday = dt.date(2018, 11, 5)
    data = []
    while monday < dt.date(2021, 3, 1):
        data.append((monday, monday.isocalendar()[1], monday.year, monday.toordinal() % 97))
        monday += dt.timedelta(days=7)
    df = spark.createDataFrame(data, "week_date date, week_number long, calendar_year long, sales long")
    base = dt.date(2020, 1, 13)      # ISO week 3: four weeks before it begin in December
    got = {r.calendar_year: (r.before_sales, r.after_sales) for r in retail.before_after_by_year(df, base, weeks=4).collect()}
    for year in (2019, 2020, 2021):
        start = dt.date.fromisocalendar(year, 3, 1)
        before = [s for d, _, _, s in data if 1 <= (start - d).days // 7 <= 4 and d < start]
        after = [s for d, _, _, s in data if 0 <= (d - start).days < 28]
        assert len(before) == 4 and got[year] == (sum(before), sum(after))
    assert set(got) >= {2018, 2019, 2020, 2021}


def test_balance_shares_count_earlier_months_and_name_their_modes(spark):
    month = dt.date(2020, 3, 1)
    rows = [(1, dt.date(2020, 1, 5), "deposit", 100), (1, dt.date(2020, 4, 2), "deposit", 4),       # 100 -> 104: up by under 5 %
            (2, dt.date(2020, 3, 9), "deposit", 100), (2, dt.date(2020, 4, 9), "deposit", 6),       # 100 -> 106: grown
            (3, dt.date(2020, 3, 9), "deposit", 100), (3, dt.date(2020, 4, 9), "withdrawal", 120),  # 100 -> -20: fallen, flipped
            (4, dt.date(2020, 2, 9), "withdrawal", 10), (4, dt.date(2020, 5, 1), "deposit", 999)]   # -10 -> -10
    t = spark.createDataFrame(rows, "customer_id int, txn_date date, txn_type string, txn_amount int")
    got = bank.month_over_month_balance_shares(t, first_month=month).first()
    assert tuple(got) == (75, 25, 33, 33, 33)
    by_amounts = bank.month_over_month_shares(t, first_month=month).first()
    assert (by_amounts.positive_pc, by_amounts.increase_pc) == (50, 0)
    with pytest.raises(ValueError):
        bank.month_over_month_shares(t, mode="closing")
