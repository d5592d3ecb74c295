"""Semantic traps: each helper against hand-computed or brute-force values."""

import calendar
import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tillroll.functions import sem


def one(spark, expr, **cols):
    """Evaluate ``expr`` over a one-row frame built from ``cols``."""
    df = spark.createDataFrame([tuple(cols.values())], list(cols)) if cols else spark.range(1)
    return df.select(expr.alias("v")).first()["v"]


def test_int_div_truncates(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (7, -2), (5, 0), (100 * 3, 7)], "a long, b long")
    got = [r.v for r in df.select(sem.int_div("a", "b").alias("v")).collect()]
    assert got == [3, -3, -3, None, 42]


def test_ratio_round_half_away_exact(spark):
    cases = [(1, 2, 0), (5, 2, 0), (-5, 2, 0), (1, 8, 2), (-1, 8, 2), (2, 3, 3), (24691, 2000, 3),
             (123456789, 1000, 2), (0, 7, 1)]
    df = spark.createDataFrame(cases, "n long, d long, k int")
    for (n, d, k), r in zip(cases, df.collect()):
        got = one(spark, sem.ratio_round(F.lit(n), F.lit(d), k))
        q = (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-k), rounding=ROUND_HALF_UP)
        assert got == float(q), (n, d, k, got, q)


def test_ratio_round_decimal_scales(spark):
    # 12.35 / 1 at 1 digit -> 12.4 (half away), money scale 2
    got = one(spark, sem.ratio_round(F.lit(Decimal("12.35")).cast("decimal(18,2)"), F.lit(1), 1, num_scale=2))
    assert got == 12.4
    got = one(spark, sem.ratio_round(F.lit(Decimal("-12.35")).cast("decimal(18,2)"), F.lit(1), 1, num_scale=2))
    assert got == -12.4
    assert one(spark, sem.ratio_round(F.lit(1), F.lit(0), 2)) is None


def _age_days(end: dt.date, start: dt.date) -> int:
    """Field-wise calendar difference (day field), borrowing start's month."""
    d = end.day - start.day
    if d < 0:
        d += calendar.monthrange(start.year, start.month)[1]
    return d


def test_age_day_part_matches_fieldwise_rule(spark):
    rnd = random.Random(7)
    pairs = []
    for _ in range(400):
        s = dt.date(1995, 1, 1) + dt.timedelta(days=rnd.randrange(0, 2500))
        e = s + dt.timedelta(days=rnd.randrange(0, 120))
        pairs.append((s, e))
    pairs += [(dt.date(2024, 1, 31), dt.date(2024, 3, 1)), (dt.date(2023, 1, 31), dt.date(2023, 3, 1)),
              (dt.date(2024, 2, 29), dt.date(2024, 3, 28))]
    df = spark.createDataFrame(pairs, "s date, e date")
    got = [r.v for r in df.select(sem.age_day_part("e", "s").alias("v")).collect()]
    assert got == [_age_days(e, s) for s, e in pairs]
    # month-end borrow: 31 Jan -> 1 Mar is "1 month 1 day", not 30 days
    assert _age_days(dt.date(2024, 3, 1), dt.date(2024, 1, 31)) == 1


def test_age_minute_part(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 6, 55), dt.datetime(2024, 1, 2, 5, 10)),
                                (dt.datetime(2024, 1, 1, 10, 0, 30), dt.datetime(2024, 1, 1, 11, 5, 10)),
                                (dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = [r.v for r in df.select(sem.age_minute_part("b", "a").alias("v")).collect()]
    assert got == [15, 4, 0]


def test_two_digit_years(spark):
    df = spark.createDataFrame([("5/1/95",), ("31/8/75",), ("1/12/01",), ("9/3/69",)], "s string")
    got = [r.v for r in df.select(sem.parse_dmy2("s").alias("v")).collect()]
    assert got == [dt.date(1995, 1, 5), dt.date(1975, 8, 31), dt.date(2001, 12, 1), dt.date(2069, 3, 9)]


def test_weekday_padding_and_shifted_week(spark):
    assert one(spark, sem.weekday_name(F.lit(dt.date(1998, 6, 15)))) == "Monday   "
    assert one(spark, sem.weekday_name(F.lit(dt.date(1998, 6, 17)), padded=False)) == "Wednesday"
    # Friday-anchored 7-day periods: 2024-01-03 (Wed) belongs to the period from Fri 2023-12-29
    assert one(spark, sem.shifted_week_start(F.lit(dt.date(2024, 1, 3)), 4)) == dt.date(2023, 12, 29)
    assert one(spark, sem.shifted_week_start(F.lit(dt.date(2024, 1, 5)), 4)) == dt.date(2024, 1, 5)


def test_day_of_year_week(spark):
    for d, w in [(dt.date(1998, 1, 1), 1), (dt.date(1998, 1, 7), 1), (dt.date(1998, 1, 8), 2),
                 (dt.date(1998, 12, 31), 53)]:
        assert one(spark, sem.day_of_year_week(F.lit(d))) == w


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (2.6,)], "x double")
    assert [r.v for r in df.select(sem.round_half_even("x").alias("v")).collect()] == [0.0, 2.0, 2.0, -2.0, 3.0]


def test_seeded_draw_is_deterministic_and_in_range(spark):
    df = spark.range(0, 5000).select(sem.seeded_unit_draw("id", 1, 5).alias("r"))
    a = [r.r for r in df.collect()]
    b = [r.r for r in spark.range(0, 5000).repartition(7).orderBy("id")
         .select(sem.seeded_unit_draw("id", 1, 5).alias("r")).collect()]
    assert a == b
    assert set(a) == {1, 2, 3, 4, 5}
    counts = [a.count(k) for k in range(1, 6)]
    assert min(counts) > 800   # roughly uniform


def test_sum_if_is_null_over_no_rows(spark):
    df = spark.createDataFrame([(1,)], "x int").filter("x > 5")
    assert df.agg(sem.sum_if(F.col("x") > 0).alias("v")).first().v is None
