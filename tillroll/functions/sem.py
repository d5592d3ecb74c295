"""Column helpers that pin down SQL semantics the operators depend on.

All helpers return JVM-side Catalyst expressions (no Python UDFs), so they
stay inside whole-stage codegen.  Each one fixes a rule that differs between
SQL dialects: integer division, half-away rounding of exact ratios, the
calendar ``age`` difference, two-digit years, padded weekday names, lists of
ids stored as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Exact money: decimal(18,2).  Sums stay exact, independent of order."""
    return col(c).cast(MONEY)


def _unscaled(c: Column, scale: int) -> Column:
    """An exact value with at most ``scale`` decimals as an integral decimal."""
    if scale:
        c = c * F.lit(10 ** scale)
    return c.cast("decimal(38,0)")


def ratio_round_unscaled(num: str | Column, den: str | Column, digits: int,
                         num_scale: int = 0, den_scale: int = 0) -> Column:
    """``round(num / den, digits) * 10**digits`` as a long, rounding half away
    from zero on the *exact* quotient (no intermediate float or truncated
    decimal).  ``num``/``den`` are exact numbers with at most
    ``num_scale``/``den_scale`` decimals.  NULL when ``den`` is 0 or NULL.
    """
    n = _unscaled(col(num), num_scale)
    d = _unscaled(col(den), den_scale)
    # value = n * 10^den_scale / (d * 10^num_scale); scaled by 10^digits
    top = F.abs(n) * F.lit(10 ** (den_scale + digits))
    bottom = F.abs(d) * F.lit(10 ** num_scale)
    x, y = top * 2 + bottom, bottom * 2
    # floor(x / y) for positive integers: x - x % y is a multiple of y, so the
    # decimal quotient is an exact integer whatever scale the division keeps.
    q = ((x - x % y) / y).cast("long")
    sign = F.signum(n) * F.signum(d)
    return F.when(d == 0, F.lit(None).cast("long")).otherwise((q * sign).cast("long"))


def ratio_round(num: str | Column, den: str | Column, digits: int,
                num_scale: int = 0, den_scale: int = 0) -> Column:
    """Exact ``round(num/den, digits)`` (half away from zero) as a double.

    The double is the nearest one to the exact decimal result, the same value
    any engine gets by converting that decimal.
    """
    q = ratio_round_unscaled(num, den, digits, num_scale, den_scale)
    if digits == 0:
        return q.cast("double")
    return q.cast("double") / F.lit(float(10 ** digits))


def int_div(num: str | Column, den: str | Column) -> Column:
    """Truncating integer division (``7 / 2 = 3``, ``-7 / 2 = -3``); NULL on 0."""
    n, d = col(num).cast("long"), col(den).cast("long")
    exact = (n - n % d).cast("decimal(38,0)") / d.cast("decimal(38,0)")
    return F.when(d == 0, F.lit(None).cast("long")).otherwise(exact.cast("long"))


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """Rounding of a double the way ``round(double)`` does: half to even."""
    return F.bround(col(c).cast("double"), digits)


_MICROS_OF_DAY = 86_400_000_000


def age(end: str | Column, start: str | Column) -> Column:
    """The calendar difference ``age(end, start)`` of dates or zone-less timestamps: a struct of years, months, days
    and micros, all of one sign.

    Fields are subtracted from the later to the earlier one; a time of day below
    zero borrows a day, days below zero borrow the length of the earlier one's
    month, months below zero borrow a year.  With ``end`` before ``start`` every field is
    negated.  NULL if either is.
    """
    e, s = (col(c).cast("timestamp_ntz") for c in (end, start))
    sign = F.when(e < s, -1).otherwise(1)
    lo, hi = F.least(e, s), F.greatest(e, s)

    def micros(t):   # of the day
        day = F.to_date(t).cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", day, t)
    time = micros(hi) - micros(lo)
    days = F.dayofmonth(hi) - F.dayofmonth(lo) - F.when(time < 0, 1).otherwise(0)
    months = F.month(hi) - F.month(lo) - F.when(days < 0, 1).otherwise(0)
    years = F.year(hi) - F.year(lo) - F.when(months < 0, 1).otherwise(0)
    fields = {"years": years, "months": F.when(months < 0, months + 12).otherwise(months),
              "days": F.when(days < 0, days + F.dayofmonth(F.last_day(lo))).otherwise(days)}
    micro = F.when(time < 0, time + _MICROS_OF_DAY).otherwise(time)
    known = e.isNotNull() & s.isNotNull()
    return F.when(known, F.struct(*[(sign * x).cast("long").alias(n) for n, x in {**fields, "micros": micro}.items()]))


def interval_part(field: str, interval: Column) -> Column:
    """A field of an ``age`` as ``date_part`` gives it: year, month, day, hour, minute, second (whole ones, truncated to zero)."""
    if field in ("year", "month", "day"):
        return interval[f"{field}s"]
    unit, of = {"hour": (3_600_000_000, 24), "minute": (60_000_000, 60), "second": (1_000_000, 60)}[field]
    t = interval["micros"]
    whole = F.floor(F.abs(t) / unit) % of      # exact: a day has under 2^53 microseconds
    return (F.signum(t) * whole).cast("long")


def age_day_part(end: str | Column, start: str | Column) -> Column:
    """Day field of ``age(end, start)``, not the total number of days."""
    return interval_part("day", age(F.to_date(col(end)), F.to_date(col(start))))


def age_minute_part(end: str | Column, start: str | Column) -> Column:
    """Minute field (0..59, negative if ``end`` comes first) of ``age(end, start)``."""
    return interval_part("minute", age(end, start))


def whole_days_between(start: str | Column, end: str | Column) -> Column:
    """Days field of ``end - start`` for timestamps: whole elapsed days."""
    return F.timestamp_diff("DAY", col(start), col(end))


def weekday_name(c: str | Column, padded: bool = True) -> Column:
    """English weekday name; ``padded`` blank-pads to 9 like ``to_char 'Day'``."""
    name = F.date_format(col(c), "EEEE")
    return F.rpad(name, 9, " ") if padded else name


# Two-digit years: 70..99 are 19xx, 00..69 are 20xx (nearest to year 2020).
TWO_DIGIT_YEAR_PIVOT = 70


def parse_dmy2(c: str | Column) -> Column:
    """Parse ``d/M/yy`` text (single-digit day/month allowed) into a date."""
    d = F.to_date(col(c), "d/M/yy")
    return F.when(F.year(d) >= 2000 + TWO_DIGIT_YEAR_PIVOT, F.add_months(d, -1200)).otherwise(d)


def day_of_year_week(c: str | Column) -> Column:
    """Week number where days 1-7 of the year are week 1, 8-14 week 2, ..."""
    return F.ceil(F.dayofyear(col(c)) / F.lit(7)).cast("long")


def shifted_week_start(c: str | Column, offset_days: int) -> Column:
    """Start date of the 7-day period containing ``c`` when periods begin
    ``offset_days`` after a Monday (4 -> Friday-anchored weeks)."""
    d = F.to_date(col(c))
    monday = F.to_date(F.date_trunc("week", F.date_sub(d, offset_days)))
    return F.date_add(monday, offset_days)


def month_start(c: str | Column) -> Column:
    return F.trunc(F.to_date(col(c)), "month")


def id_list(c: str | Column, trim: bool = True) -> Column:
    """``'1, 4'`` -> array of text tokens; ``trim`` strips the blanks that
    follow each comma (``' 4'`` -> ``'4'``)."""
    tokens = F.split(col(c), ",")
    return F.transform(tokens, lambda t: F.trim(t)) if trim else tokens


def seeded_unit_draw(key: str | Column, seed: int, buckets: int) -> Column:
    """Deterministic pseudo-random draw in ``1..buckets`` per key.

    Two rounds of a 31-bit linear congruential step with an xor-shift in
    between; pure integer arithmetic, so it is independent of partitioning
    and reproducible in any SQL engine.
    """
    m = 2147483648
    h = ((col(key).cast("long") % m) * 1103515245 + 12345 + seed) % m
    h = h.bitwiseXOR(F.shiftright(h, 13))
    h = (h * 1103515245 + 12345) % m
    return 1 + F.shiftright(h * buckets, 31)


def sum_if(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)``: a long, NULL over no rows."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")
