"""Retail queries over weekly sales: cleaning/enrichment, calendar checks,
totals, pivoted shares, ratio of sums, and before/after comparisons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sem
from ..operators import clean, shares, spine
from .oracle import round_ratio_sql, with_views
from .registry import query

# Business parameters.
WEEK_RANGE = (1, 60)                  # week numbers checked for gaps
BASELINE = dt.date(1998, 6, 15)       # first week of the "after" period (a Monday)
DIMENSIONS = ("region", "platform", "age_band", "demographic", "customer_type")


@query("clean_weekly_sales", with_views(f"""
    select week_date, week_number, month_number, calendar_year, region, platform, segment,
           age_band, demographic, customer_type, transactions, cast(sales as double) sales,
           {round_ratio_sql('sales', 'transactions', 2, num_scale=2)} avg_transaction
    from clean_weekly_sales""", "clean_weekly_sales"))
def clean_weekly_sales(weekly_sales: DataFrame) -> DataFrame:
    """Clean and enrich the raw weekly rows (one projection, no shuffle)."""
    return clean.clean_weekly_sales(weekly_sales).withColumn("sales", F.col("sales").cast("double"))


@query("clean_weekly_sales_day_weeks", with_views("""
    select week_date, cast((date_part('doy', week_date) + 6) // 7 as bigint) week_number, calendar_year, region, platform,
           segment, customer_type, transactions, cast(sales as double) sales from clean_weekly_sales""",
    "clean_weekly_sales"))
def clean_weekly_sales_day_weeks(weekly_sales: DataFrame) -> DataFrame:
    """The cleaned rows with weeks counted from January 1st (days 1-7 are week 1), as the question asks."""
    return clean.clean_weekly_sales(weekly_sales, week="day_of_year").select(
        "week_date", "week_number", "calendar_year", "region", "platform", "segment", "customer_type", "transactions",
        F.col("sales").cast("double").alias("sales"))


@query("weekday_of_week_date", with_views("""
    select distinct rpad(strftime(week_date, '%A'), 9, ' ') day_of_week from clean_weekly_sales""",
    "clean_weekly_sales"))
def weekday_of_week_date(clean_weekly_sales: DataFrame) -> DataFrame:
    """Weekday name(s) of the week dates."""
    return clean_weekly_sales.select(sem.weekday_name("week_date").alias("day_of_week")).distinct()


@query("missing_week_numbers", with_views(f"""
    select range week_number from range({WEEK_RANGE[0]}, {WEEK_RANGE[1] + 1}) a
    where not exists (select 1 from clean_weekly_sales d where d.week_number = a.range)""",
    "clean_weekly_sales"))
def missing_week_numbers(spark: SparkSession, clean_weekly_sales: DataFrame) -> DataFrame:
    """Week numbers of the range that never occur."""
    return spine.missing_in_range(spark, clean_weekly_sales, "week_number", *WEEK_RANGE)


@query("transactions_per_year", with_views("""
    select calendar_year, cast(sum(transactions) as bigint) total_transactions
    from clean_weekly_sales group by calendar_year order by calendar_year""", "clean_weekly_sales"))
def transactions_per_year(clean_weekly_sales: DataFrame) -> DataFrame:
    """Total transactions per calendar year."""
    return (clean_weekly_sales.groupBy("calendar_year")
            .agg(F.sum("transactions").alias("total_transactions")).orderBy("calendar_year"))


@query("sales_per_region_month", with_views("""
    select region, month_number, cast(sum(sales) as double) total_sales
    from clean_weekly_sales group by region, month_number order by region, month_number""",
    "clean_weekly_sales"))
def sales_per_region_month(clean_weekly_sales: DataFrame) -> DataFrame:
    """Total sales per region and month."""
    return (clean_weekly_sales.groupBy("region", "month_number")
            .agg(F.sum("sales").cast("double").alias("total_sales")).orderBy("region", "month_number"))


@query("transaction_rows_per_platform", with_views("""
    select platform, count(transactions) transaction_rows
    from clean_weekly_sales group by platform order by platform""", "clean_weekly_sales"))
def transaction_rows_per_platform(clean_weekly_sales: DataFrame) -> DataFrame:
    """Number of weekly rows with a transaction count, per platform."""
    return (clean_weekly_sales.groupBy("platform")
            .agg(F.count("transactions").alias("transaction_rows")).orderBy("platform"))


def _share_sql(group: str, dim: str, values: dict[str, str]) -> str:
    """Oracle: one pass of conditional sums per group."""
    cols = ",\n".join(
        f"{round_ratio_sql(f'100 * sum(sales) filter (where {dim} = {v!r})', 'sum(sales)', 2, 2, 2)} {name}"
        for name, v in values.items())
    return f"""select {group}, {cols} from clean_weekly_sales group by {group} order by {group}"""


PLATFORMS = {"retail_percentage": "Retail", "shopify_percentage": "Shopify"}
DEMOGRAPHICS = {"couples_percentage": "Couples", "families_percentage": "Families",
                "unknown_percentage": "Unknown"}


@query("platform_share_per_month", with_views(_share_sql("month_number", "platform", PLATFORMS),
                                              "clean_weekly_sales"))
def platform_share_per_month(clean_weekly_sales: DataFrame) -> DataFrame:
    """Share of each month's sales by platform."""
    return shares.pivot_shares(clean_weekly_sales, ["month_number"], "platform", "sales",
                               PLATFORMS).orderBy("month_number")


@query("demographic_share_per_year", with_views(_share_sql("calendar_year", "demographic", DEMOGRAPHICS),
                                                "clean_weekly_sales"))
def demographic_share_per_year(clean_weekly_sales: DataFrame) -> DataFrame:
    """Share of each year's sales by demographic."""
    return shares.pivot_shares(clean_weekly_sales, ["calendar_year"], "demographic", "sales",
                               DEMOGRAPHICS).orderBy("calendar_year")


def _retail_by(clean_weekly_sales, *dims):
    return (clean_weekly_sales.filter(F.col("platform") == "Retail").groupBy(*dims)
            .agg(F.sum("sales").cast("double").alias("sales_contribution"))
            .orderBy(F.desc("sales_contribution")))


def _retail_by_sql(dims: str) -> str:
    return with_views(f"""select {dims}, cast(sum(sales) as double) sales_contribution
        from clean_weekly_sales where platform = 'Retail' group by {dims}
        order by sales_contribution desc""", "clean_weekly_sales")


@query("retail_sales_by_age_band", _retail_by_sql("age_band"))
def retail_sales_by_age_band(clean_weekly_sales: DataFrame) -> DataFrame:
    """Retail sales per age band, largest first."""
    return _retail_by(clean_weekly_sales, "age_band")


@query("retail_sales_by_demographic", _retail_by_sql("demographic"))
def retail_sales_by_demographic(clean_weekly_sales: DataFrame) -> DataFrame:
    """Retail sales per demographic, largest first."""
    return _retail_by(clean_weekly_sales, "demographic")


@query("retail_sales_by_both", _retail_by_sql("age_band, demographic"))
def retail_sales_by_both(clean_weekly_sales: DataFrame) -> DataFrame:
    """Retail sales per age band and demographic, largest first."""
    return _retail_by(clean_weekly_sales, "age_band", "demographic")


AVG_TXN = {"retail_average_transactions": "Retail", "shopify_average_transactions": "Shopify"}


@query("ratio_of_sums_per_year", with_views(f"""
    select calendar_year, {", ".join(
        round_ratio_sql(f"sum(case when platform = '{v}' then sales end)",
                        f"sum(case when platform = '{v}' then transactions end)", 0, 2) + " " + n
        for n, v in AVG_TXN.items())}
    from clean_weekly_sales group by calendar_year order by calendar_year""", "clean_weekly_sales"))
def ratio_of_sums_per_year(clean_weekly_sales: DataFrame) -> DataFrame:
    """Average transaction size per platform and year as a ratio of totals."""
    return shares.ratio_of_sums(clean_weekly_sales, ["calendar_year"], "platform", AVG_TXN,
                                "sales", "transactions", 0).orderBy("calendar_year")


# ----------------------------------------------------- before / after the baseline
def _window_sql(weeks: int) -> tuple[str, str]:
    lo = (BASELINE - dt.timedelta(days=7 * weeks)).isoformat()
    hi = (BASELINE + dt.timedelta(days=7 * weeks)).isoformat()
    base = BASELINE.isoformat()
    return (f"week_date >= date '{lo}' and week_date < date '{base}'",
            f"week_date >= date '{base}' and week_date < date '{hi}'")


def _before_after_cols_sql() -> str:
    return f"""cast(before_sales as double) before_sales, cast(after_sales as double) after_sales,
        cast(after_sales - before_sales as double) sales_change,
        {round_ratio_sql('100 * (after_sales - before_sales)', 'before_sales', 2, 2, 2)} change_pct"""


def _before_after_sql(weeks: int) -> str:
    before, after = _window_sql(weeks)
    return with_views(f"""with a as (
        select sum(case when {before} then sales end) before_sales,
               sum(case when {after} then sales end) after_sales from clean_weekly_sales)
        select {_before_after_cols_sql()} from a""", "clean_weekly_sales")


def _window(weeks: int, baseline: dt.date = BASELINE):
    d = F.col("week_date")
    lo, hi = baseline - dt.timedelta(days=7 * weeks), baseline + dt.timedelta(days=7 * weeks)
    return ((d >= F.lit(lo)) & (d < F.lit(baseline)), (d >= F.lit(baseline)) & (d < F.lit(hi)))


def _before_after(clean_weekly_sales, weeks, baseline):
    before, after = _window(weeks, baseline)
    rows = clean_weekly_sales.filter(before | after)
    return shares.before_after(rows, [], before, after, "sales")


@query("before_after_change", _before_after_sql(4))
def before_after_change(clean_weekly_sales: DataFrame, baseline=BASELINE, weeks=4) -> DataFrame:
    """Sales in the ``weeks`` weeks before vs from the baseline week on."""
    return _before_after(clean_weekly_sales, weeks, baseline)


@query("before_after_change_12w", _before_after_sql(12))
def before_after_change_12w(clean_weekly_sales: DataFrame, baseline=BASELINE) -> DataFrame:
    """Same comparison over 12 weeks each side."""
    return _before_after(clean_weekly_sales, 12, baseline)


BASELINE_WEEK = BASELINE.isocalendar()[1]


def _by_year_sql(weeks: int) -> str:
    return with_views(f"""with a as (
    select calendar_year,
           sum(case when week_number between {BASELINE_WEEK - weeks} and {BASELINE_WEEK - 1} then sales end)
               before_sales,
           sum(case when week_number between {BASELINE_WEEK} and {BASELINE_WEEK + weeks - 1} then sales end)
               after_sales
    from clean_weekly_sales group by calendar_year)
    select calendar_year, {_before_after_cols_sql()} from a""", "clean_weekly_sales")


@query("before_after_by_year", _by_year_sql(12))
def before_after_by_year(clean_weekly_sales: DataFrame, baseline=BASELINE, weeks=12) -> DataFrame:
    """The ``weeks`` weeks before vs after the baseline's ISO week, in every year.  Weeks are counted from the
    date of that week in the year, so a window that reaches into a neighbouring year loses none (up to 26 weeks,
    when no date is in two windows)."""
    week = baseline.isocalendar()[1]

    def place(shift):   # the row as seen from the baseline of its year + shift
        year = F.col("calendar_year") + shift
        start = F.to_date(F.date_trunc("week", F.make_date(year.cast("int"), F.lit(1), F.lit(4)))) + F.lit(7 * (week - 1)).cast("int")
        off = F.floor(F.datediff("week_date", start) / 7)
        return F.struct(year.alias("year"), off.alias("off"), F.lit(shift).alias("shift"))
    near = F.filter(F.array(*[place(k) for k in (-1, 0, 1)]),
                    lambda x: (x["shift"] == 0) | ((x["off"] >= -weeks) & (x["off"] < weeks)))
    rows = clean_weekly_sales.select("sales", F.inline(near)).withColumnRenamed("year", "calendar_year")
    off = F.col("off")
    return shares.before_after(rows, ["calendar_year"], off.between(-weeks, -1), off.between(0, weeks - 1), "sales")


@query("before_after_by_year_4w", _by_year_sql(4))
def before_after_by_year_4w(clean_weekly_sales: DataFrame, baseline=BASELINE) -> DataFrame:
    """The 4 weeks before vs after the baseline's week number, in every year."""
    return before_after_by_year(clean_weekly_sales, baseline, weeks=4)


def _dimension_sql() -> str:
    before, after = _window_sql(12)
    arms = " union all ".join(
        f"select '{d}' dimension, {d} value, week_date, sales from clean_weekly_sales" for d in DIMENSIONS)
    return with_views(f"""with u as ({arms}), a as (
        select dimension, value, sum(case when {before} then sales end) before_sales,
               sum(case when {after} then sales end) after_sales
        from u where ({before}) or ({after}) group by dimension, value)
        select dimension, value, {_before_after_cols_sql()} from a
        order by change_pct, dimension, value""", "clean_weekly_sales")


@query("before_after_by_dimension", _dimension_sql())
def before_after_by_dimension(clean_weekly_sales: DataFrame,
                              baseline=BASELINE,
                              weeks=12,
                              dimensions=DIMENSIONS) -> DataFrame:
    """12 weeks before vs after the baseline, per value of every business
    dimension, worst change first.  One pass: each row is fanned out to
    (dimension, value) pairs and aggregated once."""
    before, after = _window(weeks, baseline)
    rows = clean_weekly_sales.filter(before | after)
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions])
    fanned = rows.select("week_date", "sales", F.inline(pairs))
    return (shares.before_after(fanned, ["dimension", "value"], before, after, "sales")
            .orderBy("change_pct", "dimension", "value"))
