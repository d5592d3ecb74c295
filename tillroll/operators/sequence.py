"""Ordered sequences per key: previous value (LAG), row numbers, ranks, running
sums, runs of equal values (gaps and islands).

The plain form is one window ``PARTITION BY key ORDER BY ...``; a hot key then
sorts in one task.  Here keys with many rows are cut into *buckets*, ranges of
their order, found without any hint from the caller:

1. a sample of (key, order), one row in ``BUCKET_ROWS / PER_BUCKET`` by hash,
   shows which keys hold two buckets or more and where to cut them.  A table that
   takes fewer bytes than a bucket has rows isn't sampled; without such a key the
   plan is the plain window: one scan, one exchange;
2. otherwise a row finds its bucket by binary search in the bounds, and the
   windows run per (key, bucket);
3. each bucket of a cut key leaves one carry row (its first and last value, its
   sums).  They are scanned once per key, and what a bucket takes over from the
   ones before it is joined back by the bucket's number.  There are as many carry
   rows as bounds, so they are broadcast.

Results don't depend on where the cuts are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.search import count_at_most

BUCKET_ROWS = 4_000_000
PER_BUCKET = 8           # sampled rows of a bucket
BUCKET = "_bucket"
_BEFORE = Window.unboundedPreceding
_SO_FAR = (_BEFORE, Window.currentRow)
_EARLIER = (_BEFORE, -1)

# name -> column of a window; later steps may use the names of earlier ones
Steps = Sequence[Mapping[str, Callable]]


def keys_of(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def in_order(order_cols: Sequence[str], descending: bool = False) -> list[Column]:
    """SQL's default NULL placement: last when ascending, first when descending."""
    return [F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in order_cols]


def place(order_cols: Sequence[str]) -> Column:
    """The ascending order as a comparable struct (NULL flag before each value, so NULLs sort last)."""
    return F.struct(*[x for i, c in enumerate(order_cols)
                      for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])


def _bytes_at_most(df: DataFrame) -> float:
    """Catalyst's estimate of the table's size; unknown is endless."""
    try:
        return float(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # no plan on this side (a remote session)
        return float("inf")


def is_small(df: DataFrame, rows: int | None = None) -> bool:
    """Whether the table takes fewer bytes than a bucket has rows, by Catalyst's estimate: no job is run to find out."""
    return _bytes_at_most(df) < (rows or BUCKET_ROWS)


def with_buckets(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], rows: int | None = None,
                 sample: DataFrame | None = None) -> tuple[DataFrame, int]:
    """(``df`` with ``_bucket``, number of bounds): the bucket of rows whose key is cut, ascending along
    (key, order); NULL for rows of all other keys.  Without bounds ``df`` comes back as it is.

    ``sample`` is where bounds are sampled from (default ``df``): a table with
    the same keys and order values that costs less to read.
    """
    rows = rows or BUCKET_ROWS
    source = df if sample is None else sample
    if is_small(source, rows):
        return df, 0
    fields = [x for i, k in enumerate(keys) for x in (F.col(k).isNull().alias(f"kn{i}"), F.col(k).alias(f"kv{i}"))]
    at = F.struct(*fields, F.lit(1).alias("real"), place(order_cols).alias("at"))
    # one row in rows / PER_BUCKET: the driver holds PER_BUCKET small rows for each bucket of data
    seen = (source.select(at.alias("p")).where(F.pmod(F.xxhash64("p"), F.lit(max(1, rows // PER_BUCKET))) == 0)
            .distinct().orderBy("p").collect())
    width, bounds = 2 * len(keys), []
    for _, group in groupby(seen, key=lambda r: tuple(r["p"][:width])):
        points = [tuple(r["p"]) for r in group]
        if len(points) >= 2 * PER_BUCKET:
            first = points[0]
            bounds += [(*first[:width], 0, first[width + 1]), *points[PER_BUCKET::PER_BUCKET]]   # 0: before all
    if not bounds:
        return df, 0
    fields = df.select(at.alias("p")).schema["p"].dataType
    listed = F.array(*[_literal(b, fields) for b in bounds])   # folded to one constant
    found = count_at_most(df.withColumn("_at", at), listed, F.col("_at"), "_no", len(bounds))
    own = F.get(listed, F.col("_no") - 1)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & own[f"kv{i}"].eqNullSafe(F.col(k))
    return found.withColumn(BUCKET, F.when((F.col("_no") > 0) & same, F.col("_no"))).drop("_no", "_at"), len(bounds)


def _literal(value, kind: T.DataType) -> Column:
    """A constant of type ``kind`` (a struct: field by field)."""
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)])
    if isinstance(value, dt.date):   # as text: no time zone comes in
        value = str(value)
    return F.lit(value).cast(kind)


def _apply(df: DataFrame, steps: Steps, window) -> DataFrame:
    for step in steps:
        df = df.withColumns({name: column(window) for name, column in step.items()})
    return df


def scan(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], local: Steps,
         summary: Callable[[DataFrame, list[str]], DataFrame], carried: Steps, rows: int | None = None,
         descending: bool = False, sample: DataFrame | None = None, cut_by: Sequence[str] = (),
         lanes: Column | None = None) -> tuple[DataFrame, bool]:
    """(``df`` with the columns of ``local``, whether any key is cut).  The columns of ``local`` are computed by a window
    over (key, bucket).  If a key is cut, the columns of the carry rows are added (NULL for keys of one bucket).

    ``summary(rows, group)`` makes one carry row per bucket, grouped by
    ``group``; ``carried`` are columns over a key's carry rows in order.
    ``cut_by`` are further order columns that only say where to cut.  If a
    key is cut, rows with a value of ``lanes`` go by it instead of a bucket: rows whose result nobody reads.
    """
    keys = list(keys)
    b, bounds = with_buckets(df, keys, [*order_cols, *cut_by], rows, sample)
    order = in_order(order_cols, descending)
    if not bounds:
        return _apply(b, local, Window.partitionBy(*keys).orderBy(*order)), False
    if lanes is not None:   # numbers below all buckets, so no carry row meets them
        b = b.withColumn(BUCKET, F.coalesce(-1 - lanes, F.col(BUCKET)))
    # an exchange of its own: rows that already lie together by key would stay so
    b = b.repartition(*keys, BUCKET)
    window = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    carry = _carry(_apply(b.where(F.col(BUCKET) > 0), local, window), keys, summary, carried, descending)
    carry = carry.withColumnRenamed(BUCKET, "_of").drop(*keys)
    out = _apply(b, local, window)
    return out.join(F.broadcast(carry), F.col(BUCKET) == F.col("_of"), "left").drop(BUCKET, "_of"), True   # rows <= bounds


def _carry(cut_rows: DataFrame, keys: list[str], summary, carried: Steps, descending: bool) -> DataFrame:
    along = Window.partitionBy(*keys).orderBy(F.col(BUCKET).desc() if descending else F.col(BUCKET).asc())
    return _apply(summary(cut_rows, [*keys, BUCKET]), carried, along)


def previous_value(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str], value: str, out: str,
                   rows: int | None = None, descending: bool = False) -> DataFrame:
    """Add ``out`` = ``lag(value) over (partition by key order by order_cols)``
    (``descending``: of the reversed order, which is LEAD);
    ``order_cols`` must be a total order within ``key``."""
    seq = place(order_cols)
    res, cut = scan(df, keys_of(key), order_cols,
                    [{out: lambda w: F.lag(value).over(w), "_first": lambda w: F.row_number().over(w) == 1}],
                    lambda d, g: d.groupBy(*g).agg((F.min_by if descending else F.max_by)(value, seq).alias("_last")),
                    [{"_earlier": lambda w: F.lag("_last").over(w)}], rows, descending)
    if cut:
        res = res.withColumn(out, F.when(F.col("_first"), F.col("_earlier")).otherwise(F.col(out)))
    return res.drop("_first", "_earlier", "_last")


def prefix_sum(df: DataFrame, keys: str | Sequence[str], order_cols: Sequence[str], weight: str | Column, out: str,
               descending: bool = False, rows: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over the rows before each row in its
    key (by ``order_cols``, a total order, NULLs as SQL places them; 0 for the first)."""
    total = F.col(weight) if isinstance(weight, str) else weight
    zero = F.lit(0)
    res, cut = scan(df, keys_of(keys), order_cols,
                    [{"_inside": lambda w: F.coalesce(F.sum(total).over(w.rowsBetween(*_EARLIER)), zero)}],
                    lambda d, g: d.groupBy(*g).agg(F.sum(total).alias("_sum")),
                    [{"_before": lambda w: F.sum("_sum").over(w.rowsBetween(*_EARLIER))}], rows, descending)
    before = F.coalesce("_before", zero) if cut else zero
    return res.withColumn(out, F.col("_inside") + before).drop("_inside", "_before", "_sum")


def row_number(df: DataFrame, keys: str | Sequence[str], order_cols: Sequence[str], out: str, descending: bool = False,
               rows: int | None = None) -> DataFrame:
    """Add ``out`` = ``row_number() over (partition by keys order by order_cols)`` (long) under a total order."""
    res = prefix_sum(df, keys, order_cols, F.lit(1), out, descending, rows)
    return res.withColumn(out, (F.col(out) + 1).cast("long"))


def rank(df: DataFrame, keys: str | Sequence[str], order_col: str, out: str, descending: bool = False,
         rows: int | None = None, sample: DataFrame | None = None, lanes: Column | None = None) -> DataFrame:
    """Add ``out`` = ``rank() over (partition by keys order by order_col)`` (long), NULLs as SQL places them.

    Rows that tie may lie in several buckets (cuts also go by a hash of the
    row): a bucket that begins with the value the one before ended with takes over
    the rank where that value began.
    """
    keys = keys_of(keys)
    tie = "_tie"
    hashed = df.withColumn(tie, F.xxhash64(*[c for c in df.columns if not _has_map(df.schema[c].dataType)]))

    def summary(d, group):
        counts = d.groupBy(*group, order_col).agg(F.count(F.lit(1)).alias("_n"))
        at = place([order_col])
        ends = [F.min(at), F.max(at)][::-1 if descending else 1]
        last_n = (F.min_by if descending else F.max_by)("_n", at)
        return counts.groupBy(*group).agg(F.sum("_n").alias("_rows"), ends[0].alias("_f"), ends[1].alias("_l"),
                                          last_n.alias("_last_n"))
    carried = [
        {"_offset": lambda w: F.coalesce(F.sum("_rows").over(w.rowsBetween(*_EARLIER)), F.lit(0)),
         "_prev": lambda w: F.lag("_l").over(w)},
        # where the bucket's last value began: NULL if in an earlier bucket
        {"_began": lambda w: F.when(~((F.col("_f") == F.col("_l")) & F.col("_f").eqNullSafe(F.col("_prev"))),
                                    F.col("_offset") + F.col("_rows") - F.col("_last_n") + 1)},
        {"_tied": lambda w: F.last("_began", ignorenulls=True).over(w.rowsBetween(*_EARLIER))},
    ]
    res, cut = scan(hashed, keys, [order_col], [{"_rank": lambda w: F.rank().over(w).cast("long")}], summary, carried, rows,
                    descending, _with_tie(sample, tie), [tie], lanes)
    ranked = F.col("_rank")
    if cut:
        goes_on = F.coalesce(place([order_col]) == F.col("_prev"), F.lit(False))
        ranked = F.when(goes_on, F.col("_tied")).otherwise(ranked + F.coalesce("_offset", F.lit(0)))
    return res.select(*df.columns, ranked.alias(out))


def _with_tie(sample: DataFrame | None, tie: str) -> DataFrame | None:
    """Any even spread of the ties serves for choosing cuts."""
    return None if sample is None else sample.withColumn(tie, F.xxhash64(*sample.columns))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind.fields)


def islands(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str], value: str, out: str = "run_id",
            rows: int | None = None, first: Mapping[str, str] | None = None) -> DataFrame:
    """Number the runs of equal ``value`` per key: consecutive rows (in
    ``order_cols`` order, a total order) with the same value share a run id 1, 2, 3, ...

    Equal to the row-by-row recursive walk that increments the run id when
    ``previous <> current`` is true (a NULL on either side continues the run,
    as the SQL comparison is then not true).  ``first`` (new column -> column)
    adds values of the key's first row to all its rows.
    """
    first, seq = dict(first or {}), place(order_cols)
    changed = {"_changed": lambda w: F.when(F.lag(value).over(w) != F.col(value), 1).otherwise(0)}
    local = [changed, {"_inside": lambda w: F.sum("_changed").over(w.rowsBetween(*_SO_FAR)),
                       **{c: lambda w, v=v: F.first(v).over(w.rowsBetween(*_SO_FAR)) for c, v in first.items()}}]

    def summary(d, group):
        return d.groupBy(*group).agg(
            F.min_by(value, seq).alias("_f"), F.max_by(value, seq).alias("_l"), F.sum("_changed").alias("_runs"),
            *[F.min_by(v, seq).alias(f"_first_{c}") for c, v in first.items()])
    carried = [
        {"_opens": lambda w: F.when(F.lag("_l").over(w) != F.col("_f"), 1).otherwise(0)},
        {"_before": lambda w: (F.sum("_opens").over(w.rowsBetween(*_SO_FAR))
                               + F.coalesce(F.sum("_runs").over(w.rowsBetween(*_EARLIER)), F.lit(0))),
         **{f"_key_{c}": lambda w, c=c: F.first(f"_first_{c}").over(w.rowsBetween(*_SO_FAR)) for c in first}},
    ]
    res, cut = scan(df, keys_of(key), order_cols, local, summary, carried, rows)
    run, of_key = 1 + F.col("_inside"), {c: F.col(c) for c in first}
    if cut:
        whole = F.col("_before").isNull()   # the key has one bucket
        run = run + F.coalesce("_before", F.lit(0))
        of_key = {c: F.when(whole, F.col(c)).otherwise(F.col(f"_key_{c}")) for c in first}
    own = [c for c in df.columns if c != out and c not in first]
    return res.select(*own, *[x.alias(c) for c, x in of_key.items()], run.cast("long").alias(out))


def run_totals(df: DataFrame, key: str, order_cols: Sequence[str], value: str, measure: str, out: str,
               carry: Sequence[str] = (), first: Mapping[str, str] | None = None, rows: int | None = None) -> DataFrame:
    """One row per run of equal ``value`` (runs as in ``islands``): ``key``,
    ``carry`` (their values in the run's first row), ``first`` (new column -> column: its value in
    the key's first row) and ``out``, the sum of ``measure`` over the run.

    The grouping by run follows the key, so it needs no exchange of its own
    unless a key was cut."""
    numbered = islands(df, key, order_cols, value, "_run", rows, first)
    seq = place(order_cols)
    of_key = [F.first(c).alias(c) for c in first or {}]
    return (numbered.groupBy(key, "_run").agg(*[F.min_by(c, seq).alias(c) for c in carry], *of_key, F.sum(measure).alias(out))
            .select(key, *carry, *(first or {}), out))
