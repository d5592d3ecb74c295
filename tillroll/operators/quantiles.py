"""Exact continuous percentiles (``percentile_cont``) by distributed selection.

``percentile(x, p)`` keeps every value of a group in one buffer, and a window
sorts them in one task.  Here the two order statistics around ``p * (n - 1)``
are found by narrowing the range they lie in:

1. values are counted per ``(group, value)`` (partial aggregation before the
   shuffle); all that follows reads this one exchange;
2. a mergeable sketch over these entries gives ``BINS`` cuts of the value axis
   with about equally many entries between two of them, whatever the
   distribution and however the groups share it;
3. rows are counted per group and bin; a window over a group's bins (``BINS`` at
   most) tells which bins hold the wanted positions, two per percentile;
4. only the entries of these bins are ordered: about 1 / ``BINS`` of all
   entries each, also for doubles that never repeat.

The cuts only say where to look: counts are exact, so results don't depend on
the sketch.  Of a table that Catalyst knows to be smaller than one bucket of
``sequence``, all entries of a group are such a bin: steps 2 and 3 are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.search import count_at_most
from . import sequence

BINS = 2048


def percentile_cont(df: DataFrame, groups: Sequence[str], value: str,
                    probs: Mapping[str, float], bins: int | None = None) -> DataFrame:
    """One row per group with a double column per ``probs`` entry
    (``name -> p``), equal to ``percentile_cont(p) within group (order by value)``.
    NULL values are ignored; NULL is a group of its own.  ``bins`` asks for that many."""
    groups = list(groups)
    hist = (df.where(F.col(value).isNotNull())
              .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n")))
    of_group = Window.partitionBy(*groups)

    def positions(p):
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        return pos, F.floor(pos), F.ceil(pos)
    if bins is None and sequence.is_small(df):
        found = hist.withColumns({"_bin": F.lit(0), "_before": F.lit(0), "_total": F.sum("_n").over(of_group)})
    else:
        found = _wanted_entries(hist, groups, value, [t for p in probs.values() for t in positions(p)[1:]], bins or BINS)
    inside = Window.partitionBy(*groups, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.select(
        *groups, F.col(value).cast("double").alias("_v"),
        (F.col("_before") + F.sum("_n").over(inside)).alias("_end"),       # 0-based positions < _end
        "_total")
    aggs = []
    for name, p in probs.items():
        pos, lo, hi = positions(p)
        aggs += [F.min(F.when(F.col("_end") > lo, F.col("_v"))).alias(f"_{name}_lo"),
                 F.min(F.when(F.col("_end") > hi, F.col("_v"))).alias(f"_{name}_hi"),
                 F.max(pos - lo).alias(f"_{name}_f")]
    picked = found.groupBy(*groups).agg(*aggs)
    return picked.select(*groups, *[
        (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_f")).alias(n)
        for n in probs])


def _wanted_entries(hist: DataFrame, groups: list[str], value: str, targets: list[Column], bins: int) -> DataFrame:
    """The entries of the bins that hold a position of ``targets``, with ``_bin``, ``_before`` (rows of the group before the bin)
    and ``_total`` (rows of the group)."""
    sketch = F.percentile_approx(value, [i / bins for i in range(1, bins)], 4 * bins).alias("cuts")
    cuts = hist.agg(F.struct(sketch, F.sum("_n").alias("n"))).scalar()["cuts"]   # the count: the same exchange is read
    binned = count_at_most(hist, cuts, F.col(value), "_bin", bins)

    sizes = binned.groupBy(*groups, "_bin").agg(F.sum("_n").alias("_rows"))
    of_group = Window.partitionBy(*groups)
    earlier = of_group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns({"_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
                               "_total": F.sum("_rows").over(of_group)})

    holds = [(t >= F.col("_before")) & (t < F.col("_before") + F.col("_rows")) for t in targets]
    wanted = sizes.where(reduce(or_, holds)).select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_bin").alias("_wanted"), "_before", "_total")
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    return binned.join(wanted, [*same, F.col("_bin") == F.col("_wanted")])
