"""States as of many points in time.

``as_of`` joins each probe (key, time) with the state of its key in force then:
probes and events are laid in one order per key and the last state is carried
along, so the join costs one pass over both, however many events a key has (hot keys are cut,
see ``sequence``).

``counts_at`` asks how many keys are in each state at every date of a table.
An event's state holds from the first date at or after it to the first date at
or after the key's next event; both ends are counted per (state, date) and summed
up along the dates.  The work is one pass over the events, not events x dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.search import count_at_most
from . import sequence

MOST_DATES = 1 << 16


def as_of(probes: DataFrame, events: DataFrame, key: str, probe_time: str, event_time: str, order_cols: Sequence[str],
          state_cols: Sequence[str], rows: int | None = None) -> DataFrame:
    """``probes`` with ``state_cols`` of the last event of their key (by ``order_cols``, the first of
    which is ``event_time``) with ``event_time <= probe_time``; NULL if there is none.  A NULL key is a key;
    a probe at NULL has no state."""
    if order_cols[0] != event_time:
        raise ValueError("events are ordered by their time first")
    rest = list(order_cols[1:])
    held = F.struct(*[F.col(c).alias(c) for c in state_cols])
    none = events.select(held.alias("_state")).schema["_state"].dataType
    given = F.struct(*[F.col(c).alias(c) for c in probes.columns])
    kind = probes.select(given.alias("_probe")).schema["_probe"].dataType
    flat = events.where(F.col(event_time).isNotNull()).select(
        F.col(key).alias("_k"), F.col(event_time).alias("_t"), F.lit(0).alias("_after"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(rest)], held.alias("_state"), F.lit(None).cast(kind).alias("_probe"))
    asked = probes.select(
        F.col(key).alias("_k"), F.col(probe_time).alias("_t"), F.lit(1).alias("_after"),
        *[F.lit(None).cast(events.schema[c].dataType).alias(f"_o{i}") for i, c in enumerate(rest)],
        F.lit(None).cast(none).alias("_state"), given.alias("_probe"))
    # probes of one time come after its events, in any order among themselves
    both = flat.unionByName(asked).withColumn("_any", F.xxhash64("_probe"))
    order = ["_t", "_after", *[f"_o{i}" for i in range(len(rest))], "_any"]
    seq = sequence.place(order)

    def last(column):
        return lambda w: F.last(column, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found, cut = sequence.scan(
        both, ["_k"], order, [{"_now": last("_state")}],
        lambda d, g: d.groupBy(*g).agg(F.max_by("_state", F.when(F.col("_state").isNotNull(), seq)).alias("_end")),
        [{"_before": lambda w: F.last("_end", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))}], rows)
    state = F.coalesce("_now", "_before") if cut else F.col("_now")
    state = F.when(F.col("_t").isNotNull(), state)
    return found.where(F.col("_probe").isNotNull()).select(
        *[F.col(f"_probe.{c}").alias(c) for c in probes.columns], *[state[c].alias(c) for c in state_cols])


def counts_at(events: DataFrame, dates: DataFrame, key: str, time_col: str, order_cols: Sequence[str], state: str,
              date_col: str, out: str, rows: int | None = None) -> DataFrame:
    """``date_col``, ``state``, ``out``: for every distinct date (``MOST_DATES`` at most) how many keys are in each
    state then, states of no key left out.  As ``lifecycle.snapshot_as_of`` for each date by itself."""
    listed = dates.agg(F.sort_array(F.collect_set(F.col(date_col))).alias("d")).scalar()
    e = events.where(F.col(time_col).isNotNull()).select(key, *order_cols, state)
    e = sequence.previous_value(e, key, order_cols, time_col, "_next", rows, descending=True)

    def first_at_or_after(df: DataFrame, t: str, name: str) -> DataFrame:
        return count_at_most(df, listed, F.col(t), name, MOST_DATES, strictly=True)
    e = first_at_or_after(first_at_or_after(e, time_col, "_from"), "_next", "_to")
    e = e.withColumn("_to", F.when(F.col("_next").isNotNull(), F.col("_to")))
    held = e.where(F.col("_to").isNull() | (F.col("_from") < F.col("_to")))
    ends = held.select(state, F.explode(F.array(
        F.struct(F.col("_from").alias("at"), F.lit(1).alias("n")), F.struct(F.col("_to").alias("at"), F.lit(-1).alias("n")))).alias("x"))
    change = ends.where("x.at is not null").groupBy(state, F.col("x.at").alias("_at")).agg(F.sum("x.n").alias("_n"))
    # a state has one row per date at most here
    grid = change.select(state).distinct().select(state, F.posexplode(listed).alias("_at", date_col))
    same = [grid[state].eqNullSafe(change[state]), grid["_at"] == change["_at"]]
    so_far = Window.partitionBy(state).orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = grid.join(change, same, "left").select(grid[state], F.col(date_col), F.coalesce("_n", F.lit(0)).alias("_n"))
    return (filled.withColumn(out, F.sum("_n").over(so_far)).where(F.col(out) > 0)
            .select(date_col, state, F.col(out).cast("long").alias(out)))


def every_day(first: Column, last: Column) -> Column:
    """The midnights from ``first`` to ``last`` (zone-less timestamps)."""
    return F.explode(F.sequence(F.to_date(first), F.to_date(last)).cast("array<timestamp_ntz>"))
