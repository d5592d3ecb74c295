"""Binary search in a sorted array by one expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_at_most(df: DataFrame, sorted_array: Column, x: Column, out: str, longest: int,
                  strictly: bool = False) -> DataFrame:
    """Add ``out``: how many elements of ``sorted_array`` (``longest`` at most) are <= ``x`` (``strictly``: < ``x``).

    Jumps of falling powers of two, each taken if the element it lands on still
    qualifies: one comparison per binary digit of ``longest``, in an expression of
    fixed size (Catalyst copies expressions into pushed filters, so one that
    grew with every digit would not do).  ``sorted_array`` is a constant or a scalar
    subquery; a NULL one counts as empty.
    """
    jumps = [1 << i for i in reversed(range(max(1, longest).bit_length()))]
    own = f"_sorted_{out}"   # a lambda may not name a subquery itself

    def jump(at, step):
        element = F.get(F.col(own), at + step - 1)   # NULL beyond the end
        return F.when(element < x if strictly else element <= x, at + step).otherwise(at)
    return df.withColumn(own, sorted_array).withColumn(
        out, F.aggregate(F.array(*[F.lit(j) for j in jumps]), F.lit(0), jump)).drop(own)
