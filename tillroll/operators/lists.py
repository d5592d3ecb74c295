"""Lists of ids stored as text: element frequencies, per-item labels,
per-item multiset algebra (recipe minus exclusions plus extras) and global
multiset totals.

Per-item set algebra, counting and naming run inside the row with array
functions (``array_except``, ``concat``, ``transform``) and a map lookup in
the fixed element dimension, so per-item results need no explode, join or
shuffle.
Global totals are aggregated per *pizza type* before meeting the recipe
dimension, so the recipe expansion costs (types x toppings) rows, not
(items x toppings).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sem
from . import multiset

EMPTY = "none"


def ids(c: str | Column) -> Column:
    """Integer ids of a cleaned list column (``'none'`` -> empty array);
    ids are separated by commas or blanks, non-numeric tokens dropped."""
    c = sem.col(c)
    # split on runs of commas and blanks, cast element-wise (bad tokens
    # -> NULL), drop NULLs: all codegen'd, no per-element lambda
    parsed = F.split(F.trim(c), r"[,\s]+").try_cast("array<int>")
    return F.when(c.isNull() | (c == EMPTY), F.array().cast("array<int>")).otherwise(F.array_compact(parsed))


def element_counts(df: DataFrame, list_col: str, names: DataFrame, id_col: str,
                   name_col: str, out: str) -> DataFrame:
    """How often each element occurs over all lists, by element name."""
    per_id = (df.filter(F.col(list_col) != EMPTY)
                .select(F.explode(ids(list_col)).alias(id_col))
                .groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")))
    return (per_id.join(names, id_col).groupBy(name_col)
                  .agg(F.sum("_n").alias(out)))


def name_lookup(rows: Sequence[tuple[int, str]]) -> Column:
    """A fixed id -> name dimension (a handful of code-defined rows) as a map
    expression: every task looks names up locally, no join or regrouping."""
    return F.create_map(*[F.lit(x) for r in rows for x in r])


def _names(id_array: Column, names: Column) -> Column:
    """``[4, 1]`` -> ``'Cheese, Bacon'`` (list order kept, unknown ids skipped)."""
    return F.array_join(F.transform(id_array, lambda x: F.try_element_at(names, x)), ", ")


def item_labels(items: DataFrame, item_keys: Sequence[str], kind_name: DataFrame,
                names: Sequence[tuple[int, str]], literal: bool = False) -> DataFrame:
    """``'<type> - Exclude a, b - Extra c'`` per item (``pizza_order``).

    ``items`` has ``item_keys``, ``pizza_id``, ``exclusions``, ``extras``
    (cleaned); ``kind_name`` maps pizza_id -> pizza_name; ``names`` are the
    (id, name) rows of the element dimension.  Names follow the order of ids
    in the text.  ``literal`` joins the three parts with single blanks even
    when a part is empty (trailing/double blanks).  One projection per item."""
    m = name_lookup(names)
    ex, ey = _names(ids("exclusions"), m), _names(ids("extras"), m)
    ex_text = F.when(ex != "", F.concat(F.lit("- Exclude "), ex))
    ey_text = F.when(ey != "", F.concat(F.lit("- Extra "), ey))
    if literal:
        label = F.concat_ws(" ", F.col("pizza_name"), F.coalesce(ex_text, F.lit("")), F.coalesce(ey_text, F.lit("")))
    else:
        label = F.concat_ws(" ", F.col("pizza_name"), ex_text, ey_text)
    return items.join(kind_name, "pizza_id").select(*item_keys, label.alias("pizza_order"))


def item_ingredients(items: DataFrame, item_keys: Sequence[str], recipes: DataFrame,
                     kind_name: DataFrame, names: Sequence[tuple[int, str]]) -> DataFrame:
    """``'<type>: 2x a, b, c'`` per item: recipe ids minus excluded ids (as a
    set), plus extra ids (as a multiset), counted, names sorted
    alphabetically, ``Nx `` before names that occur N > 1 times.  Items left
    with no ingredient are absent.  Set algebra, counting and naming all run
    inside the row (no explode, no shuffle)."""
    keys = list(item_keys)
    m = name_lookup(names)
    rec = recipes.select("pizza_id", F.array_distinct(ids("toppings")).alias("_base"))
    j = items.join(rec, "pizza_id").join(kind_name, "pizza_id")
    # remaining recipe ids (a set) and extra ids (a multiset) as their own
    # projection: the per-element expressions below read these columns
    # instead of re-parsing the text each time
    j = j.select(*keys, "pizza_name", F.array_except(F.col("_base"), ids("exclusions")).alias("_rem"),
                 ids("extras").alias("_ey"))
    rem, ey = F.col("_rem"), F.col("_ey")
    known = F.array(*[F.lit(i) for i, _ in names])
    # keep items with at least one named ingredient (reads only the id arrays)
    j = j.filter((F.size(F.array_intersect(rem, known)) > 0) | (F.size(F.array_intersect(ey, known)) > 0))

    def count(x):
        # occurrences of x: once if it survived in the recipe, plus its extras
        return F.array_contains(rem, x).cast("int") + F.size(ey) - F.size(F.array_remove(ey, x))
    # the dimension is fixed: one codegen'd count per element, emitted in
    # (name, id) order, so neither sorting nor lambdas run per row
    parts = []
    for i, name in sorted(names, key=lambda r: (r[1], r[0])):
        n = count(F.lit(i))
        parts.append(F.when(n > 1, F.concat(n.cast("string"), F.lit(f"x {name}")))
                      .when(n == 1, F.lit(name)))
    body = F.concat_ws(", ", *parts)
    return j.select(*keys, F.concat(F.col("pizza_name"), F.lit(": "), body).alias("ingredients_list"))


def ingredient_totals(items: DataFrame, recipes: DataFrame, names: DataFrame,
                      id_col: str, name_col: str, out: str) -> DataFrame:
    """Global multiset over all items: extras plus (recipe ids minus all excluded
    ids) -- ``EXCEPT ALL``, which subtracts counts and stops at zero -- counted per name.

    Items are counted per pizza type before meeting the recipe ids (types x
    toppings rows, not items x toppings), exclusions and extras per id; each
    of the three reads only the columns it needs, and each is a partial
    aggregate before a tiny shuffle."""
    with_recipe = items.join(recipes.select("pizza_id"), "pizza_id", "left_semi")
    per_type = with_recipe.groupBy("pizza_id").agg(F.count(F.lit(1)).alias("_items"))
    rec = recipes.select("pizza_id", F.explode(ids("toppings")).alias("id"))
    used = per_type.join(rec, "pizza_id").select("id", F.col("_items").alias(multiset.COUNT))
    base = multiset.counted(used, F.col(multiset.COUNT))

    def listed(c):
        return multiset.counted(with_recipe.filter(F.col(c) != EMPTY).select(F.explode(ids(c)).alias("id")))
    t = multiset.union_all(multiset.except_all(base, listed("exclusions")), listed("extras"))
    return (t.join(names.withColumnRenamed(id_col, "id"), "id").groupBy(name_col)
             .agg(F.sum(multiset.COUNT).cast("long").alias(out)))
