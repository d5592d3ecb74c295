"""Mixing sources to target weights by Pareto order sampling.

A source's target decides how often its documents are taken on average (its
rate); a document's own rate lies above or below by its preference, so that
the rates of a source, weighed by size, add up to its target exactly.  Every
document first gets the certain whole copies floor(rate); for the rest
documents are ranked by their random odds over their inclusion odds,
``(u / (1 - u)) / (p / (1 - p))`` with p the fraction left of the document's
rate, and taken in that order until the source's words are reached.  A
document that would overshoot is passed over and the rest of the order filled
again with smaller gaps, so the words taken end close to the target.  u is a
hash of the row, so reruns agree.

Where a source's words end in its order is found by selection: words are
added up in equal slices of the order, and the slice that holds the end is cut
into slices again until it has few rows.  Only these rows are ever sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.chunks import own_columns
from tillroll.llm.graph import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
MIDDLE = 256  # words of a document whose preference is one half
STEPS = 1000  # preferences are whole steps of 1 / STEPS, so that sums over a source are exact
SLICES = 1024  # a power of two: slices of slices have exact ends
SORTED = 50_000  # rows of one source that a task sorts
NEAR = 0.001  # filling goes on while a source that a further document fits is short by more than this share
FEW_SOURCES = 100_000  # tables of one small row per source are broadcast up to this many, shuffled beyond


def source_targets(sources: DataFrame, weights=WEIGHTS, most: int = MAX_COPIES, share: float = 1.0) -> DataFrame:
    """(source, source_size) -> (source, source_size, number, target).

    Sources are numbered in code-point order, NULL last, and weigh ``weights``
    in turn.  Targets share ``share`` of all sizes by weight; none exceeds
    ``most`` times its source, what is over goes to the others by weight.
    Numbers come from a range partitioning, so no task sees all sources.
    """
    spread = cut(sources.withColumn("none", F.col("source").isNull()).repartitionByRange("none", "source")
                 .withColumn("part", F.spark_partition_id()))
    before, offset = 0, {}
    for r in spread.groupBy("part").count().orderBy("part").collect():  # one row per partition
        offset[r["part"]] = before
        before += r["count"]
    if not offset:
        return sources.withColumn("number", F.lit(0).cast("long")).withColumn("target", F.lit(0.0))
    shift = F.element_at(F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]), F.col("part"))
    w = Window.partitionBy("part").orderBy("none", "source")
    turn = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                        (F.col("number") % len(weights) + 1).cast("int"))
    s = cut(spread.withColumn("number", F.row_number().over(w).cast("long") + shift - 1)
            .withColumn("weight", turn).drop("part", "none"))
    limit = F.col("source_size") * float(most)
    level, full = 0.0, -1
    while True:  # raise the level until no further source is full
        is_full = F.col("weight") * level >= limit if full >= 0 else F.lit(False)
        a = s.agg(F.sum("source_size"), F.sum(F.when(is_full, limit)), F.sum(F.when(~is_full, F.col("weight"))),
                  F.count_if(is_full)).first()
        if a[3] == full or not a[2]:
            break
        full = a[3]
        level = (float(a[0]) * share - float(a[1] or 0)) / float(a[2])
    return s.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), limit)).drop("weight")


def _preference(preference):
    """The preference in whole steps, 0 to ``STEPS``; by default longer documents are preferred."""
    chosen = F.col("size") / (F.col("size") + MIDDLE) if preference is None else preference.cast("double")
    return F.coalesce(F.floor(F.least(F.greatest(chosen, F.lit(0.0)), F.lit(1.0)) * STEPS), F.lit(0)).cast("long")


def _ends(near: DataFrame, gaps: DataFrame, of_source) -> DataFrame:
    """(number, gap, low, width, before): the words of the rows that fit reach the gap within [low, low + width)
    of the order, ``before`` of them lie below; low is 2 where they do not reach it at all.

    Every round adds up the words of at most ``SLICES`` slices a source, so it needs no sort.
    """
    state = gaps.where("gap > 0").select("number", "gap", F.lit(0.0).alias("low"), F.lit(1.0).alias("width"),
                                         F.lit(0).cast("long").alias("before"))
    upto = Window.partitionBy("number").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = 1.0
    while True:
        inside = near.where("fit is not null").join(of_source(state), "number").where(
            (F.col("order") >= F.col("low")) & (F.col("order") < F.col("low") + F.col("width")))
        slices = (inside.withColumn("slice", F.floor((F.col("order") - F.col("low")) / F.col("width") * SLICES))
                  .groupBy("number", "gap", "low", "width", "before", "slice")
                  .agg(F.sum("fit").alias("words"), F.count(F.lit(1)).alias("rows"))
                  .withColumn("upto", F.col("before") + F.sum("words").over(upto)))
        crossing = (slices.where("upto > gap").groupBy("number")
                    .agg(F.min_by(F.struct("slice", "words", "rows", "upto"), "slice").alias("c")))
        narrow = F.col("width") / SLICES
        state = cut(state.join(crossing, "number", "left").select(
            "number", "gap", F.coalesce(F.col("low") + F.col("c.slice") * narrow, F.lit(2.0)).alias("low"),
            narrow.alias("width"), F.coalesce(F.col("c.upto") - F.col("c.words"), F.lit(0)).alias("before"),
            F.coalesce("c.rows", F.lit(0)).alias("rows")))
        share /= SLICES
        most = state.agg(F.max("rows")).first()[0] or 0
        state = state.drop("rows")
        if most <= SORTED or share < 2.0 ** -45:  # below that only rows of equal order are left
            return state


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights=WEIGHTS, most: int = MAX_COPIES, seed: int = 7, preference=None) -> DataFrame:
    """One row per row of ``docs``: id, row_key, row_check, size, source, source_size, target, rate, copies.

    size is the number of words; copies is 0 to ``most`` and ``rate`` its
    expected value: the source's target over its size, and up to the lesser
    of this and what is left to ``most`` more or less by the document's
    ``preference`` (a Column of ``docs``, 0 to 1, NULL as 0; by default size /
    (size + ``MIDDLE``)) against the mean of its source.  NULL and empty texts
    have size 0 and get the certain copies only.  A NULL source is a source.
    Rows that are equal throughout are taken one after the other.
    """
    own = [F.col(id_col), F.col(text_col), F.col(source_col)]
    rows = docs.select(
        own[0].alias("id"), own[2].alias("source"),
        F.coalesce(F.regexp_count(own[1], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(*own).alias("row_key"), F.xxhash64(F.lit(1), *own).alias("row_check"),
        (F.lit(None).cast("double") if preference is None else preference).alias("wish"))
    rows = cut(rows.withColumn("steps", _preference(None if preference is None else F.col("wish"))).drop("wish")
               .withColumn("row", F.monotonically_increasing_id()))
    per_source = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                F.sum(F.col("size").cast("decimal(38,0)") * F.col("steps")).alias("wished")))
    targets = source_targets(per_source.select("source", "source_size"), weights, most)
    few = targets.count() <= FEW_SOURCES

    def of_source(table: DataFrame) -> DataFrame:  # so that a hot source's rows aren't dealt by source
        return F.broadcast(table) if few else table

    t = (targets.join(per_source.select(F.col("source").alias("s"), "wished"), F.col("source").eqNullSafe(F.col("s")))
         .select("s", "source_size", "number", "target",
                 F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("mean"),
                 F.when(F.col("source_size") > 0, F.col("wished").cast("double") / F.col("source_size") / STEPS)
                 .otherwise(0.0).alias("mean_wish")))
    room = F.least(F.col("mean"), F.lit(float(most)) - F.col("mean"))
    rate = F.col("mean") + F.greatest(room, F.lit(0.0)) * (F.col("steps") / F.lit(float(STEPS)) - F.col("mean_wish"))
    u = (F.shiftrightunsigned(F.xxhash64("row_key", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    odds = u / (1 - u) / (F.col("p") / (1 - F.col("p")))
    ranked = cut(rows.join(of_source(t), F.col("source").eqNullSafe(F.col("s"))).drop("s")
                 .withColumn("rate", F.least(F.greatest(rate, F.lit(0.0)), F.lit(float(most))))
                 .withColumn("sure", F.floor(F.col("rate") + 1e-12).cast("long"))
                 .withColumn("p", F.greatest(F.col("rate") - F.col("sure"), F.lit(0.0)))
                 .withColumn("order", F.when(F.col("p") > 0, odds / (1 + odds))).drop("steps", "mean", "mean_wish"))
    gaps = ranked.groupBy("number").agg(F.first("target").alias("target"), (
        F.first("target") - F.sum(F.col("sure") * F.col("size"))).alias("gap"))
    gaps = cut(gaps)
    open_rows, taken = ranked.where("order is not null and size > 0").select("row", "number", "size", "order"), None
    first = Window.partitionBy("number").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while True:
        # gaps only shrink: a row of twice the gap neither fits later nor brings its source nearer
        near = cut(open_rows.join(of_source(gaps.select("number", "gap")), "number").where("size < 2 * gap")
                   .select("row", "number", "size", "order",
                           F.when(F.col("size") <= F.col("gap"), F.col("size")).alias("fit")))
        placed = near.join(of_source(_ends(near, gaps, of_source)), "number")
        within = (F.col("order") >= F.col("low")) & (F.col("order") < F.col("low") + F.col("width"))
        kept = ["row", "number", "size", "order", "got"]
        below = placed.where(~within).withColumn("got", F.col("fit").isNotNull() & (F.col("order") < F.col("low")))
        ending = (placed.where(within).withColumn("upto", F.col("before") + F.sum("fit").over(first))
                  .withColumn("got", F.col("fit").isNotNull() & (F.col("upto") <= F.col("gap"))))
        step = cut(below.select(*kept).unionByName(ending.select(*kept)))
        got = step.where("got").select("row", "number", "size")
        open_rows = step.where("not got").drop("got")
        taken = got if taken is None else taken.unionByName(got)
        gaps = cut(gaps.join(got.groupBy("number").agg(F.sum("size").alias("s")), "number", "left").select(
            "number", "target", (F.col("gap") - F.coalesce("s", F.lit(0))).alias("gap")))
        least = open_rows.groupBy("number").agg(F.min("size").alias("least"))
        if gaps.join(least, "number").where((F.col("gap") > NEAR * F.col("target")) & (F.col("least") <= F.col("gap"))).isEmpty():
            break
    # the document that brings a source nearest, if any does
    off = F.abs(F.col("size") - F.col("gap"))
    nearest = (open_rows.join(of_source(gaps), "number").where("size < 2 * gap").groupBy("number")
               .agg(F.min(F.struct(off, "order", "row")).alias("best")).select(F.col("best.row").alias("row")))
    taken = taken.select("row").unionByName(nearest)
    extra = taken.select("row", F.lit(1).alias("extra"))
    return ranked.join(extra, "row", "left").select(
        "id", "row_key", "row_check", "size", "source", "source_size", "target", "rate",
        (F.col("sure") + F.coalesce("extra", F.lit(0))).alias("copies"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights=WEIGHTS, most: int = MAX_COPIES, seed: int = 7, preference=None) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its columns.

    Rows with equal id, text and source are one document with the sum of their
    copies; of their other columns those of the least row stand, by a hash of
    all columns but maps.  An empty table gives an empty table.
    """
    own = own_columns(docs, "__key", "__check", "__n", "__copies")
    n = (copies(docs, id_col, text_col, source_col, weights, most, seed, preference)
         .groupBy(F.col("row_key").alias("__key"), F.col("row_check").alias("__check"))
         .agg(F.sum("copies").alias("__copies")).where("__copies > 0"))
    hashed = [F.col(id_col), F.col(text_col), F.col(source_col)]
    keyed = docs.select(*own, F.xxhash64(*hashed).alias("__key"), F.xxhash64(F.lit(1), *hashed).alias("__check"))
    others = [f.name for f in docs.schema.fields
              if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    least = Window.partitionBy("__key", "__check").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in others]))
    one = keyed.join(n, ["__key", "__check"]).withColumn("__n", F.row_number().over(least))
    return (one.where("__n = 1").withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
            .select(*own))
