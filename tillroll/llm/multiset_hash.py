"""Document fingerprints: a homomorphic multiset hash of paragraphs, with DataFrame functions only.

A text is the multiset of its paragraphs (lines, and sentences and clauses within them).
Each paragraph is hashed to a wide vector; a document's vector is the sum over
its paragraphs, lane by lane, modulo a power of two.  So the order does not
matter, and paragraphs (or whole documents) are inserted and deleted by adding
and subtracting vectors (``insert``, ``delete``).

Lanes: the number of paragraphs (modulo 2^32), EXACT lanes of uniform 32-bit
values (modulo 2^32) that decide equality, and SKETCH lanes of single hash
bits (modulo 2^32).  With signs -1 and 1 for the bits, the inner product of
two sketches estimates how much two multisets share, hence ``likeness``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.chunks import NULL_ID, chunking

EXACT = 8
SKETCH = 128
MODULUS = 1 << 32
# a line break, or blanks behind a mark that ends a sentence or clause
BREAK = r"[\r\n]+|(?<=[.!?;,:|]) +"
LOW = MODULUS - 1


def paragraphs(text: Column) -> Column:
    """The non-empty paragraphs of a text; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BREAK, -1), lambda p: p != "")


def _total(hashes: Column, lane) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + lane(h))


def vector(text: Column) -> Column:
    """array<long>: count, EXACT lanes, SKETCH lanes."""
    # one array of two independent hashes per paragraph feeds all lanes
    return F.transform(F.array(F.transform(paragraphs(text), lambda p: F.struct(
        F.xxhash64(p).alias("x"), F.xxhash64(F.lit(1), p).alias("y")))), _lanes)[0]


def _lanes(pairs: Column) -> Column:
    def both(hashes):
        exact = []
        for j in range(EXACT // 2):
            h = F.transform(hashes, lambda p: F.xxhash64(p["x"], p["y"], F.lit(j)))
            exact.append(F.transform(F.array(h), lambda a: F.array(
                _total(a, lambda x: x.bitwiseAND(F.lit(LOW))),
                _total(a, lambda x: F.shiftrightunsigned(x, 32))))[0])
        bits = []
        for j in range(SKETCH // 64):
            h = F.transform(hashes, lambda p: F.xxhash64(p["y"], p["x"], F.lit(100 + j)))
            # two lanes per sum: a text has fewer than 2^31 paragraphs
            sums = F.transform(F.array(h), lambda a: F.array(*[
                _total(a, lambda x, s=s: F.shiftrightunsigned(x, s).bitwiseAND(F.lit((1 << 32) + 1)))
                for s in range(32)]))[0]
            bits += [F.transform(sums, lambda x: x.bitwiseAND(F.lit(LOW))),
                     F.transform(sums, lambda x: F.shiftrightunsigned(x, 32))]
        n = F.array(F.size(hashes).cast("long"))
        return F.transform(F.concat(n, *exact, *bits), lambda x: F.pmod(x, F.lit(MODULUS)))

    return both(pairs)


def insert(a: Column, b: Column) -> Column:
    """Vector of the union of two multisets."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(MODULUS)))


def delete(a: Column, b: Column) -> Column:
    """Vector of multiset a without multiset b."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(MODULUS)))


def digest(v: Column) -> Column:
    """The vector as text: count and exact lanes in 8 hex digits each, sketch lanes in 4 (modulo 2^16)."""
    wide = F.transform(F.slice(v, 1, EXACT + 1), lambda x: F.lpad(F.hex(x), 8, "0"))
    thin = F.transform(F.slice(v, EXACT + 2, SKETCH),
                       lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFF))), 4, "0"))
    return F.lower(F.concat(F.array_join(wide, ""), F.array_join(thin, "")))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: estimate of 2 |A and B| / (|A|^2 + |B|^2) in multiset norms; 1 for equal vectors."""
    def signs(v):
        return F.transform(F.slice(v, EXACT + 2, SKETCH), lambda x: (2 * x - v[0]).cast("double"))

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    both = dot(signs(a), signs(a)) + dot(signs(b), signs(b))
    return (F.when(a == b, F.lit(1.0)).when(both == 0, F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * dot(signs(a), signs(b)) / both))))


def _literal(values) -> Column:
    """A constant array<long> of any length, folded once by the optimizer."""
    if not values:
        return F.array().cast("array<long>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _position(bounds, x: Column, tie: Column) -> Column:
    """How many of the sorted bounds are <= (x, tie), by binary search."""
    if not bounds:
        return F.lit(0)
    ids, ties = (_literal(b) for b in zip(*bounds))
    powers = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.array(*[F.lit(p) for p in powers]), F.lit(0),
                       lambda lo, step: F.when((F.get(ids, lo + step - 1) < x) | (
                           (F.get(ids, lo + step - 1) == x) & (F.get(ties, lo + step - 1) <= tie)), lo + step).otherwise(lo))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bucket, row, id, text, next_text, guest): every document beside the next one by id (after the last: the first).

    Documents are dealt by id ranges; a range also gets, as a guest, the first
    document of the following range, so no task sees more than its range and
    texts move once.  A NULL id sorts first, rows with equal ids by text hash.
    """
    plan = chunking(docs, id_col, text_col)
    t = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    t = t.withColumn("tie", F.xxhash64("text")).withColumn(
        "home", _position(plan.bounds, F.coalesce(F.col("id").cast("long"), F.lit(NULL_ID)), F.col("tie")))
    first = {r["home"]: r["f"] for r in t.groupBy("home").agg(  # one row per range
        F.min(F.struct(F.col("id").isNotNull().alias("some"), F.col("id").cast("long").alias("id"), "tie")).alias("f")).collect()}
    homes = sorted(first)
    before = {h: homes[i - 1] for i, h in enumerate(homes)}
    size = plan.chunks
    is_first = F.lit(False)
    if homes:
        tie = F.get(_literal([first[h]["tie"] if h in first else 0 for h in range(size)]), F.col("home"))
        known = F.get(_literal([int(h in first and first[h]["some"]) for h in range(size)]), F.col("home")) == 1
        ident = F.get(_literal([(first[h]["id"] or 0) if h in first else 0 for h in range(size)]), F.col("home"))
        is_first = (F.col("tie") == tie) & F.when(known, F.coalesce(F.col("id").cast("long") == ident, F.lit(False))).otherwise(
            F.col("id").isNull())
    back = F.get(_literal([before.get(h, 0) for h in range(size)]), F.col("home")).cast("int")
    stay = F.struct(F.col("home").cast("int").alias("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(back.alias("bucket"), F.lit(True).alias("guest"))
    spread = t.select("id", "text", "tie", F.inline(F.when(is_first, F.array(stay, visit)).otherwise(F.array(stay))))
    w = Window.partitionBy("bucket").orderBy("guest", F.asc_nulls_first("id"), "tie")
    return spread.select("bucket", F.row_number().over(w).alias("row"), "id", "text", F.lead("text").over(w).alias("next_text"),
                         "guest")


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and: vector (array<long>), fingerprint (text)."""
    own = [c for c in docs.columns if c.lower() not in ("vector", "fingerprint")]
    return docs.select(*own, vector(F.col(text_col)).alias("vector")).withColumn("fingerprint", digest(F.col("vector")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness.

    The edited text has the last floor(n_chars / 4) code points replaced by as
    many first ones (or all) of the next document.  Returns the id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    NULL and empty texts are empty multisets (count 0, equal fingerprints);
    repeated rows and equal texts have equal fingerprints; an empty table
    gives an empty table; other columns are not used.
    """
    n = F.char_length("text").cast("long")
    part = F.floor(F.col("n_chars") / 4).cast("int")
    t = with_next(docs, id_col, text_col).withColumns(
        {"text": F.coalesce("text", F.lit("")), "next_text": F.coalesce("next_text", F.lit(""))})
    t = t.withColumn("n_chars", n).withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - part).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), part)))
    t = t.select("bucket", "row", "id", "n_chars", "guest", F.sha2("edited", 256).alias("edited_sha256"),
                 vector(F.col("text")).alias("a"), vector(F.col("edited")).alias("e"))
    t = t.withColumn("b", F.lead("a").over(Window.partitionBy("bucket").orderBy("row")))
    return t.where("not guest").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", digest(F.col("a")).alias("fingerprint"),
        digest(F.col("e")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("e")).alias("near_edited"),
        likeness(F.col("a"), F.col("b")).alias("near_next"))
