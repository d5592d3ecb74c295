"""SimHash near-dedup: fingerprints of word shingles, linked by a binary trie self-join.

The trie of all distinct fingerprints is cut into blocks of at most
``BLOCK`` values (by a histogram of the top 16 bits and, where these are too
full, of the next ones, whatever their distribution).  Pairs of blocks whose prefixes already differ in more than the
allowed bits are never formed; every other pair is one task row.  A task
traverses nodes of the two subtrees together, adds a bit whenever the sides
part, drops a pair of nodes once the budget is exceeded, and compares values
directly when both nodes are small.  It returns a spanning forest of the
links it found (a label per value), so a dense group of n values costs n
edges, not n^2.  Alternating stars then join the forests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm import hashing
from tillroll.llm.chunks import lean_batches, own_columns, pack_sorted, steps, text_buffers, unpack_sorted
from tillroll.llm.graph import components, cut

WORDS = 4
MAX_BITS = 4
BLOCK = 32_768
TOP = 16
MORE = 8
LEAF = 12
SEED = 42


def text_fingerprints(column, words: int = WORDS) -> np.ndarray:
    """SimHash of each text: a bit is 1 if it is set in over half the shingles' XXH64."""
    data, offsets = text_buffers(column)
    out = np.zeros(len(offsets) - 1, np.uint64)
    digest = xxhash.xxh64_digest
    for a, b in steps(offsets):
        low = hashing.LOWER[data[offsets[a]:offsets[b]]].tobytes()
        hashes, count = [], np.zeros(b - a, np.int64)
        for i in range(b - a):
            parts = low[offsets[a + i] - offsets[a]:offsets[a + i + 1] - offsets[a]].split()
            if not parts:
                continue
            norm = b" ".join(parts)
            end = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
            count[i] = n = max(1, len(parts) - words + 1)
            start = [0, *end[:n - 1].tolist()]
            last = (end[words - 1:] - 1).tolist() if len(parts) >= words else [len(norm)]
            hashes += [digest(norm[s:e], SEED) for s, e in zip(start, last)]
        h = np.frombuffer(b"".join(hashes), ">u8").astype(np.uint64)
        some = np.flatnonzero(count)
        if len(some):
            out[a + some] = _majority(h, count[some])
    return out


def _majority(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Bitwise majority of consecutive runs of ``count`` (> 0) hashes: eight byte lanes are added at a time."""
    first = np.cumsum(count) - count
    pieces = -(-count // 255)  # a byte lane holds at most 255 ones
    run = np.repeat(np.arange(len(count)), pieces)
    at = first[run] + 255 * (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    head = np.flatnonzero(np.diff(run, prepend=-1))
    out = np.zeros(len(count), np.uint64)
    for s in range(8):
        lanes = np.add.reduceat((h >> np.uint64(s)) & np.uint64(0x0101010101010101), at)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), head, axis=0)
        for lane in range(8):
            out |= (ones[:, lane] * 2 > count).astype(np.uint64) << np.uint64(8 * lane + s)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, fp long) of every row: lower-cased A-Z, words, shingles of ``words`` words, XXH64 (seed 42).

    A text with fewer words is one shingle; without a word (or NULL) it has fingerprint 0.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fp = text_fingerprints(batch.column(1), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        lean_batches(run), f"id {kind}, fp long")


# -- trie join of two sorted arrays ---------------------------------------------------------------

def _merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the label trees of u and v in place; a label is the smallest index of its tree."""
    while len(u):
        lu, lv = label[u], label[v]
        keep = lu != lv
        if not keep.any():
            return
        u, v, lu, lv = u[keep], v[keep], lu[keep], lv[keep]
        np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def trie_links(a: np.ndarray, b: np.ndarray | None, max_bits: int) -> np.ndarray:
    """Labels over the values of sorted ``a`` (and ``b`` behind them): equal labels are linked.

    Without ``b`` the trie of ``a`` is joined with itself.
    """
    same = b is None
    values = a if same else np.concatenate([a, b])
    label = np.arange(len(values))
    if not len(a) or (not same and not len(b)):
        return label
    shift = 0 if same else len(a)
    b = a if same else b
    lane = np.arange(LEAF)

    def middle(x, lo, depth):
        prefix = x[lo] >> np.uint64(63 - depth) | np.uint64(1)
        return np.searchsorted(x, prefix << np.uint64(63 - depth))

    def compare(p):
        # lanes past a node's end read neighbours: a hit there is a link all the same
        for k in range(0, len(p), 512):
            ia = np.minimum(p[k:k + 512, 0, None] + lane, len(a) - 1)
            ib = np.minimum(p[k:k + 512, 2, None] + lane, len(b) - 1)
            near = np.bitwise_count(a[ia][:, :, None] ^ b[ib][:, None, :]) <= max_bits
            hit = np.flatnonzero(near.ravel())
            if len(hit):
                r, i, j = hit // (LEAF * LEAF), hit // LEAF % LEAF, hit % LEAF
                _merge(label, ia[r, i], ib[r, j] + shift)

    # depth-first over slices of the frontier: memory stays bounded
    todo = [(0, np.array([[0, len(a), 0, len(b), 0]], np.int64))]
    while todo:
        depth, p = todo.pop()
        if len(p) > 50_000:
            todo += [(depth, p[k:k + 50_000]) for k in range(0, len(p), 50_000)]
            continue
        small = (p[:, 1] - p[:, 0] <= LEAF) & (p[:, 3] - p[:, 2] <= LEAF)
        compare(p[small])
        p = p[~small]
        if not len(p):
            continue
        alo, ahi, blo, bhi, diff = p.T
        am = np.clip(middle(a, alo, depth), alo, ahi)
        bm = np.clip(middle(b, blo, depth), blo, bhi)
        twin = (alo == blo) & (ahi == bhi) if same else np.zeros(len(p), bool)
        sides = [np.stack(x, 1) for x in ((alo, am, blo, bm, diff), (am, ahi, bm, bhi, diff),
                                          (alo, am, bm, bhi, diff + 1), (am, ahi, blo, bm, diff + 1))]
        sides[3] = sides[3][~twin]  # (right, left) of a node with itself is (left, right) again
        p = np.concatenate(sides)
        p = p[(p[:, 1] > p[:, 0]) & (p[:, 3] > p[:, 2]) & (p[:, 4] <= max_bits)]
        if len(p):
            todo.append((depth + 1, p))
    return label


# -- blocks of the trie ---------------------------------------------------------------------------

def _blocks(counts: np.ndarray, most: int, depth: int = 0, prefix: int = 0) -> list[tuple[int, int, int]]:
    """Cut the trie under a prefix, from the counts of its next bits: (depth, prefix, values), at most ``most`` if they suffice."""
    top = len(counts).bit_length() - 1
    total = np.concatenate([[0], np.cumsum(counts)])
    blocks, todo = [], [(0, 0)]
    while todo:
        d, p = todo.pop()
        lo, hi = p << (top - d), (p + 1) << (top - d)
        n = int(total[hi] - total[lo])
        if not n:
            continue
        if n <= most or d == top:
            blocks.append((depth + d, prefix << d | p, n))
        else:
            todo += [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
    return blocks


def _trie_blocks(fps: DataFrame, block: int) -> list[tuple[int, int, int]]:
    """Blocks of the distinct values of ``fps``, in order; prefixes too full at one depth are counted ``MORE`` bits further."""
    hist = fps.groupBy(F.shiftrightunsigned("fp", 64 - TOP).cast("int").alias("p")).count().collect()  # 65,536 rows at most
    counts = np.zeros(1 << TOP, np.int64)
    for r in hist:
        counts[r["p"]] = r["count"]
    most = max(block, int(counts.sum()) // 4096)
    done, blocks, depth = [], _blocks(counts, most), TOP
    while blocks:
        done += [x for x in blocks if x[2] <= most]
        full = {p: np.zeros(1 << MORE, np.int64) for _, p, n in blocks if n > most}  # fewer than 4096, all at this depth
        blocks = []
        if full:
            for r in (fps.where(F.shiftrightunsigned("fp", 64 - depth).isin(list(full)))
                      .groupBy(F.shiftrightunsigned("fp", 64 - depth - MORE).alias("p")).count().collect()):
                p = r["p"] % (1 << 64)
                full[p >> MORE][p & (1 << MORE) - 1] = r["count"]
            for p, counts in full.items():
                blocks += _blocks(counts, most, depth, p)
            depth += MORE
    return sorted(done, key=lambda x: x[1] << (64 - x[0]))


def _block_pairs(blocks: list[tuple[int, int, int]], max_bits: int) -> list[tuple[int, int]]:
    """Pairs of blocks whose prefixes differ in at most ``max_bits`` of the bits that both have."""
    depth, prefix = (np.array(x, np.uint64) for x in list(zip(*blocks))[:2])
    out = []
    for i in range(len(blocks)):
        d = np.minimum(depth[i], depth[i:])
        x = (prefix[i] >> (depth[i] - d)) ^ (prefix[i:] >> (depth[i:] - d))
        out += [(i, i + int(j)) for j in np.flatnonzero(np.bitwise_count(x) <= max_bits)]
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Spanning forest (u, v) of all links between the distinct values of ``fps`` (column fp)."""
    spark = fps.sparkSession
    blocks = _trie_blocks(fps, block)
    if not blocks:
        return spark.createDataFrame([], "u long, v long")
    starts = np.array([p << (64 - d) for d, p, _ in blocks], np.uint64)
    pairs = [(k, a, b) for k, (a, b) in enumerate(_block_pairs(blocks, max_bits))]

    def deal(batches):
        for batch in batches:
            fp = np.sort(batch.column(0).to_numpy().view(np.uint64))
            if not len(fp):
                continue
            at = (np.searchsorted(starts, fp, side="right") - 1).astype(np.int32)
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[cuts[:-1]]), pa.array([pack_sorted(fp[x:y]) for x, y in zip(cuts, cuts[1:])], pa.binary())],
                ["block", "part"])

    def gather(table: pa.Table) -> pa.Table:
        fp = np.sort(np.concatenate([unpack_sorted(x.as_py()) for x in table.column("part")]))
        return pa.table({"block": table.column("block").slice(0, 1), "fps": pa.array([pack_sorted(fp)], pa.binary())})

    def join(batches):
        for batch in batches:
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                u = unpack_sorted(x)
                v = None if a == b else unpack_sorted(y)
                values = u if v is None else np.concatenate([u, v])
                label = trie_links(u, v, max_bits)
                hung = np.flatnonzero(label != np.arange(len(label)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[hung].view(np.int64)), pa.array(values[label[hung]].view(np.int64))], ["u", "v"])

    parts = cut(fps.select("fp").mapInArrow(deal, "block int, part binary")
                .groupBy("block").applyInArrow(gather, "block int, fps binary"))
    todo = spark.createDataFrame(pairs, "pair int, a int, b int")
    todo = (todo.join(parts.select(F.col("block").alias("a"), F.col("fps").alias("x")), "a")
            .join(parts.select(F.col("block").alias("b"), F.col("fps").alias("y")), "b"))
    n = max(1, min(len(pairs), 4096))
    return todo.repartition(n, "pair").select("a", "b", "x", "y").mapInArrow(join, "u long, v long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: id, fp (long, the 64 bits), component_id.

    Rows are linked if their fingerprints differ in at most ``max_bits`` bits;
    component_id is the smallest id reachable, itself included.  Equal
    fingerprints collapse before any join, so copies cost one row of the trie.
    Texts without words (NULL, empty) have fingerprint 0 and link like others.
    A NULL id stays NULL; the component of a group of only NULL ids is NULL.
    An empty table gives an empty table.
    """
    fps = cut(fingerprints(docs, id_col, text_col, words))
    root, least = _roots(fps, max_bits)
    named = root.join(least, "root").select("fp", F.col("first").alias("component_id"))
    return fps.join(named, "fp").select("id", "fp", "component_id")


def _roots(fps: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of all distinct fingerprints and (root, first): the smallest id of each component."""
    values = cut(fps.groupBy("fp").agg(F.min("id").alias("first")))
    member = components(links(values.select("fp"), max_bits))
    root = values.join(member, values.fp == member.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    # values are distinct, so a component has at most as many rows here as different fingerprints
    return root.select("fp", "root"), root.groupBy("root").agg(F.min("first").alias("first"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                  max_bits: int = MAX_BITS, null_ids: bool = False) -> DataFrame:
    """One row of every component of ``docs``: the one with the smallest id.

    Rows of a component that share the smallest id are copies or versions: the
    one with the smallest text hash stays.  Rows that share an id but lie in
    different components are different documents: each component keeps its
    own.  Rows with a NULL id stay; with ``null_ids`` they are rows like
    others, after all ids: one stays where its component has no id.  Columns
    are those of ``docs``.
    """
    own = own_columns(docs, "__row")
    # written once, so that the row numbers below hold for both reads
    rows = cut(docs.select(*own).withColumn("__row", F.monotonically_increasing_id()))
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                     F.xxhash64(text_col).alias("hash"), F.col("__row").alias("row"))
    fps = fingerprints(rows.select(place.alias("place"), F.col(text_col)), "place", text_col, words)
    keep = _roots(fps, max_bits)[1].select(F.col("first.row").alias("__row"))
    if null_ids:
        return rows.join(keep, "__row", "left_semi").select(*own)
    named, rest = rows.where(F.col(id_col).isNotNull()), rows.where(F.col(id_col).isNull())
    return named.join(keep, "__row", "left_semi").select(*own).unionByName(rest.select(*own))
