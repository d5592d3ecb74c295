"""Approximate nearest neighbours by largest inner product: low-dimensional
stable projections, indexed by a kd-tree, verified until a chi-square test holds.

Inner products become distances by one more component (all vectors get the
largest norm, queries are scaled to it).  A Gaussian (2-stable) projection to
``dims`` dimensions keeps ``projected distance^2 / distance^2`` chi-square
distributed.  Candidates are dealt into blocks, each indexed by a kd-tree over
its projections.  Queries, in blocks, meet every candidate block; a query
visits leaves by increasing projected distance, verifies their vectors exactly
and stops once a vector better than its k-th best would lie that far out with
probability under ``1 - sure``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.graph import cut
from tillroll.llm.suffix_dedup import _arrays, _blob

DIMS = 8
SURE = 0.97
BLOCK = 16_384
QUERY_BLOCK = 2_048
LEAF = 64
ROUND = 4  # leaves that a query visits between two tests
SEED = 11


def chi_square(x: np.ndarray, dims: int) -> np.ndarray:
    """Distribution function for an even number of dimensions."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for k in range(1, dims // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


def projection(width: int, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width + 1, dims))


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): points in leaf order, leaf i being order[bounds[i]:bounds[i + 1]]; median splits of the widest side."""
    order, bounds, todo = np.arange(len(points)), [0], [(0, len(points))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= leaf:
            bounds.append(hi)
            continue
        p = points[order[lo:hi]]
        side, mid = int(np.argmax(p.max(axis=0) - p.min(axis=0))), (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(p[:, side], mid)]
        todo += [(lo + mid, hi), (lo, lo + mid)]
    return order, np.array(bounds)


def _best(scores: np.ndarray, rows: np.ndarray, first_id: np.ndarray, k: int):
    """The k best of each line: larger score first, ties to the smaller first id."""
    if scores.shape[1] <= k:
        return scores, rows
    part = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    last = np.take_along_axis(scores, part, 1).min(axis=1)
    tied = np.flatnonzero(((scores >= last[:, None]).sum(axis=1) > k) & (last > -np.inf))
    if len(tied):
        part[tied] = np.lexsort((first_id[rows[tied]], -scores[tied]), axis=-1)[:, :k]
    return np.take_along_axis(scores, part, 1), np.take_along_axis(rows, part, 1)


def search_block(q: np.ndarray, block: dict, largest: float, k: int, dims: int, sure: float):
    """(scores, rows) of the k best candidates of one block for each query; -inf where there are fewer."""
    x, bounds, low, high = block["x"], block["bounds"], block["low"], block["high"]
    norm = np.linalg.norm(q, axis=1)
    unit = np.concatenate([q * (largest / norm)[:, None], np.zeros((len(q), 1))], axis=1) @ projection(q.shape[1], dims)
    gap = np.maximum(np.maximum(low[None] - unit[:, None], unit[:, None] - high[None]), 0)
    far = (gap ** 2).sum(axis=2)
    order = np.argsort(far, axis=1)
    far = np.take_along_axis(far, order, 1)
    best = np.full((len(q), k), -np.inf)
    rows = np.zeros((len(q), k), np.int64)
    active = np.arange(len(q))
    size = int(np.diff(bounds).max())
    for at in range(0, len(low), ROUND):
        leaves = order[active, at:at + ROUND]
        found = np.full((len(active), leaves.shape[1], size), -np.inf)
        where = np.zeros(found.shape, np.int64)
        flat = np.argsort(leaves.ravel(), kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(leaves.ravel()[flat]) != 0))
        for a, b in zip(cuts, [*cuts[1:], len(flat)]):
            who, slot = flat[a:b] // leaves.shape[1], flat[a:b] % leaves.shape[1]
            leaf = leaves.ravel()[flat[a]]
            s, e = bounds[leaf], bounds[leaf + 1]
            found[who, slot, :e - s] = q[active[who]] @ x[s:e].T
            where[who, slot, :e - s] = np.arange(s, e)
        best[active], rows[active] = _best(np.concatenate([best[active], found.reshape(len(active), -1)], axis=1),
                                           np.concatenate([rows[active], where.reshape(len(active), -1)], axis=1),
                                           block["first"], k)
        if at + ROUND >= len(low):
            break
        worst = best[active].min(axis=1)
        distance = 2 * largest * (largest - worst / norm[active])
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(distance > 0, far[active, at + ROUND] / np.maximum(distance, 1e-300), np.inf)
        active = active[~((worst > -np.inf) & (chi_square(np.minimum(ratio, 1e4), dims) >= sure))]
        if not len(active):
            break
    return best, rows


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
            dims: int = DIMS, sure: float = SURE, block: int = BLOCK) -> DataFrame:
    """The k nearest of every query row among all other rows: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision, ties go to the smaller
    id.  Vectors that are NULL, zero or hold NULL or non-finite components take
    no part, nor do those of another length than most; rows with a NULL id
    neither.  Equal vectors are one candidate with its k + 1 smallest ids (more
    can't be returned), so a hot vector costs one entry and no tie is lost; a
    row repeated with the same id and vector counts once.  With fewer
    candidates all are returned; an empty table gives an empty table.  Other
    columns are not used.
    """
    if dims % 2:
        raise ValueError("dims must be even")
    spark = vectors.sparkSession
    v = F.col("v")
    part = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                          is_query.alias("query"))
    part = part.where(F.col("id").isNotNull() & v.isNotNull()
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    sizes = part.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m")).orderBy(
        F.desc("n"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    width, n, largest = int(sizes[0]["d"]), int(sizes[0]["n"]), float(sizes[0]["m"]) * (1 + 1e-12)
    part = part.where(F.size("v") == width)
    few = part.select("id", "v").distinct().withColumn("r", F.row_number().over(
        Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    entries = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k + 1 ids at most

    def deal(df, blocks):
        return df.withColumn("block", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int"))

    def index(table: pa.Table) -> pa.Table:
        x = np.array(table.column("v").combine_chunks().flatten(), dtype=float).reshape(table.num_rows, width)
        ids = table.column("ids").to_pylist()
        rest = np.sqrt(np.maximum(largest ** 2 - (x ** 2).sum(axis=1), 0))
        order, bounds = kd_leaves(np.concatenate([x, rest[:, None]], axis=1) @ projection(width, dims))
        x, rest, ids = x[order], rest[order], [ids[i] for i in order]
        p = np.concatenate([x, rest[:, None]], axis=1) @ projection(width, dims)
        blob = _blob(x=x.ravel(), bounds=bounds, low=np.minimum.reduceat(p, bounds[:-1]).ravel(),
                     high=np.maximum.reduceat(p, bounds[:-1]).ravel(), first=np.array([i[0] for i in ids], np.int64),
                     ids=np.array([i for x in ids for i in x], np.int64), many=np.array([len(i) for i in ids], np.int64))
        return pa.table({"block": table.column("block").slice(0, 1), "blob": pa.array([blob], pa.binary())})

    def asked(table: pa.Table) -> pa.Table:
        x = np.array(table.column("v").combine_chunks().flatten(), dtype=float)
        return pa.table({"block": table.column("block").slice(0, 1),
                         "blob": pa.array([_blob(x=x, id=table.column("id").to_numpy())], pa.binary())})

    blocks = max(1, -(-n // block))
    indexed = cut(deal(entries, blocks).groupBy("block").applyInArrow(index, "block int, blob binary"))
    queries = part.where("query").select("id", "v").distinct()
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked_blocks = cut(queries.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(query_blocks)).cast("int"))
                       .groupBy("block").applyInArrow(asked, "block int, blob binary"))
    pairs = spark.range(blocks * query_blocks).select(
        "id", (F.col("id") % blocks).cast("int").alias("a"), F.floor(F.col("id") / blocks).cast("int").alias("b"))
    pairs = (pairs.join(indexed.select(F.col("block").alias("a"), F.col("blob").alias("x")), "a")
             .join(asked_blocks.select(F.col("block").alias("b"), F.col("blob").alias("q")), "b"))

    def meet(batches):
        for batch in batches:
            for x, y, b in zip(*(batch.column(j).to_pylist() for j in range(3))):
                have, ask = dict(_arrays(x)), _arrays(y)
                have["x"] = have["x"].reshape(-1, width)
                have["low"], have["high"] = have["low"].reshape(-1, dims), have["high"].reshape(-1, dims)
                q = ask["x"].reshape(-1, width)
                best, rows = search_block(q, have, largest, k + 1, dims, sure)  # one may be the query's own
                ends = np.cumsum(have["many"])
                out = []
                for i, own in enumerate(ask["id"].tolist()):
                    hit = rows[i][best[i] > -np.inf]
                    exact = (have["x"][hit] * q[i]).sum(axis=1)
                    some = sorted((-s, int(c)) for s, r in zip(exact.tolist(), hit.tolist())
                                  for c in have["ids"][ends[r] - have["many"][r]:ends[r]] if c != own)[:k]
                    out += [(own, (b << 32) + i, c, -s) for s, c in some]
                qid, qno, vec, score = zip(*out) if out else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid, pa.int64()), pa.array(qno, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())],
                    ["query_id", "qno", "vec_id", "score"])

    found = (pairs.repartition(max(1, min(blocks * query_blocks, 4096)), "id").select("x", "q", "b")
             .mapInArrow(meet, "query_id long, qno long, vec_id long, score double"))
    # the same id with another vector is another query: its block and number there tell them apart
    w = Window.partitionBy("query_id", "qno").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
