"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased (A-Z) bytes; their 4-, 5- and 6-byte strings are hashed
to ``FEATURES`` presence features.  Spark counts, per feature, in how many
training texts of each class it occurs, over all of them; the log ratio of the
smoothed counts scales it, and the ``KEPT`` features with the clearest ratios
stay.  A logistic regression over the scaled features is fitted on a bounded sample
(about ``ROWS`` training rows per class, chosen by a hash at that rate).  Scoring reads
every text whole.

Texts meet their labels compressed, by a join that stays the same at every
size (Spark splits a hot id).  A task sends its counts as a few compressed
blobs, one per range of features, and the ranges are added up as they arrive.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing
from tillroll.llm.chunks import steps, text_buffers
from tillroll.llm.graph import cut

LENGTHS = (4, 5, 6)
FEATURES = 1 << 20
KEPT = 2048
ROWS = 3000
RANGES = 64  # ranges of features that counts are sent in
SMOOTH = 1.0
PENALTY = 1.0
ROUNDS = 300


def _grams(data: np.ndarray, offsets: np.ndarray):
    """(feature, position) arrays of all n-grams that lie within one document, by length."""
    x = hashing.LOWER[data].astype(np.uint64)
    doc_end = np.repeat(offsets[1:], np.diff(offsets))
    gram = x
    for n in range(2, max(LENGTHS) + 1):
        if len(x) < n:
            return
        gram = gram[:-1] | x[n - 1:] << np.uint64(8 * (n - 1))
        if n in LENGTHS:
            at = np.flatnonzero(np.arange(len(gram)) + n <= doc_end[:len(gram)])
            h = (gram[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            yield (h >> np.uint64(44)).astype(np.int64), at


def _present(data, offsets, table: np.ndarray | None):
    """Distinct (document, feature) pairs; with a table, features are its entries >= 0."""
    keys = []
    for feature, at in _grams(data, offsets):
        if table is not None:
            feature = table[feature]
            some = np.flatnonzero(feature >= 0)
            feature, at = feature[some].astype(np.int64), at[some]
        keys.append((np.searchsorted(offsets, at, side="right") - 1) * FEATURES + feature)
    key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return key // FEATURES, key % FEATURES


def _compressed(texts: DataFrame) -> DataFrame:
    """(doc, z): every text compressed by itself; z of a NULL text is that of an empty one."""
    kind = texts.schema["doc"].dataType.simpleString()

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        for batch in batches:
            z = pa.array([pack((t or "").encode()) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), z], ["doc", "z"])

    return texts.mapInArrow(run, f"doc {kind}, z binary")


def _class_counts(batches):
    """A task's (range, counts): in how many texts of either class each feature of the range occurs; range -1: texts."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    n, size = np.zeros((2, FEATURES), np.int64), np.zeros(2, np.int64)
    for batch in batches:
        y = batch.column(0).to_numpy()
        size += np.bincount(y, minlength=2)
        raw = [unpack(z) for z in batch.column(1).to_pylist()]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.cumsum([0, *map(len, raw)])
        for a, b in steps(offsets):
            doc, feature = _present(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], None)
            for c in (0, 1):
                n[c] += np.bincount(feature[y[a + doc] == c], minlength=FEATURES)
    if size.any():  # once a task: bounded by the features
        parts = [size, *np.moveaxis(n.reshape(2, RANGES, -1), 1, 0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, RANGES), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in parts], pa.binary())],
            ["range", "counts"])


def _added(parts: DataFrame) -> DataFrame:
    """(feature, n0, n1) of all features that occur, and -1 with the number of texts, from the tasks' blobs."""
    def run(batches):
        total: dict = {}
        for batch in batches:
            for r, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.frombuffer(zlib.decompress(z), np.int64).reshape(2, -1)
                total[r] = total[r] + got if r in total else got
        for r, n in total.items():
            some = np.flatnonzero(n.any(axis=0))
            feature = some + r * (FEATURES // RANGES) if r >= 0 else np.full(len(some), -1)
            yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(n[0, some]), pa.array(n[1, some])],
                                             ["feature", "n0", "n1"])

    return parts.repartition(RANGES, "range").mapInArrow(run, "feature long, n0 long, n1 long")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", rows: int = ROWS, kept: int = KEPT) -> dict:
    """Count over all label rows that ``learn`` admits, keep ``kept`` features, fit on about ``rows`` documents of each class."""
    rated = labels.where(learn & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)").distinct()
    of_class = {r["y"]: r["count"] for r in rated.groupBy("y").count().collect()}
    nothing = {"table": np.full(FEATURES, -1, np.int16), "weight": np.zeros(kept), "bias": -4.0}
    if len(of_class) < 2:
        return nothing  # one class only: nothing to tell apart
    u = F.shiftrightunsigned(F.xxhash64("id", F.lit(5)), 11) / float(1 << 53)
    # distinct ids, at a rate that leaves about ``rows`` of each class
    pick = rated.where(u < F.when(F.col("y") == 1, rows / of_class[1]).otherwise(rows / of_class[0]))
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(pick), F.col("doc") == F.col("id")).select("y", "text")
    every = _compressed(texts).hint("merge").join(rated, F.col("doc") == F.col("id")).select("y", "z")
    counts = cut(_added(every.mapInArrow(_class_counts, "range int, counts binary")))
    size = counts.where("feature = -1").first()
    if size is None or not size["n0"] or not size["n1"]:
        return nothing
    p, q = F.col("n1") + SMOOTH, F.col("n0") + SMOOTH
    ratio = F.log(p / (size["n1"] + 2 * SMOOTH)) - F.log(q / (size["n0"] + 2 * SMOOTH))
    best = counts.where("feature >= 0").select("feature", ratio.alias("ratio"), (F.abs(ratio) / F.sqrt(1 / p + 1 / q)).alias(
        "clear")).orderBy(F.desc("clear"), "feature").limit(kept).collect()
    table = nothing["table"]
    table[[r["feature"] for r in best]] = np.arange(len(best))
    ratio = np.zeros(kept)
    ratio[:len(best)] = [r["ratio"] for r in best]

    def rows_of(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            got = [[] for _ in range(len(offsets) - 1)]
            for a, b in steps(offsets):
                doc, feature = _present(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], table)
                cuts = np.searchsorted(doc, np.arange(b - a + 1))
                for i in range(b - a):
                    got[a + i] = feature[cuts[i]:cuts[i + 1]].astype(np.int16).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], ["y", "x"])

    # about 2 * rows rows of at most 2 * kept bytes
    data = sorted((r["y"], bytes(r["x"])) for r in sample.mapInArrow(rows_of, "y int, x binary").collect())
    x = np.zeros((len(data), kept), np.float32)
    for i, (_, features) in enumerate(data):
        at = np.frombuffer(features, np.int16)
        x[i, at] = ratio[at]
    w, bias = logistic(x, np.array([r[0] for r in data], np.float32))
    return {"table": table, "weight": w * ratio, "bias": bias}


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression by accelerated gradient steps, classes weighted evenly."""
    n, d = x.shape
    weight = np.where(y == 1, n / (2 * max(1, y.sum())), n / (2 * max(1, (1 - y).sum()))).astype(np.float32)
    v = np.ones(d + 1, np.float32)
    for _ in range(20):  # largest curvature
        u = (x @ v[:d] + v[d]) * weight
        v = np.append(x.T @ u, u.sum())
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-9)
    step = 1 / (top / 4 + penalty)
    w = z = np.zeros(d + 1, np.float32)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-(x @ z[:d] + z[d])))
        g = (p - y) * weight
        new = z - step * (np.append(x.T @ g, g.sum()) + penalty * np.append(z[:d], 0))
        z = new + t / (t + 3) * (new - w)
        w = new
    return w[:d].astype(float), float(w[d])


def toxicity(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with score (0 to 1).

    A NULL or empty text has no feature and gets the score of the bias alone.
    """
    names = [c for c in docs.columns if c != text_col and c.lower() != "score"]
    fields = [docs.schema[c] for c in names]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["score double"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        m = shared.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(len(names)))
            z = np.full(len(offsets) - 1, m["bias"])
            for a, b in steps(offsets):
                doc, feature = _present(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], m["table"])
                z[a:b] += np.bincount(doc, weights=m["weight"][feature], minlength=b - a)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], [*names, "score"])

    return docs.select(*names, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> DataFrame:
    """Fit on the label rows where ``learn`` holds and score every row of ``docs``: id column, score.

    NULL labels and NULL ids are not learned from; a document labelled both
    ways counts for both.  Repeated rows are scored each.  With labels of one
    class only every score is that of a constant low bias.  Other columns are
    not used.  An empty table gives an empty table.
    """
    model = fit(docs, labels, learn, id_col, text_col, label_col)
    return toxicity(docs.select(id_col, text_col), model, text_col)
