"""LM scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark.

Counting.  Tasks count their tokens and bigrams (64-bit hashes) and send each
distinct one once to a hash bucket: bigrams by their first word, so that a
bucket knows all followers of a word, except after the few words that hold
over 1 / ``HOT`` of all tokens (known from the token counts), whose bigrams
are dealt by both words and whose follower statistics are added up afterwards.

Store.  Every bucket writes its sorted hash arrays once, under a final name
and by rename (a repeated task writes the same bytes), to the folder that
``spark.checkpoint.dir`` names; it must be mounted on the workers.

Scoring.  Workers memory-map the arrays, look up the distinct bigrams of some
documents at a time in sorted order, and add up log10 probabilities.

Discounts are the three of modified Kneser-Ney, from counts of counts; the
lower order counts distinct left neighbours and is interpolated with the
uniform distribution over the known tokens and one unknown.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing
from tillroll.llm.chunks import bucket_cuts, bucket_of, pack_sorted, steps, text_buffers, unpack_sorted
from tillroll.llm.graph import cut
from tillroll.llm.suffix_dedup import _arrays, _blob
from tillroll.session import checkpoint_dir

BEGIN, END = np.uint64(0x1000000000000001), np.uint64(0x8000000000000003)
HOT = 1024
PER_BUCKET = 2_000_000
FLUSH = 3_000_000  # tokens that a task counts before it sends
STEP = 4 << 20
MAPS = 2048  # memory-mapped files that a task keeps open
# arrays that are written together with another one
STORED_WITH = {"count": "token", "seen": "key", "big": "key", "value": "key", "context": "key", "stats": "key", "left": "word"}


def _folder(uri: str) -> str:
    u = urlparse(uri)
    if u.scheme not in ("", "file"):
        raise ValueError(f"the n-gram store is memory-mapped: {uri} must be a mounted folder (file:)")
    return u.path


def _save(folder: str, name: str, array: np.ndarray) -> None:
    tmp = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(tmp, "wb") as f:
        np.save(f, array)
    os.replace(tmp, f"{folder}/{name}.npy")


class _Maps:
    """Memory-mapped arrays of a store, opened when first asked for; at most ``MAPS`` stay open.

    Which buckets hold anything is part of the model: a file that should be there and isn't raises an error.
    """

    def __init__(self, model: dict):
        self.folder, self.filled, self.open = model["folder"], model["filled"], {}

    def __call__(self, kind: str, bucket: int) -> np.ndarray | None:
        if not self.filled[STORED_WITH.get(kind, kind)][bucket]:
            return None
        name = f"{kind}-{bucket}"
        if name not in self.open:
            if len(self.open) >= MAPS:
                self.open.pop(next(iter(self.open)))
            path = f"{self.folder}/{name}.npy"
            if not os.path.exists(path):
                raise FileNotFoundError(f"n-gram store: {path} is missing; is {self.folder} mounted on this machine?")
            self.open[name] = np.load(path, mmap_mode="r")
        return self.open[name]


def _filled(buckets: int, some) -> np.ndarray:
    out = np.zeros(buckets, bool)
    out[list(some)] = True
    return out


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return hashing.mix(v ^ hashing.mix(w))


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """(token, token before it, first token of each document) for whole texts, lower-cased A-Z, each with its end."""
    h, _, _, first = hashing.word_hashes(hashing.LOWER[data], offsets)
    ends = first[1:] + np.arange(len(first) - 1)
    tok = np.empty(len(h) + len(ends), np.uint64)
    is_end = np.zeros(len(tok), bool)
    is_end[ends] = True
    tok[ends] = END
    tok[~is_end] = h
    starts = np.append(0, ends[:-1] + 1)[:len(ends)]
    before = np.append(BEGIN, tok[:-1])[:len(tok)]
    before[starts] = BEGIN
    return tok, before, starts


def _sum(keys: list[np.ndarray], counts: list[np.ndarray]):
    """Distinct keys, sorted, with their summed counts; keys is a list of equal-length columns, first most significant."""
    order = np.lexsort(keys[::-1])
    cols = [k[order] for k in keys]
    new = np.append(True, np.any([c[1:] != c[:-1] for c in cols], axis=0)) if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)
    return [c[at] for c in cols], total


def _small(counts: np.ndarray):
    """Counts as uint8, those over 254 as 255 with their places and values apart."""
    big = np.flatnonzero(counts > 254)
    return np.minimum(counts, 255).astype(np.uint8), big, counts[big]


def _discounts(n: list[int]) -> np.ndarray:
    """Discount of counts 0, 1, 2, 3 and more, from the numbers of items seen 1, 2, 3, 4 times."""
    d = [0.0]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    for k in (1, 2, 3):
        d.append(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), float(k)) if n[k - 1] else 0.5 * k)
    return np.array(d)


def _counting(batches, collect, emit):
    """Feed the texts of a task to ``collect`` in steps and ``emit`` whenever enough tokens are in."""
    seen = 0
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for a, b in steps(offsets, STEP):
            seen += collect(*_tokens(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])[:2])
            if seen >= FLUSH:
                yield from emit()
                seen = 0
    if seen:
        yield from emit()


def train(docs: DataFrame, text_col: str = "text") -> dict:
    """Count and store the model of all texts of ``docs``; returns where it lies and its totals."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("t"))
    size = int(texts.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0])
    buckets = max(8, -(-size // 6 // PER_BUCKET))
    folder = f"{_folder(checkpoint_dir(spark))}/ngram-{uuid.uuid4().hex}"
    os.makedirs(folder, exist_ok=True)
    row = "bucket int, blob binary"

    def rows(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["bucket", "blob"])

    # tokens -----------------------------------------------------------------
    def count_tokens(batches):
        got = []

        def collect(tok, before):
            got.append(np.unique(tok, return_counts=True))
            return len(tok)

        def emit():
            (w,), c = _sum([np.concatenate([x[0] for x in got])], np.concatenate([x[1] for x in got]))
            got.clear()
            cuts = bucket_cuts(w, buckets)
            yield rows([(b, _blob(w=np.frombuffer(pack_sorted(w[x:y]), np.uint8), c=c[x:y].astype(np.uint32)))
                        for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x])

        yield from _counting(batches, collect, emit)

    def store_tokens(table: pa.Table) -> pa.Table:
        parts = [_arrays(x.as_py()) for x in table.column("blob")]
        (w,), c = _sum([np.concatenate([unpack_sorted(p["w"].tobytes()) for p in parts])],
                       np.concatenate([p["c"] for p in parts]).astype(np.int64))
        b = table.column("bucket")[0].as_py()
        _save(folder, f"token-{b}", w)
        _save(folder, f"count-{b}", c)
        top = np.argsort(-c, kind="stable")[:HOT]
        return pa.table({"w": pa.array([None, *w[top].view(np.int64).tolist()], pa.int64()),
                         "n": pa.array([int(c.sum()), *c[top].tolist()], pa.int64()),
                         "kinds": pa.array([len(w), *[0] * len(top)], pa.int64()),
                         "b": pa.array([b] * (len(top) + 1), pa.int32())})

    stored = cut(texts.mapInArrow(count_tokens, row).groupBy("bucket").applyInArrow(
        store_tokens, "w long, n long, kinds long, b int"))
    total = stored.where("w is null").agg(F.sum("n"), F.sum("kinds"), F.collect_list("b")).first()
    tokens, kinds = int(total[0] or 0), int(total[1] or 0)
    # fewer than HOT words can hold over 1 / HOT of all tokens each
    hot = [r[0] for r in stored.where(F.col("w").isNotNull() & (F.col("n") > tokens / HOT)).select("w").collect()]
    hot = np.sort(np.append(np.array(hot, np.int64).view(np.uint64), BEGIN))
    model = {"folder": folder, "buckets": buckets, "tokens": tokens, "kinds": kinds, "hot": hot,
             "filled": {"token": _filled(buckets, total[2])}}

    # bigrams ----------------------------------------------------------------
    def count_pairs(batches):
        got = []

        def collect(tok, before):
            (v, w), c = _sum([before, tok >> np.uint64(16)], np.ones(len(tok), np.int64))
            got.append((v, w, c))
            return len(tok)

        def emit():
            v, w, c = (np.concatenate(x) for x in zip(*got))
            got.clear()
            (v, w), c = _sum([v, w], c)
            b = _pair_bucket(v, w, model)
            order = np.argsort(b, kind="stable")
            v, w, c, b = v[order], w[order], c[order], b[order]
            cuts = np.searchsorted(b, np.arange(buckets + 1))
            out = []
            for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if y > x:
                    at = np.flatnonzero(np.append(True, v[x + 1:y] != v[x:y - 1]))
                    out.append((k, _blob(v=np.frombuffer(pack_sorted(v[x:y][at]), np.uint8),
                                         run=np.diff(np.append(at, y - x)).astype(np.uint32),
                                         w=np.ascontiguousarray(w[x:y].view(np.uint8).reshape(-1, 8)[:, :6]).ravel(),
                                         c=c[x:y].astype(np.uint32))))
            yield rows(out)

        yield from _counting(batches, collect, emit)

    def store_pairs(table: pa.Table) -> pa.Table:
        b = table.column("bucket")[0].as_py()
        vs, ws, cs = [], [], []
        for p in map(lambda x: _arrays(x.as_py()), table.column("blob")):
            vs.append(np.repeat(unpack_sorted(p["v"].tobytes()), p["run"]))
            wide = np.zeros((len(p["w"]) // 6, 8), np.uint8)
            wide[:, :6] = p["w"].reshape(-1, 6)
            ws.append(wide.view(np.uint64).ravel())
            cs.append(p["c"])
        (v, w), c = _sum([np.concatenate(vs), np.concatenate(ws)], np.concatenate(cs).astype(np.int64))
        key = _pair(v, w)
        order = np.argsort(key)
        small, big, value = _small(c[order])
        for name, x in (("key", key[order]), ("seen", small), ("big", big), ("value", value)):
            _save(folder, f"{name}-{b}", x)
        at = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        stats = np.stack([np.add.reduceat(x.astype(np.int64), at) for x in (c, c == 1, c == 2, c > 2)], 1)
        first = v[at]
        is_hot = np.isin(first, hot)
        _save(folder, f"context-{b}", first[~is_hot])
        _save(folder, f"stats-{b}", stats[~is_hot].astype(np.uint32))
        (word,), left = _sum([w], np.ones(len(w), np.int64))
        cuts = bucket_cuts(word << np.uint64(16), buckets)
        cont = [(k, _blob(w=np.frombuffer(pack_sorted(word[x:y]), np.uint8), c=left[x:y].astype(np.uint32)))
                for k, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        seen = [*[int((c == k).sum()) for k in (1, 2, 3, 4)], b]
        small_rows = [(None, seen), *[(int(x), y) for x, y in zip(first[is_hot].view(np.int64), stats[is_hot].tolist())]]
        return pa.table({"bucket": pa.array([x[0] for x in cont] + [-1] * len(small_rows), pa.int32()),
                         "blob": pa.array([x[1] for x in cont] + [None] * len(small_rows), pa.binary()),
                         "v": pa.array([None] * len(cont) + [x[0] for x in small_rows], pa.int64()),
                         "s": pa.array([None] * len(cont) + [x[1] for x in small_rows], pa.list_(pa.int64()))})

    pairs = cut(texts.mapInArrow(count_pairs, row).groupBy("bucket").applyInArrow(
        store_pairs, row + ", v long, s array<long>"))
    sums = [F.sum(F.col("s")[i]) for i in range(4)]
    at_most = {r[0]: [int(x) for x in r[1:]] for r in pairs.where("bucket < 0").groupBy("v").agg(*sums).collect()}
    model["filled"]["key"] = _filled(buckets, [r[0] for r in pairs.where("bucket < 0 and v is null").select(F.col("s")[4]).collect()])
    model["d2"] = _discounts(at_most.pop(None, [0] * 4))
    model["hot_stats"] = np.array([at_most.get(int(x), [0] * 4) for x in hot.view(np.int64)], np.int64)

    # left neighbours of each word ---------------------------------------------
    def store_left(table: pa.Table) -> pa.Table:
        parts = [_arrays(x.as_py()) for x in table.column("blob")]
        (w,), c = _sum([np.concatenate([unpack_sorted(p["w"].tobytes()) for p in parts])],
                       np.concatenate([p["c"] for p in parts]).astype(np.int64))
        b = table.column("bucket")[0].as_py()
        _save(folder, f"word-{b}", w)
        _save(folder, f"left-{b}", c)
        s = [int(c.sum()), int((c > 2).sum()), *[int((c == k).sum()) for k in (1, 2, 3, 4)]]
        return pa.table({f"s{i}": pa.array([x], pa.int64()) for i, x in enumerate([*s, b])})

    left = pairs.where("bucket >= 0").select("bucket", "blob").groupBy("bucket").applyInArrow(
        store_left, ", ".join(f"s{i} long" for i in range(7)))
    *s, held = left.agg(*[F.sum(f"s{i}") for i in range(6)], F.collect_list("s6")).first()
    s = [int(x or 0) for x in s]
    model["filled"]["word"] = _filled(buckets, held)
    model["d1"] = _discounts(s[2:])
    model["left"] = s[0]
    model["rest"] = float(model["d1"][1] * s[2] + model["d1"][2] * s[3] + model["d1"][3] * s[1])
    return model


def _pair_bucket(v: np.ndarray, w: np.ndarray, model: dict) -> np.ndarray:
    is_hot = np.isin(v, model["hot"])
    return bucket_of(np.where(is_hot, hashing.mix(_pair(v, w)), v), model["buckets"])


def _lookup(maps: _Maps, keys: np.ndarray, bucket: np.ndarray, sorted_name: str, value_name: str, width: int = 0):
    """Values of ``keys`` (sorted by bucket, then key) in the stored arrays; 0 where a key is missing."""
    out = np.zeros((len(keys), width) if width else len(keys), np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    for x, y in zip(cuts, [*cuts[1:], len(keys)]):
        have = maps(sorted_name, bucket[x])
        if have is None or not len(have):
            continue
        at = np.minimum(np.searchsorted(have, keys[x:y]), len(have) - 1)
        hit = np.flatnonzero(have[at] == keys[x:y])
        out[x + hit] = maps(value_name, bucket[x])[at[hit]]
        if value_name == "seen":
            full = hit[out[x + hit] == 255]
            if len(full):
                big = np.searchsorted(maps("big", bucket[x]), at[full])
                out[x + full] = maps("value", bucket[x])[big]
    return out


def _score(model: dict, maps: _Maps, tok, before, starts):
    """Per document: tokens, known tokens, base score, model score."""
    buckets = model["buckets"]
    w, of = np.unique(tok, return_inverse=True)
    c = _lookup(maps, w, bucket_of(w, buckets), "token", "count")
    word = w >> np.uint64(16)
    left = _lookup(maps, word, bucket_of(word << np.uint64(16), buckets), "word", "left")
    d1, uniform = model["d1"], 1.0 / (model["kinds"] + 1)
    if model["left"]:
        p1 = (left - d1[np.minimum(left, 3)]) / model["left"] + model["rest"] / model["left"] * uniform
    else:
        p1 = np.full(len(w), uniform)
    v, of_v = np.unique(before, return_inverse=True)
    stats = _lookup(maps, v, bucket_of(v, buckets), "context", "stats", 4)
    hot = np.searchsorted(model["hot"], v)
    is_hot = model["hot"][np.minimum(hot, len(model["hot"]) - 1)] == v
    stats[is_hot] = model["hot_stats"][hot[is_hot]]
    (pv, pw), _ = _sum([of_v, of], np.ones(len(of), np.int64))
    vv, ww = v[pv], w[pw] >> np.uint64(16)
    key, b = _pair(vv, ww), _pair_bucket(vv, ww, model)
    order = np.lexsort((key, b))
    seen = np.zeros(len(key), np.int64)
    seen[order] = _lookup(maps, key[order], b[order], "key", "seen")
    d2 = model["d2"]
    total = stats[pv, 0].astype(float)
    rest = stats[pv, 1] * d2[1] + stats[pv, 2] * d2[2] + stats[pv, 3] * d2[3]
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.where(total > 0, (seen - d2[np.minimum(seen, 3)] + rest * p1[pw]) / total, p1[pw])
    log_p = np.log10(p)
    at = np.searchsorted(pv * len(w) + pw, of_v * len(w) + of)
    base = np.log10((c + 1) / (model["tokens"] + model["kinds"] + 1))
    n = np.diff(np.append(starts, len(tok)))
    return n, np.add.reduceat((c > 0)[of].astype(np.int64), starts), np.add.reduceat(base[of], starts), np.add.reduceat(
        log_p[at], starts)


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with n_tokens, n_known, train_tokens, base_score, score."""
    names = [c for c in docs.columns if c != text_col]
    where = docs.columns.index(text_col)
    others = [i for i, c in enumerate(docs.columns) if c != text_col]
    fields = [docs.schema[c] for c in names]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "n_tokens long", "n_known long",
                        "train_tokens long", "base_score double", "score double"])

    def run(batches):
        maps = _Maps(model)
        for batch in batches:
            data, offsets = text_buffers(batch.column(where))
            got = [_score(model, maps, *_tokens(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
                   for a, b in steps(offsets, STEP)]
            if not got:
                continue
            n, known, base, p = (np.concatenate(x) for x in zip(*got))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in others], pa.array(n), pa.array(known),
                 pa.array(np.full(len(n), model["tokens"], np.int64)), pa.array(base), pa.array(p)],
                [*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.mapInArrow(run, schema)


def perplexity(score_col: str = "score", tokens_col: str = "n_tokens"):
    return F.pow(F.lit(10.0), -F.col(score_col) / F.col(tokens_col))


def lm_scores(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows where the column expression ``learn`` is true and score all rows.

    Returns the id column, held_out (not learned from), n_tokens, n_known,
    train_tokens, base_score (add-one unigrams), score (log10 probability) and
    perplexity.  A NULL or empty text is its end token.  Repeated rows count
    and are scored each.  Where ``learn`` is NULL (a NULL id) the row is
    learned from.  Other columns are not used.  Without any training row all
    tokens are equally unlikely; an empty table gives an empty table.
    """
    picked = F.coalesce(learn, F.lit(True))
    rows = docs.select(F.col(id_col), (~picked).alias("held_out"), F.col(text_col).cast("string").alias("__text"))
    model = train(rows.where("not held_out"), "__text")
    return score(rows, model, "__text").withColumn("perplexity", perplexity())
