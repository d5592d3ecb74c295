"""Substring dedup: Rabin-Karp hashes of every window of ``width`` words,
counted in Spark; repeated windows merge into maximal removal intervals.

1. Documents are dealt into chunks of ascending id.  Each chunk hashes all its
   windows and sends every distinct hash once (sorted, as differences) to the
   bucket of its hash range: a window that a third of all documents share is
   one value per chunk.
2. A bucket finds, per hash, the smallest id range that has it (chunks are id
   ranges, or share one id): chunks of later ranges have a smaller document
   elsewhere and are told so with one bit per hash they sent.
3. Each chunk hashes its windows again, applies the bits, compares documents
   of its own by id, and merges the flagged windows into intervals.

Hashes have 64 bits; two different windows that collide would be taken for a
repeat (chance about n^2 / 2^65 for n windows).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import hashing
from tillroll.llm.chunks import (NULL_ID, bucket_cuts, chunking, from_blobs, lean, own_columns, pack_sorted,
                                 packed, steps, text_buffers, unpack_sorted)

WINDOW = 50
PER_BUCKET = 2_000_000
PER_SLICE = 500_000  # hashes that a bucket compares at once
STEP_BYTES = 256 << 10


def _windows(who: np.ndarray, data: np.ndarray, offsets: np.ndarray, width: int):
    """All windows of a chunk: hash, ``who`` of the document, first word (counted over the chunk); words of each document."""
    out, counts, base = [], np.zeros(len(offsets) - 1, np.int64), 0
    for a, b in steps(offsets, STEP_BYTES):
        h, _, _, first = hashing.word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        counts[a:b] = n = np.diff(first)
        w = hashing.windows(hashing.prefix(h), width)
        at = np.flatnonzero(np.arange(len(w)) + width <= np.repeat(first[1:], n)[:len(w)])
        out.append((hashing.mix(w[at]), np.repeat(who[a:b], n)[at], (at + base).astype(np.int32)))
        base += len(h)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), counts
    h, doc, at = (np.concatenate(x) for x in zip(*out))
    return h, doc, at, counts


def _sorted_runs(h: np.ndarray):
    """Order of the hashes, the hashes in it, the start of each run of equal ones and the length of each run."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
    return order, s, first, np.diff(np.append(first, len(s)))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW,
                    keep_untouched: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``width`` words that also
    starts in a document with a smaller id.

    Returns the columns of ``docs`` with the text replaced by the kept words
    joined by one space, and n_words, n_removed (long) and removed (array of
    struct(start, length), maximal runs of removed words).  With
    ``keep_untouched`` a text that loses nothing stays as it is.

    Words are runs of other characters than space and tab to carriage return.
    A NULL or empty text has no words and gives an empty text (NULL stays NULL
    with ``keep_untouched``).  Rows with the same id are one document: none is
    smaller than the other.  A NULL id sorts before all ids.  Columns of
    ``docs`` named like a result column are replaced.  An empty table gives an
    empty table.
    """
    own = own_columns(docs, "n_words", "n_removed", "removed")
    docs = docs.select(*own)
    plan = chunking(docs, id_col, text_col)
    ranges = plan.ranges
    buckets = plan.buckets(plan.text_bytes // 5, PER_BUCKET)
    chunks = packed(docs, id_col, plan, text_col)

    def read(table: pa.Table):
        """Documents of a chunk by ascending id, their text, and a number that ascends with the id."""
        d = from_blobs(table.column("blob"), own)
        ids = pc.fill_null(d.column(id_col).cast(pa.int64()), NULL_ID).to_numpy()
        if (ids[1:] < ids[:-1]).any():
            order = np.argsort(ids, kind="stable")
            d, ids = d.take(pa.array(order)).combine_chunks(), ids[order]
        who = np.cumsum(np.append(0, ids[1:] != ids[:-1])[:len(ids)]).astype(np.int32)
        return d, *text_buffers(d.column(text_col)), who

    def count(table: pa.Table) -> pa.Table:
        _, data, offsets, who = read(table)
        u = np.unique(_windows(who, data, offsets, width)[0])
        cuts = bucket_cuts(u, buckets)
        some = [i for i in range(buckets) if cuts[i + 1] > cuts[i]]
        return pa.table({"bucket": pa.array(some, pa.int32()),
                         "chunk": pa.array([table.column("chunk")[0].as_py()] * len(some), pa.int32()),
                         "hashes": pa.array([pack_sorted(u[cuts[i]:cuts[i + 1]]) for i in some], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        t = table.sort_by("chunk")
        parts = [unpack_sorted(b.as_py()) for b in t.column("hashes")]
        of = ranges[t.column("chunk").to_numpy()]
        bits = [np.zeros(len(p), bool) for p in parts]
        slices = -(-sum(map(len, parts)) // PER_SLICE)
        low = t.column("bucket")[0].as_py() * slices
        starts = np.array([(i << 64) // (buckets * slices) for i in range(low, low + slices)], np.uint64)
        cuts = np.array([np.append(np.searchsorted(p, starts), len(p)) for p in parts])
        for a, b in zip(cuts.T, cuts.T[1:]):
            order, _, first, size = _sorted_runs(np.concatenate([p[x:y] for p, x, y in zip(parts, a, b)]))
            r = np.repeat(of, b - a)[order]
            later = np.zeros(len(order), bool)
            later[order] = r > np.repeat(r[first], size)  # parts ascend by range
            ends = np.cumsum(b - a)
            for x, p, q, e in zip(bits, a, b, ends):
                x[p:q] = later[e - (q - p):e]
        some = [i for i, b in enumerate(bits) if b.any()]
        return pa.table({"chunk": t.column("chunk").take(pa.array(some, pa.int64())),
                         "bucket": t.column("bucket").take(pa.array(some, pa.int64())),
                         "bits": pa.array([np.packbits(bits[i]).tobytes() for i in some], pa.binary())})

    def covered(data, offsets, who, right: pa.Table):
        """(words of each document, whether each word goes)."""
        h, doc, at, counts = _windows(who, data, offsets, width)
        order, s, first, size = _sorted_runs(h)
        cuts = bucket_cuts(s[first], buckets)
        doc = doc[order]
        least = doc[first]  # documents ascend by id, and equal hashes stay in their order
        for b, bits in zip(right.column("bucket").to_pylist(), right.column("bits").to_pylist()):
            elsewhere = np.unpackbits(np.frombuffer(bits, np.uint8), count=cuts[b + 1] - cuts[b]).astype(bool)
            least[cuts[b]:cuts[b + 1]][elsewhere] = -1
        pos = at[order[doc > np.repeat(least, size)]]
        mark = np.zeros(counts.sum() + width + 1, np.int32)
        np.add.at(mark, pos, 1)
        np.add.at(mark, pos + width, -1)
        return counts, np.cumsum(mark[:counts.sum()], dtype=np.int32) > 0

    schema = docs.schema
    out_schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema] + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])))])

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        d, data, offsets, who = read(left)
        counts, gone = covered(data, offsets, who, right)
        base = np.concatenate([[0], np.cumsum(counts)])
        texts, removed, n_removed = [], [], np.zeros(len(counts), np.int64)
        raw = data.tobytes()
        null = d.column(text_col).is_null().to_pylist()
        for i in range(len(counts)):
            g = gone[base[i]:base[i + 1]]
            text = raw[offsets[i]:offsets[i + 1]]
            if not g.any():
                texts.append((None if null[i] else text.decode()) if keep_untouched
                             else b" ".join(text.split()).decode())
                removed.append([])
                continue
            n_removed[i] = g.sum()
            edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
            texts.append(b" ".join([w for w, x in zip(text.split(), g.tolist()) if not x]).decode())
            removed.append([{"start": int(x), "length": int(y - x)} for x, y in edge.reshape(-1, 2)])
        cols = {c: d.column(c) for c in own}
        cols[text_col] = pa.array(texts, pa.string())
        cols |= {"n_words": pa.array(counts), "n_removed": pa.array(n_removed),
                 "removed": pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))}
        return pa.table(cols)

    replies = (chunks.groupBy("chunk").applyInArrow(lean(count), "bucket int, chunk int, hashes binary")
               .groupBy("bucket").applyInArrow(lean(answer), "chunk int, bucket int, bits binary"))
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(lean(apply), out_schema)
