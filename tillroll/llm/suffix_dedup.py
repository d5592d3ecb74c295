"""Suffix-array dedup by prefix-free parsing: every byte covered by a string of
``width`` bytes that also starts anywhere else goes.

Parse.  A rolling hash of 16 bytes triggers phrase starts, so equal content is
cut alike wherever it stands.  Every window of ``width`` bytes belongs to the
first phrase start t inside it (at most ``width - ANCHOR`` bytes from the
window's own start).  A *phrase* is the run of windows that belong to one t,
with the look-ahead they read; it has an anchor key (the ``ANCHOR`` bytes at
t, which all its windows contain) and a content key.  Windows without a
trigger in reach are phrases of their own.

Dictionary.  Each chunk sends the distinct phrases it has.  Per anchor key
Spark finds: seen once (no window of it is repeated); one content seen
several times (all its windows are repeated, nothing else to do: this is what
shrinks highly repetitive text); or several contents, which have to be
compared.

Suffix order.  Only the last kind is sent as text, each distinct phrase once.
A task sorts the suffixes of its share of the dictionary by prefix doubling up
to ``width`` bytes (8, 16, 32, ... bytes at a time, exact, no hashing), where
equal neighbours in the order are the repeated windows.  The parse maps them
back: each chunk is told which windows of which phrases are repeated.  An
anchor key with more than ``HOT`` different contents would not fit a task; its
windows are counted one by one over all tasks by their 64-bit hashes instead.

Keys are 64-bit hashes: phrases that collide would be taken for equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm import hashing
from tillroll.llm.chunks import (bucket_cuts, chunking, from_blobs, own_columns, pack_sorted, packed, steps,
                                 text_buffers, unpack_sorted)

WIDTH = 200
ANCHOR = 48
TRIGGER = 16
MODULUS = 32
HOT = 4096
FIRST = 6
BUCKET_BYTES = 8 << 20
SORT_BYTES = 256 << 10
STEP_BYTES = 256 << 10
# what a bucket tells about a phrase
NONE, ALL, SORT, SORT_ALL, COUNT, COUNT_ALL = range(6)


def _phrases(data: np.ndarray, offsets: np.ndarray, width: int):
    """All phrases of a chunk: first window, number of windows, anchor offset, anchor key, content key."""
    reach = width - ANCHOR
    out = []
    for a, b in steps(offsets, STEP_BYTES):
        lo, d = offsets[a], offsets[a:b + 1] - offsets[a]
        s = hashing.prefix(hashing.BYTE[data[offsets[a]:offsets[b]]])
        t = np.flatnonzero(hashing.mix(hashing.windows(s, TRIGGER)) % np.uint64(MODULUS) == 0)
        doc = np.searchsorted(d, t, side="right") - 1
        ok = t + ANCHOR <= d[doc + 1]
        t, doc = t[ok], doc[ok]
        before = np.append(-1, t[:-1])[:len(t)]
        before = np.where(np.append(-1, doc[:-1])[:len(t)] == doc, before, d[doc] - 1)
        first = np.maximum(before + 1, t - reach)
        last = np.minimum(t, d[doc + 1] - width)
        ok = first <= last
        t, first, last = t[ok], first[ok], last[ok]
        near = hashing.mix(hashing.spans(s, t, t + ANCHOR))
        content = hashing.spans(s, first, last + width)
        content = hashing.mix(content + ((t - first) * 4096 + (last - first) + 1).astype(np.uint64))
        # windows that no phrase holds
        mark = np.zeros(len(s), np.int8)
        starts = np.flatnonzero(np.diff(d) >= width)
        np.add.at(mark, d[starts], 1)
        np.add.at(mark, d[starts + 1] - width + 1, -1)
        np.add.at(mark, first, -1)
        np.add.at(mark, last + 1, 1)
        rest = np.flatnonzero(np.cumsum(mark, dtype=np.int8))
        lone = hashing.mix(hashing.spans(s, rest, rest + width) ^ np.uint64(0x5851F42D4C957F2D))
        one, zero = np.ones(len(rest), np.int64), np.zeros(len(rest), np.int64)
        out.append((np.concatenate([first, rest]) + lo, np.concatenate([last - first + 1, one]),
                    np.concatenate([t - first, zero]), np.concatenate([near, lone]), np.concatenate([content, lone])))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _distinct(near: np.ndarray, content: np.ndarray):
    """Distinct phrases by (anchor key, content key): one occurrence of each, its count, and the number of each phrase."""
    _, at, inverse, count = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
    order = np.lexsort((content[at], near[at]))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return at[order], count[order], place[inverse]


def repeated_suffixes(text: np.ndarray, begin: np.ndarray, windows: np.ndarray, weight: np.ndarray,
                      width: int, group: np.ndarray | None = None) -> np.ndarray:
    """For every window (all of phrase 0, then phrase 1, ...): does its text occur with total weight > 1?

    Phrase i starts at ``begin[i]`` (ascending, the first at 0) and has ``windows[i]`` window starts; phrases
    of different ``group`` (below 2^16) share no window.  The suffix order is built by doubling.  A suffix
    whose first ``FIRST`` bytes occur once in its group has its place by them, and no window that
    holds such a place is repeated: only the text of the other windows is ranked on, by 8 bytes, then by pairs of ranks.
    """
    at = np.repeat(begin - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    weight = np.repeat(weight, windows)
    key = _first_bytes(text, FIRST)
    if group is not None:
        key |= np.repeat(group.astype(np.uint64) << np.uint64(8 * FIRST), np.diff(np.append(begin, len(text))))
    order = np.argsort(key)
    new = np.append(True, key[order[1:]] != key[order[:-1]])
    once = np.zeros(len(text), bool)
    once[order] = new & np.append(new[1:], True)
    before = np.append(0, np.cumsum(once, dtype=np.int32))
    hit = weight > 1
    open_ = np.flatnonzero(before[at + width - FIRST + 1] == before[at])
    if len(open_):
        at, mark = at[open_], np.zeros(len(text) + 1, np.int32)
        np.add.at(mark, at, 1)
        np.add.at(mark, at + width, -1)
        read = np.cumsum(mark[:-1]) > 0
        rank = _ranks(text[read], width)[(np.cumsum(read) - 1)[at]]
        hit[open_] = np.bincount(rank, weights=weight[open_])[rank] > 1
    return hit


def _first_bytes(text: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` (8 at most) bytes from every position on as a number; zeros follow the end."""
    n, out = len(text), np.zeros(len(text), np.uint64)
    padded = np.concatenate([text, np.zeros(size, np.uint8)])
    for k in range(size):
        out <<= np.uint64(8)
        out |= padded[k:n + k]
    return out


def _ranks(text: np.ndarray, width: int) -> np.ndarray:
    """Rank of the ``width`` bytes (8 at least) from every position on, by doubling."""
    n, size = len(text), 8
    rank = np.unique(_first_bytes(text, size), return_inverse=True)[1]
    while size < width:
        step = min(size, width - size)
        pair = rank.astype(np.uint64) << np.uint64(32)
        pair[:max(0, n - step)] |= rank[step:].astype(np.uint64)
        rank = np.unique(pair, return_inverse=True)[1]
        size += step
    return rank


def _blob(**arrays: np.ndarray) -> bytes:
    """Named arrays in one binary value."""
    head = ";".join(f"{k},{v.dtype.str},{len(v)}" for k, v in arrays.items()).encode()
    return len(head).to_bytes(4, "little") + head + b"".join(np.ascontiguousarray(v).tobytes() for v in arrays.values())


def _arrays(blob: bytes) -> dict[str, np.ndarray]:
    n, out = int.from_bytes(blob[:4], "little"), {}
    at = 4 + n
    for x in blob[4:4 + n].decode().split(";"):
        name, kind, size = x.split(",")
        out[name] = np.frombuffer(blob, np.dtype(kind), int(size), at)
        at += out[name].nbytes
    return out


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Remove each byte covered by a ``width``-byte string that also starts elsewhere (overlaps count).

    Returns the columns of ``docs`` except the text, and n_bytes, n_removed,
    n_spans (long), kept (binary: the remaining bytes; a cut may fall inside a
    character) and removed (array of struct(start, length) in bytes, maximal).
    Texts are judged as given, as UTF-8 bytes; matches never cross documents;
    a text shorter than ``width`` loses nothing.  A NULL text is empty.
    Repeated rows (also with the same id) are different documents.  Columns
    named like a result column are replaced.  An empty table gives none.
    """
    if width < ANCHOR + 1:
        raise ValueError(f"width must be over {ANCHOR}")
    taken = ("n_bytes", "n_removed", "n_spans", "kept", "removed")
    own = own_columns(docs, *taken)
    docs = docs.select(*own)
    plan = chunking(docs, id_col, text_col)
    buckets = plan.buckets(plan.text_bytes, BUCKET_BYTES)
    chunks = packed(docs, id_col, plan, text_col)
    i32, binary = pa.int32(), pa.binary()

    def read(table: pa.Table):
        d = from_blobs(table.column("blob"), own)
        data, offsets = text_buffers(d.column(text_col))
        first, n, off, near, content = _phrases(data, offsets, width)
        at, count, of = _distinct(near, content)
        return d, data, offsets, first, n, off, near[at], content[at], at, count, of

    def dictionary(table: pa.Table) -> pa.Table:
        *_, near, content, _, count, _ = read(table)
        cuts = bucket_cuts(near, buckets)
        some = [i for i in range(buckets) if cuts[i + 1] > cuts[i]]
        blobs = [_blob(near=np.frombuffer(pack_sorted(near[a:b]), np.uint8), content=content[a:b],
                       many=np.packbits(count[a:b] > 1)) for a, b in ((cuts[i], cuts[i + 1]) for i in some)]
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"bucket": pa.array(some, i32), "chunk": pa.array([chunk] * len(some), i32),
                         "blob": pa.array(blobs, binary)})

    def judge(table: pa.Table) -> pa.Table:
        t = table.sort_by("chunk")
        parts = [_arrays(x.as_py()) for x in t.column("blob")]
        near = np.concatenate([unpack_sorted(p["near"].tobytes()) for p in parts])
        content = np.concatenate([p["content"] for p in parts])
        many = np.concatenate([np.unpackbits(p["many"], count=len(p["content"])) for p in parts])
        order = np.lexsort((np.arange(len(near)), content, near))
        k, r = near[order], content[order]
        new_k = np.append(True, k[1:] != k[:-1])
        new_r = new_k | np.append(True, r[1:] != r[:-1])
        of_k, of_r = np.cumsum(new_k) - 1, np.cumsum(new_r) - 1
        seen = 1 + many[order].astype(np.int64)
        in_k, in_r = np.bincount(of_k, weights=seen)[of_k], np.bincount(of_r, weights=seen)[of_r]
        contents = np.bincount(of_k, weights=new_r)[of_k]
        says = np.where(contents > HOT, COUNT, SORT)
        says = np.where(in_r > 1, np.where(new_r, says + 1, ALL), says)  # a repeated phrase is sent once
        says = np.where(contents == 1, np.where(in_k > 1, ALL, NONE), says)
        back = np.empty(len(order), np.uint8)
        back[order] = says
        ends = np.cumsum([len(p["content"]) for p in parts])
        says = [back[e - len(p["content"]):e] for p, e in zip(parts, ends)]
        some = pa.array([i for i, x in enumerate(says) if x.any()], pa.int64())
        return pa.table({"chunk": t.column("chunk").take(some), "bucket": t.column("bucket").take(some),
                         "kind": pa.array(["phrase"] * len(some), pa.string()),
                         "blob": pa.array([says[i].tobytes() for i in some.to_pylist()], binary)})

    def told(near: np.ndarray, right: pa.Table) -> np.ndarray:
        says, cuts = np.zeros(len(near), np.uint8), bucket_cuts(near, buckets)
        for b, kind, blob in zip(*(right.column(c).to_pylist() for c in ("bucket", "kind", "blob"))):
            if kind == "phrase":
                says[cuts[b]:cuts[b + 1]] = np.frombuffer(blob, np.uint8)
        return says

    def one_by_one(data, first, n, at, says):
        """Hashes of the windows of the phrases to be counted: sorted distinct values, weights, value of each window."""
        pick = np.flatnonzero((says == COUNT) | (says == COUNT_ALL))
        hashes = []
        for i in pick:
            text = data[first[at[i]]:first[at[i]] + n[at[i]] - 1 + width]
            hashes.append(hashing.mix(hashing.windows(hashing.prefix(hashing.BYTE[text]), width)))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        u, inverse = np.unique(h, return_inverse=True)
        weight = np.bincount(inverse, weights=np.repeat(1 + (says[pick] == COUNT_ALL), n[at[pick]]), minlength=len(u))
        return pick, u, weight > 1, inverse

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"bucket": pa.array([], i32), "chunk": pa.array([], i32), "blob": pa.array([], binary)})
        _, data, _, first, n, off, near, content, at, _, _ = read(left)
        says = told(near, right)
        out = []
        pick = np.flatnonzero((says == SORT) | (says == SORT_ALL))
        cuts = bucket_cuts(near[pick], buckets)
        for b in range(buckets):
            p = pick[cuts[b]:cuts[b + 1]]
            if len(p):
                text = [data[x:x + m - 1 + width] for x, m in zip(first[at[p]], n[at[p]])]
                out.append((b, _blob(near=near[p], content=content[p], n=n[at[p]].astype(np.uint8),
                                     twice=(says[p] == SORT_ALL).astype(np.uint8), text=np.concatenate(text))))
        _, u, many, _ = one_by_one(data, first, n, at, says)
        cuts = bucket_cuts(u, buckets)
        out += [(buckets + b, _blob(hashes=np.frombuffer(pack_sorted(u[x:y]), np.uint8), many=many[x:y].astype(np.uint8)))
                for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        chunk = left.column("chunk")[0].as_py()
        return pa.table({"bucket": pa.array([x[0] for x in out], i32), "chunk": pa.array([chunk] * len(out), i32),
                         "blob": pa.array([x[1] for x in out], binary)})

    def compare(table: pa.Table) -> pa.Table:
        t = table.sort_by("chunk")
        chunk = t.column("chunk").to_numpy()
        bucket = t.column("bucket")[0].as_py()
        parts = [_arrays(x.as_py()) for x in t.column("blob")]
        out = []
        if bucket >= buckets:
            values = [unpack_sorted(p["hashes"].tobytes()) for p in parts]
            u, inverse = np.unique(np.concatenate(values), return_inverse=True)
            total = np.bincount(inverse, weights=1 + np.concatenate([p["many"] for p in parts]))
            hit = (total > 1)[inverse]
            ends = np.cumsum([len(v) for v in values])
            out = [(c, "count", np.packbits(hit[e - len(v):e]).tobytes()) for c, v, e in zip(chunk, values, ends)]
        else:
            near = np.concatenate([p["near"] for p in parts])
            content = np.concatenate([p["content"] for p in parts])
            n = np.concatenate([p["n"] for p in parts]).astype(np.int64)
            weight = 1 + np.concatenate([p["twice"] for p in parts]).astype(np.int64)
            text = np.concatenate([p["text"] for p in parts])
            of = np.repeat(chunk, [len(p["n"]) for p in parts])
            size = n - 1 + width
            begin = np.cumsum(size) - size
            order = np.argsort(near, kind="stable")
            ends = np.flatnonzero(np.append(near[order][1:] != near[order][:-1], True)) + 1
            done = np.cumsum(size[order])
            a, told_to = 0, []
            while a < len(order):  # anchor keys are independent: sort a few at a time
                b = int(np.searchsorted(done[ends - 1], (done[a - 1] if a else 0) + SORT_BYTES))
                b = int(ends[max(b - 1, int(np.searchsorted(ends, a, side="right")))])
                p = order[a:b]
                inside = np.repeat(begin[p] - np.cumsum(size[p]) + size[p], size[p]) + np.arange(size[p].sum())
                group = np.cumsum(np.append(False, near[p[1:]] != near[p[:-1]]))
                hit = repeated_suffixes(text[inside], np.cumsum(size[p]) - size[p], n[p], weight[p], width, group)
                row = np.repeat(np.arange(len(p)), n[p])
                flags = np.zeros((len(p), width - ANCHOR + 1), bool)
                flags[row, np.arange(len(row)) - np.repeat(np.cumsum(n[p]) - n[p], n[p])] = hit
                some = np.flatnonzero(flags.any(axis=1) & (weight[p] == 1))
                told_to.append((of[p[some]], content[p[some]], np.packbits(flags[some], axis=1)))
                a = b
            to, key, bits = (np.concatenate(x) for x in zip(*told_to))
            for c in np.unique(to):
                m = to == c
                out.append((c, "sort", _blob(content=key[m], bits=bits[m].ravel())))
        return pa.table({"chunk": pa.array([int(x[0]) for x in out], i32),
                         "bucket": pa.array([bucket] * len(out), i32),
                         "kind": pa.array([x[1] for x in out], pa.string()),
                         "blob": pa.array([x[2] for x in out], binary)})

    keep = [f for f in docs.schema if f.name != text_col]
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in keep] + [
        T.StructField(c, T.LongType()) for c in taken[:3]] + [
        T.StructField("kept", T.BinaryType()), T.StructField("removed", T.ArrayType(span))])

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        d, data, offsets, first, n, _, near, content, at, _, of = read(left)
        says = told(near, right)
        start = np.zeros(len(data) + 1, bool)  # repeated windows

        def flag(which, hit=None):
            where = np.repeat(first[which] - np.cumsum(n[which]) + n[which], n[which]) + np.arange(n[which].sum())
            start[where if hit is None else where[hit]] = True

        flag(np.flatnonzero(np.isin(says[of], (ALL, SORT_ALL, COUNT_ALL))))
        pick, u, _, inverse = one_by_one(data, first, n, at, says)
        hit = np.zeros(len(u), bool)
        cuts = bucket_cuts(u, buckets)
        lookup = np.argsort(content)
        for b, kind, blob in zip(*(right.column(c).to_pylist() for c in ("bucket", "kind", "blob"))):
            if kind == "count":
                x, y = cuts[b - buckets], cuts[b - buckets + 1]
                hit[x:y] = np.unpackbits(np.frombuffer(blob, np.uint8), count=y - x)
            elif kind == "sort":
                x = _arrays(blob)
                where = at[lookup[np.searchsorted(content, x["content"], sorter=lookup)]]
                bits = np.unpackbits(x["bits"].reshape(len(where), -1), axis=1)[:, :width - ANCHOR + 1].astype(bool)
                flag(where, bits[np.arange(bits.shape[1]) < n[where][:, None]])
        if len(pick):
            flag(at[pick], hit[inverse])
        mark = np.zeros(len(data) + width + 1, np.int32)
        where = np.flatnonzero(start)
        mark[where] += 1
        mark[where + width] -= 1
        gone = np.cumsum(mark[:len(data)], dtype=np.int32) > 0
        kept, removed = [], []
        n_removed, n_spans = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
        for i, (x, y) in enumerate(zip(offsets, offsets[1:])):
            g = gone[x:y]
            n_removed[i] = g.sum()
            if not n_removed[i]:
                kept.append(data[x:y].tobytes())
                removed.append([])
                continue
            kept.append(data[x:y][~g].tobytes())
            cut = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8))).reshape(-1, 2)
            n_spans[i] = len(cut)
            removed.append([{"start": int(p), "length": int(q - p)} for p, q in cut])
        cols = {f.name: d.column(f.name) for f in keep}
        cols |= {"n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(n_removed), "n_spans": pa.array(n_spans),
                 "kept": pa.array(kept, binary),
                 "removed": pa.array(removed, pa.list_(pa.struct([("start", i32), ("length", i32)])))}
        return pa.table(cols)

    reply = "chunk int, bucket int, kind string, blob binary"
    judged = (chunks.groupBy("chunk").applyInArrow(dictionary, "bucket int, chunk int, blob binary")
              .groupBy("bucket").applyInArrow(judge, reply))
    compared = (chunks.groupBy("chunk").cogroup(judged.groupBy("chunk"))
                .applyInArrow(send, "bucket int, chunk int, blob binary")
                .groupBy("bucket").applyInArrow(compare, reply))
    return chunks.groupBy("chunk").cogroup(judged.unionByName(compared).groupBy("chunk")).applyInArrow(apply, schema)
