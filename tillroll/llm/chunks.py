"""Documents dealt into chunks of ascending id, as compressed Arrow blobs.

Operators that visit every text more than once (count something, learn which
counts repeat elsewhere, apply the answer) work on chunks: a chunk holds the
documents of one id range (about ``chunk_bytes`` of text), whatever columns
they have, as a few zstd-compressed Arrow blobs.  One exchange by chunk number
feeds all visits of a plan, blobs make it about half the size of rows.  Bounds are
quantiles of the bytes, and an id with more than a chunk is split by text hash,
so a chunk is small enough for one task at any input size, but for a single
text, or exact copies of one under one id, that are larger.
"""

from __future__ import annotations

import ctypes
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
# numpy work inside a chunk goes in steps of about this many bytes of text
STEP_BYTES = 1 << 20
NULL_ID = -(1 << 63)
NO_TIE = -(1 << 63)
ROW_BYTES = 64  # what a row weighs besides its text
MARKS = 64


@dataclass(frozen=True)
class Chunking:
    """Size of a document table and the (id, text hash) where each chunk but the first starts."""

    rows: int
    text_bytes: int
    bounds: tuple[tuple[int, int], ...]

    @property
    def chunks(self) -> int:
        return len(self.bounds) + 1

    @property
    def ranges(self) -> np.ndarray:
        """Id range of each chunk; chunks that share a split id have the same."""
        return np.cumsum([0, *(tie == NO_TIE for _, tie in self.bounds)])

    def position(self, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Chunk of each row."""
        starts = np.array(self.bounds, np.int64).reshape(-1, 2)
        low, at = (np.searchsorted(starts[:, 0], ids, side=s) for s in ("left", "right"))
        several = at - low > 1
        for k in np.unique(low[several]).tolist():
            rows = np.flatnonzero(several & (low == k))
            at[rows] = k + np.searchsorted(starts[k:at[rows[0]], 1], ties[rows], side="right")
        return at

    def buckets(self, items: int, per_bucket: int, least: int = 8) -> int:
        """How many hash buckets hold ``items`` at ``per_bucket`` each."""
        return max(least, -(-items // per_bucket))


def chunking(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES,
             least: int = 12) -> Chunking:
    """Measure the table and choose bounds at even quantiles of its bytes.

    Quantiles are taken over marks, one for about every 1 / ``MARKS`` of a
    chunk (rows shorter than that by chance).  An id that holds several
    quantiles has a range of its own, split by text hash.
    """
    size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()
    total = int(size[1]) + ROW_BYTES * int(size[0])
    n = max(least, -(-total // chunk_bytes))
    weight = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + ROW_BYTES
    marks = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text_col).alias("tie"),
        F.floor(weight / max(1, total // (MARKS * n)) + F.rand(42)).cast("int").alias("n"))
    marks = marks.select("id", "tie", F.explode(F.array_repeat(F.lit(0), F.col("n"))))

    def quantiles(column, parts):
        return F.percentile_approx(column, [i / parts for i in range(1, parts)], max(10_000, 20 * parts))

    hits = Counter(marks.agg(quantiles("id", n)).first()[0] or ())
    split = {x: k for x, k in hits.items() if k > 1}
    bounds = {(x, NO_TIE) for x in hits}
    if split:
        m = max(split.values()) + 1
        for x, ties in marks.where(F.col("id").isin(list(split))).groupBy("id").agg(quantiles("tie", m)).collect():
            parts = split[x] + 1
            bounds |= {(x, ties[round(j * m / parts) - 1]) for j in range(1, parts)}
        bounds |= {(x + 1, NO_TIE) for x in split if x + 1 < 1 << 63}
    return Chunking(int(size[0]), int(size[1]), tuple(sorted(bounds)))


def packed(docs: DataFrame, id_col: str, plan: Chunking, text_col: str = "text") -> DataFrame:
    """(chunk int, blob binary): all columns of the documents of a chunk; a NULL id sorts first."""
    where, width = docs.columns.index(id_col), len(docs.columns)

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = pc.fill_null(batch.column(where).cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)
            chunk = plan.position(ids, batch.column(width).to_numpy(zero_copy_only=False))
            order = np.argsort(chunk, kind="stable")
            chunk = chunk[order]
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            table = pa.Table.from_batches([batch]).select(list(range(width))).take(pa.array(order))
            names = [f"c{i}" for i in range(table.num_columns)]
            table = table.rename_columns(names)
            blobs = [to_blob(table.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[cuts[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], ["chunk", "blob"])

    return docs.select("*", F.xxhash64(text_col).alias("__tie")).mapInArrow(lean_batches(deal), "chunk int, blob binary")


def to_blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def from_blobs(blobs, names: list[str]) -> pa.Table:
    """The documents of one chunk, columns named as in the source table."""
    got = [pa.ipc.open_stream(pa.py_buffer(b.as_py() if hasattr(b, "as_py") else b)).read_all() for b in blobs]
    return pa.concat_tables(got).combine_chunks().rename_columns(names)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a NULL text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, step: int = STEP_BYTES):
    """Document ranges [a, b) of about ``step`` bytes; a longer document is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + step, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted uint64 values as 4-, 6- or 8-byte differences (first byte: the width)."""
    if not len(values):
        return b"\x08"
    d = np.diff(values, prepend=np.uint64(0))
    top = int(d[1:].max()) if len(d) > 1 else 0
    width = 4 if top < 1 << 32 else 6 if top < 1 << 48 else 8
    head = int(d[0]).to_bytes(8, "little")
    return bytes([width]) + head + d[1:].view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    width = blob[0]
    if len(blob) < 9:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    d = np.zeros((len(raw) + 1, 8), np.uint8)
    d[0] = np.frombuffer(blob, np.uint8, 8, 1)
    d[1:, :width] = raw
    return np.cumsum(d.view(np.uint64).ravel(), dtype=np.uint64)


@lru_cache(4)
def bucket_starts(buckets: int) -> np.ndarray:
    """Where each of ``buckets`` equal ranges of the 64-bit space starts."""
    return np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)


def bucket_cuts(values: np.ndarray, buckets: int) -> np.ndarray:
    """Positions where each of ``buckets`` equal ranges of the 64-bit space starts in sorted values."""
    return np.append(np.searchsorted(values, bucket_starts(buckets)), len(values))


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """The range of ``bucket_cuts`` that each value lies in."""
    return np.searchsorted(bucket_starts(buckets), values, side="right") - 1


def give_back() -> None:
    """Return freed memory to the system: workers live on, and their allocators would keep the most that any task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(run):
    """``run``, a function of one or two tables of a group, then ``give_back``."""
    def call(*tables):
        try:
            return run(*tables)
        finally:
            give_back()

    return (lambda table: call(table)) if run.__code__.co_argcount == 1 else (lambda left, right: call(left, right))


def lean_batches(run):
    """``run``, a function of a task's batches, then ``give_back``."""
    def call(batches):
        yield from run(batches)
        give_back()

    return call


def own_columns(docs: DataFrame, *taken: str) -> list[str]:
    """Columns of ``docs`` that keep their names beside the result columns ``taken``."""
    low = {t.lower() for t in taken}
    return [c for c in docs.columns if c.lower() not in low]
