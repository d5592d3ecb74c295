"""Best-fit packing with bound-certified repacking.

Pieces are dealt into groups, each group is packed by best-fit decreasing, and
a lower bound from dual feasible functions is computed for it.  A group whose
number of sequences equals its bound is certified: by itself it cannot be packed
better, and its full sequences are closed.  The others have a gap: all their
pieces but whole sequences are exchanged, with those of the unfilled sequences
of certified groups, dealt anew over fewer and larger groups and packed again, round by round until nothing is open, the total is
certified as a whole, or ``ROUNDS`` rounds are over.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.chunks import lean_batches, steps, text_buffers
from tillroll.llm.graph import cut
from tillroll.llm.tokens import Encoder

CAPACITY = 1024
END = 2
GROUP = 20_000
ROUNDS = 4


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing of ``sizes`` needs at least."""
    return histogram_bound(np.bincount(sizes, minlength=capacity + 1), capacity)


def histogram_bound(count: np.ndarray, capacity: int) -> int:
    """The same from the number of pieces of each size: the best of two families of dual feasible functions."""
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    n, total = np.append(0, np.cumsum(count)), np.append(0, np.cumsum(count * size))
    for low in range(1, capacity // 2 + 1):  # large ones whole, small ones not at all
        middle = total[capacity - low + 1] - total[low]
        large = n[capacity + 1] - n[capacity - low + 1]
        best = max(best, -(-int(middle + large * capacity) // capacity))
    for k in range(1, 21):  # rounded to multiples of 1 / k, but for exact multiples of 1 / (k + 1)
        times = (k + 1) * size
        # in units of capacity / k
        value = np.where(times % capacity == 0, times * k, (times // capacity) * (k + 1) * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * (k + 1) * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every piece and the space left in every bin."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    space: list[list[int]] = [[] for _ in range(capacity + 1)]
    left: list[int] = []
    some = 0  # bit r: a bin with r left
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        fits = some >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = space[r].pop()
            if not space[r]:
                some ^= 1 << r
        else:
            r, b = capacity, len(left)
            left.append(capacity)
        bins[i], offsets[i] = b, capacity - r
        left[b] = r = r - s
        if r:
            space[r].append(b)
            some |= 1 << r
    return bins, offsets, np.array(left, np.int64)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end: int = END, ranks: str | None = None, reference: str | None = None, with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: id, piece, start, length, ids_crc32 (and ids): the first one takes the remainder."""
    kind = docs.schema[id_col].dataType.simpleString()
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches):
        encode = Encoder.of(ranks, reference)
        for batch in (b.slice(x, y - x) for b in batches for x, y in steps(text_buffers(b.column(1))[1])):
            rows = []
            for n, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "") + tail
                total = len(ids) // 4
                start, size = 0, total % capacity or min(total, capacity)
                piece = 0
                while start < total:
                    part = ids[4 * start:4 * (start + size)]
                    rows.append((n, piece, start, size, zlib.crc32(part), part))
                    start, size, piece = start + size, capacity, piece + 1
            n, piece, start, size, crc, part = zip(*rows) if rows else ((),) * 6
            cols = [batch.column(0).take(pa.array(n, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in part], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(lean_batches(run), schema)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` from 1 to ``capacity``."""
    columns = [f for f in cut_pieces.schema if f.name not in ("sequence_id", "offset")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns) + ", sequence_id long, offset long"
    rows = cut(cut_pieces.select(*[f.name for f in columns]).withColumn("__row", F.monotonically_increasing_id()))
    hist = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    count = np.zeros(capacity + 1, np.int64)
    count[list(hist)] = list(hist.values())
    least = histogram_bound(count, capacity)

    def packer(number: int):
        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by("__row")
            sizes = table.column("length").to_numpy()
            bins, offsets, left = best_fit_decreasing(sizes, capacity)
            certified = len(left) == lower_bound(sizes, capacity)
            is_open = (left > 0)[bins] if certified else sizes < capacity
            name = (number << 56) + (table.column("__group")[0].as_py() << 28)
            out = table.drop_columns(["__group"])
            return (out.append_column("sequence_id", pa.array(bins + name)).append_column("offset", pa.array(offsets))
                    .append_column("__open", pa.array(is_open)))
        return run

    todo, done, closed = rows, [], 0
    for number in range(rounds):
        size = todo.agg(F.count(F.lit(1))).first()[0]
        n = max(1, -(-size // (group << number)))  # fewer and larger groups each round, 2^(rounds - 1) times at most
        where = F.pmod(F.xxhash64("__row", F.lit(number)), F.lit(n)).cast("long")
        packed = cut(todo.withColumn("__group", where).groupBy("__group").applyInArrow(
            packer(number), schema.replace(", sequence_id", ", `__row` long, sequence_id", 1) + ", __open boolean"))
        made = {r[0]: r[1] for r in packed.groupBy("__open").agg(F.countDistinct("sequence_id")).collect()}
        closed += made.get(False, 0)
        still = made.get(True, 0)
        if not still or closed + still == least or number == rounds - 1 or n == 1:
            done.append(packed)
            break
        done.append(packed.where("not __open"))
        todo = packed.where("__open").drop("sequence_id", "offset", "__open")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("__row", "__open")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end: int = END, ranks: str | None = None, reference: str | None = None,
                   with_ids: bool = False) -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as it can.

    Returns one row per piece: the id column, piece, start, length, ids_crc32
    (and ids with ``with_ids``), sequence_id, offset.  Only documents longer
    than ``capacity`` (their end token counts) are cut; the first piece takes
    what is over.  A NULL or empty text is one end token.  NULL ids and
    repeated rows are packed like any other row; other columns of ``docs`` are
    not used.  An empty table gives an empty table.
    """
    cut_pieces = pieces(docs, id_col, text_col, capacity, end, ranks, reference, with_ids)
    return pack(cut_pieces, capacity).withColumnRenamed("id", id_col)
