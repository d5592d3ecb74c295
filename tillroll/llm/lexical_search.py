"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton of all item terms.

There is no index of the documents.  The terms of the items (the queries) make
one automaton whose keys carry a guard byte on either side; a text's bytes are
mapped so that every byte outside a term is the guard, hence a key matches
whole terms only, and all terms of all items are found in one scan.  What a
document keeps of it are the terms it holds and their tf; document frequencies,
the number of documents and their length are summed over these rows.  A term's
output maps to the items that hold it, so a document's scores are added up term
by term; every task keeps its own best documents per item, which meet in Spark.

The items are the stated query set: they are dealt into blocks of about
``BLOCK_BYTES`` of distinct terms (an item's terms stay together), and each
block, which bounds what is broadcast, scans all documents once.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tillroll.llm import hashing
from tillroll.llm.chunks import steps, text_buffers
from tillroll.llm.graph import cut

BLOCK_BYTES = 1 << 20  # of distinct (item, term) pairs in one automaton
TERM_BYTES = 16        # what a term weighs besides its text
CELLS = 1 << 21        # (item, document) scores that a task holds at once
SALTS = 64             # groups in which the best documents of one item meet first
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# a byte of a term: itself, A-Z in lower case; any other: the guard 0
_IN_TERM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _IN_TERM[_a:_b + 1] = True
GUARDED = np.where(_IN_TERM, hashing.LOWER, 0).astype(np.uint8)
GUARD = "\0"


def automaton(terms: list[str]):
    """Aho-Corasick automaton of ``terms`` (their UTF-8 bytes as Latin-1 characters) between guards; it gives their numbers."""
    import ahocorasick

    a = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, t in enumerate(terms):
        a.add_word(GUARD + t.encode().decode("latin-1") + GUARD, i)
    a.make_automaton()
    return a


def guarded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each document): guards between, before and after the documents' mapped bytes."""
    n = len(offsets) - 1
    out = np.zeros(len(data) + n + 1, np.uint8)
    starts = offsets[:-1] + np.arange(1, n + 1)
    inside = np.ones(len(out), bool)
    inside[starts - 1] = False
    inside[-1] = False
    out[inside] = GUARDED[data]
    return out, starts


def term_counts(data: np.ndarray, offsets: np.ndarray, a, terms: int):
    """(terms of each document, document, term, tf): its length in terms and the automaton's terms it holds."""
    text, starts = guarded(data, offsets)
    first = np.flatnonzero((text[1:] != 0) & (text[:-1] == 0)) + 1
    length = np.diff(np.append(np.searchsorted(first, starts), len(first)))
    keys, counts = [], []
    if terms:
        found = a.iter(text.tobytes().decode("latin-1"))
        while True:
            part = np.fromiter(chain.from_iterable(islice(found, 1 << 20)), np.int64).reshape(-1, 2)
            if not len(part):
                break
            doc = np.searchsorted(starts, part[:, 0] - 1, side="right") - 1
            k, n = np.unique(doc * terms + part[:, 1], return_counts=True)
            keys.append(k)
            counts.append(n)
    if not keys:
        return length, *(np.zeros(0, np.int64),) * 3
    key, tf = keys[0], counts[0]
    if len(keys) > 1:
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        tf = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)
    return length, key // terms, key % terms, tf


def scan(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n (its terms), terms and tfs (arrays) of every document with a term."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(automaton(terms) if terms else None)  # bounded by the block
    size = len(terms)

    def run(batches):
        a = shared.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for s, e in steps(offsets):
                n, doc, term, tf = term_counts(data[offsets[s]:offsets[e]], offsets[s:e + 1] - offsets[s], a, size)
                cuts = pa.array(np.searchsorted(doc, np.arange(e - s + 1)).astype(np.int32))
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s, e - s), pa.array(n),
                     pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int32)))], ["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, f"id {kind}, n long, terms array<int>, tfs array<int>")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def _best(scores: np.ndarray, place: np.ndarray, k: int, least: int) -> np.ndarray:
    """Positions of the k largest scores of at least ``least``, ties by ``place``."""
    some = np.flatnonzero(scores >= least)
    if len(some) > k:
        last = np.partition(scores[some], len(some) - k)[len(some) - k]
        some = some[scores[some] >= last]
    return some[np.lexsort((place[some], -scores[some]))][:k]


def _rank_block(hits: DataFrame, held: list[list[tuple[int, int]]], items: int, k: int, documents: int, total: int,
                weight: np.ndarray) -> DataFrame:
    """item (its number), score, id: the k best documents of each item in every task; ``held``: a term's (item, repeats)."""
    kind, id_type = hits.schema["id"].dataType.simpleString(), to_arrow_type(hits.schema["id"].dataType)
    rows = [np.array([i for i, _ in h], np.int64) for h in held]
    times = [np.array([m for _, m in h], np.int64) for h in held]
    shared = hits.sparkSession.sparkContext.broadcast((rows, times, weight))  # bounded by the block
    width = max(1, CELLS // max(1, items))

    def run(batches):
        rows, times, weight = shared.value
        best = [[] for _ in range(items)]  # (-score, id is NULL, id)
        for whole in batches:
            for s in range(0, whole.num_rows, width):
                batch = whole.slice(s, width)
                n = batch.column(1).to_numpy()
                lists = batch.column(2)
                term = lists.flatten().to_numpy()
                tf = batch.column(3).flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(len(n)), pc.list_value_length(lists).to_numpy())
                m = 100 - 75 + (75 * n * documents) // total
                part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                scores = np.zeros((items, len(n)), np.int64)
                order = np.argsort(term, kind="stable")
                cuts = np.flatnonzero(np.diff(term[order], prepend=-1))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
                    at = order[a:b]
                    t = term[at[0]]
                    if weight[t]:
                        scores[np.ix_(rows[t], doc[at])] += times[t][:, None] * part[at]
                ids = batch.column(0)
                place = np.empty(len(n), np.int64)
                place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(n))
                top = scores.max(axis=1, initial=0)
                for i in np.flatnonzero(top > 0).tolist():
                    least = -best[i][-1][0] if len(best[i]) == k else 1
                    if top[i] < least:
                        continue
                    at = _best(scores[i], place, k, least)
                    new = zip((-scores[i][at]).tolist(), ids.take(pa.array(at)).to_pylist())
                    best[i] = sorted([*best[i], *((x, y is None, 0 if y is None else y) for x, y in new)])[:k]
        out = [(i, -x, None if gone else y) for i, found in enumerate(best) for x, gone, y in found]
        item, score, ids = zip(*out) if out else ((),) * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(ids, id_type)], ["item", "score", "id"])

    return hits.mapInArrow(run, f"item int, score long, id {kind}")


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, term, times: the distinct terms of every item and how often it repeats them."""
    lower = F.translate(F.col(text_col).cast("string"), _UPPER, _UPPER.lower())
    return (items.select(F.col(item_col).alias("item"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
            .groupBy("item", "term").agg(F.count(F.lit(1)).alias("times")))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k documents of the highest score above 0 for each item: item, rank (from 1), id, score.

    Equal scores go by ascending id, a NULL id last; rows that share an id are
    ranked each.  Item rows that share an id (NULL is one) are one item with
    the terms of all of them.  A NULL or empty text has no term; an item without a term, or whose
    terms no document holds, has no rows.  Other columns of either table are
    not used.  With fewer documents above 0 all of them are returned; empty tables give an
    empty table.
    """
    spark = docs.sparkSession
    pairs = cut(item_terms(items, item_col, item_text_col))
    weight = pairs.agg(F.sum(F.octet_length("term") + TERM_BYTES)).first()[0]
    blocks = max(1, -(-int(weight or 0) // block_bytes))
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    item_kind, id_kind = items.schema[item_col].dataType, docs.schema[id_col].dataType
    found = []
    for b in range(blocks):
        block = pairs.where(F.col("block") == b).orderBy("item", "term").collect()  # about block_bytes
        numbers: dict = {}
        held: dict = defaultdict(list)
        for r in block:
            held[r["term"]].append((numbers.setdefault(r["item"], len(numbers)), r["times"]))
        if not numbers:
            continue
        terms = list(held)
        hits = cut(scan(docs, terms, id_col, text_col))
        documents, total = hits.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            break  # no document has a term
        df = np.zeros(len(terms), np.int64)
        for r in hits.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row per term
            df[r["term"]] = r["count"]
        ranked = _rank_block(hits, [held[t] for t in terms], len(numbers), k, documents, total, weights(df, documents))
        names = spark.createDataFrame([(i, x) for x, i in numbers.items()], f"item int, name {item_kind.simpleString()}")
        order = [F.desc("score"), F.asc_nulls_last("id")]
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
        for parts in (["item", salt], ["item"]):
            rank = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
            ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= k)
        found.append(ranked.join(F.broadcast(names), "item").select(
            F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    if not found:
        return spark.createDataFrame(
            [], f"`{item_col}` {item_kind.simpleString()}, rank int, `{id_col}` {id_kind.simpleString()}, score long")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
