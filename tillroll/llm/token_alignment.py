"""Cross-tokenizer alignment: the tokens of two public vocabularies over the same bytes, by lockstep merging.

Tokenizer A is a byte-level BPE, B a sentencepiece BPE with byte fallback; A
reads a blank and the text, B adds that blank itself.  Both give byte ends of
their tokens.  One NumPy state holds an A and a B pointer of every document of
a batch; each step compares the two ends of all of them, advances the pointer
of the smaller one (both if they agree, which is a cut: the tokens since the
last cut are a group and link with each other) and drops the documents that
are finished.  A document of over ``LANE`` tokens walks in several places at
once, each beginning at an end that both tokenizers share, so the number of
steps does not grow with the longest text.

Texts are encoded by the distinct words of ``SPAN_BYTES`` of them, and their
ids are gathered from those: nothing is remembered beyond a span.

Every document keeps its distinct linked id pairs.  How many documents of the
whole corpus hold a pair is counted in Spark from per-chunk counts and sent
back to the chunks that hold the pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.chunks import from_blobs, give_back, lean_batches, own_columns, steps, text_buffers, to_blob
from tillroll.llm.graph import cut
from tillroll.llm.tokens import SPLIT, Encoder, vocabulary

SPAN_BYTES = 8 << 20   # text whose distinct words are encoded together
STEP_BYTES = 1 << 18   # text of one batch in lockstep
WORDS = 16_384         # words encoded at once
LINE = 32              # words in a text read at once
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())  # there are none above
LANE = 256             # tokens after which a document walks in a further place
PAIRS = 1 << 18        # links that are expanded at once
CHUNK_PAIRS = 1 << 19  # (document, pair) entries of a chunk
TAKEN = ("n_a", "n_b", "n_groups", "n_links", "groups", "link_a", "link_b", "link_n")
_made: dict = {}


class _Pair:
    """Both tokenizers of a worker with the bytes of their tokens."""

    def __init__(self, a_path: str, reference: str, b_path: str):
        import base64

        import sentencepiece

        self.a = Encoder.of(a_path, reference)
        with open(a_path, "rb") as f:
            table = {int(i): base64.b64decode(x) for x, i in map(bytes.split, f)}
        self.a_bytes = [table.get(i, b"") for i in range(max(table) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(names)]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # decimal ids followed by what separates them: , in a group, | after its A ids, ; after the group
        self.text = [f"{i}{c}" for n, c in ((len(self.a_bytes), ","), (len(self.a_bytes), "|"),
                                            (len(self.b_bytes), ","), (len(self.b_bytes), ";")) for i in range(n)]

    @classmethod
    def of(cls, a_path: str | None, reference: str | None, b_path: str | None) -> "_Pair":
        key = a_path or vocabulary("byte_bpe_50k.tiktoken"), b_path or vocabulary("piece_bpe_32k.model")
        if key not in _made:
            _made[key] = cls(key[0], reference or vocabulary("byte_bpe_50k.json"), key[1])
        return _made[key]

    def _encode(self, words: pa.Array, plain: int):
        """(A ids, B ids, whether both give back a blank and the word) of words; ids as (flat, where each word's begin and the end).

        The first ``plain`` words are read many in a text.
        """
        ids, counts, good = ([], []), ([], []), []
        cuts = [*range(0, plain, WORDS), *range(plain, len(words), WORDS), len(words)]
        for s, e in zip(cuts, cuts[1:]):
            some = words.slice(s, e - s).to_pylist()
            raw = "".join([" " + w for w in some]).encode()
            ends = np.cumsum(pc.binary_length(words.slice(s, e - s)).to_numpy().astype(np.int64) + 1)
            fine = np.ones(e - s, bool)
            lines = [" ".join(some[i:i + LINE]) for i in range(0, len(some), LINE)] if s < plain else []
            for k, (read, size, text) in enumerate(((self._a, self.a_size, self.a_bytes), (self._bs, self.b_size, self.b_bytes))):
                got = np.concatenate(read(lines)) if lines else np.zeros(0, np.int32)
                at = np.cumsum(size[got])
                n = np.searchsorted(at, ends) + 1
                if lines and n[-1] == len(got) and (at[n - 1] == ends).all() and b"".join(map(text.__getitem__, got.tolist())) == raw:
                    n = np.diff(n, prepend=0)
                else:
                    each = read(some)
                    got, n = np.concatenate(each), np.array([len(x) for x in each])
                    fine &= [b"".join(map(text.__getitem__, x.tolist())) == f" {w}".encode() for x, w in zip(each, some)]
                ids[k].append(got)
                counts[k].append(n)
            good.append(fine)
        a, b = ((np.concatenate([np.zeros(0, np.int32), *x]), np.append(0, np.cumsum(np.concatenate([np.zeros(0, int), *n]))))
                for x, n in zip(ids, counts))
        return a, b, np.concatenate([np.zeros(0, bool), *good])

    def _a(self, texts: list[str]) -> list[np.ndarray]:
        """A ids of a blank and each text."""
        return [np.frombuffer(self.a._ids(" " + t), "<u4").astype(np.int32) for t in texts]

    def _bs(self, texts: list[str]) -> list[np.ndarray]:
        """B ids of each text."""
        return [np.array(x, np.int32) for x in self.b.encode(texts, num_threads=1)]

    def read(self, texts, check: bool = True) -> "_Span":
        """The texts of an Arrow column, by the ids of their distinct words; with ``check`` those not given back have none.

        A text is cut at single blanks between two visible characters: A's pre-tokenisation begins a piece there,
        and no piece of B but those of blanks alone holds a blank behind its first character.  One with a U+2581 is not cut.
        """
        texts = pc.fill_null(texts.cast(pa.string()), "")
        lists = pc.split_pattern(texts, " ")
        code = lists.flatten().dictionary_encode()
        start = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        start, stop = start[:-1].copy(), start[1:].copy()
        words, code = code.dictionary, code.indices.to_numpy().astype(np.int64)
        odd_rows = np.unique(np.searchsorted(stop, np.flatnonzero(~_plain(words)[code]), side="right"))
        more: list[str] = []
        for i in odd_rows.tolist():
            t = texts[i].as_py()
            start[i] = len(code) + len(more)
            more += [t] if "▁" in t else SPLIT.split(t) if t else []
            stop[i] = len(code) + len(more)
        if more:
            own = pa.array(more, pa.string()).dictionary_encode()
            code = np.concatenate([code, own.indices.to_numpy().astype(np.int64) + len(words)])
            words = pa.concat_arrays([words, own.dictionary])
        used = np.zeros(len(words), bool)
        used[code[_ranges(start, stop - start)]] = True
        plain = _plain(words)
        order = np.concatenate([np.flatnonzero(used & plain), np.flatnonzero(used & ~plain)])
        place = np.zeros(len(words), np.int64)
        place[order] = np.arange(len(order))
        a, b, good = self._encode(words.take(pa.array(order)), int((used & plain).sum()))
        span = _Span(place[code], start, stop, a, b)
        if check and not good.all():
            for i in np.flatnonzero(np.array([not good[span.code[s:e]].all() for s, e in zip(start, stop)], bool)).tolist():
                (x, _), (y, _), raw = *span.ids(i, i + 1), b" " + texts[i].as_py().encode()
                if any(b"".join(map(t.__getitem__, z.tolist())) != raw for t, z in ((self.a_bytes, x), (self.b_bytes, y))):
                    stop[i] = start[i]
        return span

    def _b(self, texts: list[str]) -> list[np.ndarray]:
        """B ids of texts, put together from words."""
        ids, sizes = self.read(pa.array(texts, pa.string()), check=False).ids(0, len(texts))[1]
        return np.split(ids, np.cumsum(sizes)[:-1])


def _plain(words: pa.Array) -> np.ndarray:
    """Which words have a character, no white space at their ends and no U+2581."""
    ends = pc.equal(pc.utf8_trim(words, BLANKS), words)
    holds = pc.and_(pc.not_equal(words, ""), pc.invert(pc.match_substring(words, "▁")))
    return pc.and_(ends, holds).to_numpy(zero_copy_only=False).astype(bool)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of ranges, one range after the other."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class _Span:
    """Texts as words (``code`` from ``start`` to ``stop``) and the ids of each word; a text without words has no tokens."""

    def __init__(self, code, start, stop, a, b):
        self.code, self.start, self.stop, self.both = code, start, stop, (a, b)

    def ids(self, s: int, e: int):
        """For A and for B: (ids, how many each text has) of texts s to e."""
        n = self.stop[s:e] - self.start[s:e]
        words, ends = self.code[_ranges(self.start[s:e], n)], np.cumsum(n)
        out = []
        for flat, at in self.both:
            size = at[words + 1] - at[words]
            total = np.append(0, np.cumsum(size))
            out.append((flat[_ranges(at[words], size)].astype(np.int64), total[ends] - total[ends - n]))
        return out


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_at: np.ndarray, b_at: np.ndarray, a_stop: np.ndarray):
    """(a0, a1, b0, b1) of all groups, ordered: tokens a0 to a1 of A and b0 to b1 of B end together.

    ``a_at`` and ``b_at`` are where the walks begin (behind a common end) and
    ``a_stop`` the A token before which each stops (behind a common end too).
    """
    a, b, stop = a_at.copy(), b_at.copy(), a_stop
    a_from, b_from = a.copy(), b.copy()
    links = []
    while len(a):
        x, y = a_ends[a], b_ends[b]
        a += x <= y
        b += y <= x
        cuts = np.flatnonzero(x == y)
        if len(cuts):
            to_a, to_b = a[cuts], b[cuts]
            links.append((a_from[cuts], to_a, b_from[cuts], to_b))
            a_from[cuts], b_from[cuts] = to_a, to_b
            going = a < stop
            if not going.all():
                a, b, stop, a_from, b_from = (z[going] for z in (a, b, stop, a_from, b_from))
    if not links:
        return (np.zeros(0, np.int64),) * 4
    a0, a1, b0, b1 = (np.concatenate(z) for z in zip(*links))
    order = np.argsort(a0)
    return a0[order], a1[order], b0[order], b1[order]


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, lane: int = LANE):
    """Groups of documents whose tokens follow each other; ``a_first`` and ``b_first`` are their first tokens (and the end)."""
    more = np.arange(lane, len(a_ends), lane)  # an A token here starts a further walk if B ends with the token before it
    at = np.searchsorted(b_ends, a_ends[more - 1])
    shared = b_ends[np.minimum(at, len(b_ends) - 1)] == a_ends[more - 1] if len(b_ends) else np.zeros(len(more), bool)
    a_at = np.concatenate([a_first[:-1], more[shared]])
    b_at = np.concatenate([b_first[:-1], at[shared] + 1])
    a_at, where = np.unique(a_at, return_index=True)
    return lockstep(a_ends, b_ends, a_at, b_at[where], np.append(a_at[1:], len(a_ends)))


def _counted(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of ``n``."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n[order], first) if len(key) else n


def _linked(doc: np.ndarray, a_ids, b_ids, a0, a1, b0, b1, pairs: int = PAIRS):
    """(document, A id, B id, links) of all distinct id pairs that share a group of a document."""
    group = np.arange(len(doc))
    # equal ids of a group first become one with their number, so a long group costs its distinct ids
    ka, ca = _counted(np.repeat(group, a1 - a0) << 20 | a_ids, np.ones(len(a_ids), np.int64))
    kb, cb = _counted(np.repeat(group, b1 - b0) << 20 | b_ids, np.ones(len(b_ids), np.int64))
    ga, gb = ka >> 20, kb >> 20
    first = np.searchsorted(gb, group)
    width = np.diff(np.append(first, len(gb)))[ga]  # B ids that each A id of a group meets
    ends = np.cumsum(width)
    keys, sums, s = [], [], 0
    while s < len(ka):
        e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + pairs, side="right")))
        w = width[s:e]
        left = np.repeat(np.arange(s, e), w)
        right = np.arange(len(left)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(first[ga[s:e]], w)
        key = doc[ga[left]] << 40 | (ka[left] & 0xFFFFF) << 20 | kb[right] & 0xFFFFF
        k, n = _counted(key, ca[left] * cb[right])
        keys.append(k)
        sums.append(n)
        s = e
    if not keys:
        return (np.zeros(0, np.int64),) * 4
    key, n = _counted(np.concatenate(keys), np.concatenate(sums)) if len(keys) > 1 else (keys[0], sums[0])
    return key >> 40, key >> 20 & 0xFFFFF, key & 0xFFFFF, n


def _written(pair: _Pair, doc_a, doc_b, a_ids, b_ids, a0, a1, b0, b1, docs: int) -> list[str]:
    """Each document's groups as text: ``a1,a2|b1;a3|b2,b3``."""
    na, nb = len(pair.a_bytes), len(pair.b_bytes)
    a_no, b_no = a_ids.copy(), b_ids + 2 * na
    a_no[a1 - 1] += na
    b_no[b1 - 1] += nb
    both = np.empty(len(a_no) + len(b_no), np.int64)  # a group's A tokens come before its B tokens
    both[np.arange(len(a_no)) + np.repeat(b0, a1 - a0)] = a_no
    both[np.arange(len(b_no)) + np.repeat(a1, b1 - b0)] = b_no
    bounds = (np.searchsorted(doc_a, np.arange(docs + 1)) + np.searchsorted(doc_b, np.arange(docs + 1))).tolist()
    both, text = both.tolist(), pair.text
    return ["".join([text[i] for i in both[s:e]])[:-1] for s, e in zip(bounds, bounds[1:])]


def align(docs: DataFrame, text_col: str = "text", a_path: str | None = None, reference: str | None = None,
          b_path: str | None = None, lane: int = LANE, pairs: int = PAIRS) -> DataFrame:
    """``docs`` without the text, with its alignment under two tokenizers.

    Adds n_a, n_b (tokens), n_groups, n_links (long), groups (text: ``a1,a2|b1;a3|b2,b3``, decimal ids of A and B by
    group) and link_a, link_b, link_n (arrays: the distinct id pairs linked and
    how many links each has).  Columns of these names are replaced.  A NULL or
    empty text, or one that a tokenizer doesn't give back byte by byte, has no
    tokens: zeros, an empty text and empty arrays.  Repeated rows are aligned
    each; an empty table gives an empty table.  ``pairs`` bounds the links that a
    task expands at once.  The paths are A's ranks, the
    same vocabulary as a ``tokenizers`` file, and B's model.
    """
    own = [c for c in own_columns(docs, *TAKEN) if c != text_col]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own]
                       + ["n_a long", "n_b long", "n_groups long", "n_links long", "groups string", "link_a array<int>",
                          "link_b array<int>", "link_n array<long>"])

    def lists(bounds, values):
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))

    def spans(pair, batches):
        for batch in batches:
            _, offsets = text_buffers(batch.column(len(own)))
            for s, e in steps(offsets, SPAN_BYTES):
                part = batch.slice(s, e - s)
                yield part, pair.read(part.column(len(own))), offsets[s:e + 1] - offsets[s]

    def run(batches):
        pair = _Pair.of(a_path, reference, b_path)
        for part, span, offsets in spans(pair, batches):
            for s, e in steps(offsets, STEP_BYTES):
                (a_ids, size_a), (b_ids, size_b) = span.ids(s, e)
                some = size_a > 0
                first_a, first_b = (np.append(0, np.cumsum(z[some])) for z in (size_a, size_b))
                a0, a1, b0, b1 = groups_of(np.cumsum(pair.a_size[a_ids]), np.cumsum(pair.b_size[b_ids]), first_a, first_b,
                                           lane)
                doc_a, doc_b = (np.repeat(np.arange(e - s), z) for z in (size_a, size_b))
                doc = doc_a[a0]
                n_links = np.zeros(e - s, np.int64)
                np.add.at(n_links, doc, (a1 - a0) * (b1 - b0))
                linked, a, b, n = _linked(doc, a_ids, b_ids, a0, a1, b0, b1, pairs)
                bounds = np.searchsorted(linked, np.arange(e - s + 1))
                yield pa.RecordBatch.from_arrays(
                    [*part.slice(s, e - s).columns[:len(own)], pa.array(size_a), pa.array(size_b),
                     pa.array(np.bincount(doc, minlength=e - s).astype(np.int64)), pa.array(n_links),
                     pa.array(_written(pair, doc_a, doc_b, a_ids, b_ids, a0, a1, b0, b1, e - s), pa.string()),
                     lists(bounds, a.astype(np.int32)), lists(bounds, b.astype(np.int32)), lists(bounds, n)],
                    [*own, *TAKEN])
                give_back()

    return docs.select(*own, F.col(text_col).cast("string").alias("__text")).mapInArrow(lean_batches(run), schema)


def link_counts(aligned: DataFrame, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """``aligned`` (see ``align``) with n_best and count_sum in place of its link arrays.

    An id pair's count is the number of rows that hold it linked.  count_sum
    adds it up over a row's links, n_best is how many of them have the
    highest count of their A id (ties count).  Rows without links get zeros.

    Rows are packed into chunks of about ``chunk_pairs`` pairs (a row's pairs
    stay together), a chunk sends each of its distinct pairs once and gets the
    pair's count back; the window over one A id holds at most as many pairs as
    B has pieces.
    """
    own = [c for c in own_columns(aligned, "n_best", "count_sum") if c not in ("link_a", "link_b", "link_n")]
    width = len(own)
    fields = [f"`{c}` {aligned.schema[c].dataType.simpleString()}" for c in own]

    def pack(batches):
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

        def emit():
            link_a, link_b = (np.concatenate([b.column(width + j).flatten().to_numpy() for b in held]).astype(np.int64)
                              for j in (0, 1))
            pairs, at, n = np.unique(link_a << 20 | link_b, return_inverse=True, return_counts=True)
            table = pa.Table.from_batches(held)
            rows = table.select(list(range(width))).append_column("size", pa.array(np.concatenate(
                [np.diff(b.column(width).offsets.to_numpy()) for b in held]).astype(np.int32)))
            links = pa.table({"at": pa.array(at.astype(np.int32)), "n": pa.concat_arrays(
                [b.column(width + 2).flatten() for b in held])})
            one = pa.array([0, len(pairs)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.ListArray.from_arrays(one, pa.array((pairs >> 20).astype(np.int32))),
                 pa.ListArray.from_arrays(one, pa.array((pairs & 0xFFFFF).astype(np.int32))),
                 pa.ListArray.from_arrays(one, pa.array(n)),
                 pa.array([to_blob(rows)], pa.binary()), pa.array([to_blob(links)], pa.binary())],
                ["chunk", "a", "b", "n", "rows", "links"])

        for batch in batches:
            ends = batch.column(width).offsets.to_numpy()
            for s, e in steps(ends.astype(np.int64) - int(ends[0]), chunk_pairs):
                part = batch.slice(s, e - s)
                if held and size + int(ends[e] - ends[s]) > chunk_pairs:
                    yield emit()
                    chunk, held, size = chunk + 1, [], 0
                held.append(part)
                size += int(ends[e] - ends[s])
        if held:
            yield emit()

    packed = cut(aligned.select(*own, "link_a", "link_b", "link_n").mapInArrow(
        lean_batches(pack), "chunk long, a array<int>, b array<int>, n array<long>, rows binary, links binary"))
    sent = packed.select("chunk", F.explode(F.arrays_zip("a", "b", "n")).alias("x")).select("chunk", "x.*")
    total = sent.groupBy("a", "b").agg(F.sum("n").alias("count"))
    total = total.withColumn("best", (F.col("count") == F.max("count").over(Window.partitionBy("a"))).cast("long"))
    back = sent.drop("n").join(total, ["a", "b"]).groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("a", "b", "count", "best"))).alias("known"))  # a chunk's distinct pairs
    back = back.select("chunk", F.col("known.count").alias("count"), F.col("known.best").alias("best"))

    def apply(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, links = (from_blobs([batch.column(j)[i]], names) for j, names in ((0, [*own, "size"]), (1, ["at", "n"])))
                count, best = (batch.column(j)[i].values.to_numpy() if batch.column(j)[i].is_valid
                               else np.zeros(0, np.int64) for j in (2, 3))
                at, n = links.column("at").to_numpy(), links.column("n").to_numpy()
                ends = np.cumsum(rows.column("size").to_numpy())
                sums = [np.append(0, np.cumsum(x))[np.append(0, ends)] for x in (best[at] * n, count[at] * n)]
                out = rows.drop_columns(["size"]).append_column("n_best", pa.array(np.diff(sums[0]))).append_column(
                    "count_sum", pa.array(np.diff(sums[1])))
                yield from out.to_batches()

    return packed.select("chunk", "rows", "links").join(back, "chunk", "left").select(
        "rows", "links", "count", "best").mapInArrow(lean_batches(apply), ", ".join([*fields, "n_best long", "count_sum long"]))
