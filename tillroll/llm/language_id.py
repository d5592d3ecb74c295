"""Language ID: segmentation-marginalised unigrams over a fixed public vocabulary.

Every language has a probability per vocabulary piece.  A word's probability
is the sum over all its segmentations into pieces, by the forward algorithm;
a text's is the product over its words.  Piece probabilities are learned by
expectation-maximisation (expected piece counts over all segmentations) from
the word counts of a bounded sample: about ``ROWS`` documents of each language (all
of a rarer one), chosen by a hash at the rate ``ROWS`` / its documents.  Scoring reads
every word of every text; a worker remembers the probabilities of at most ``KEPT`` words.

A word is a run of letters, lower-cased, of any length: the forward algorithm
keeps the sums of as many last positions as the longest piece has letters and
scales them as it goes.  (Only the sample's counts take runs of over ``TRAINED``
letters in parts of that length.)
"""

from __future__ import annotations

import re
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing
from tillroll.llm.chunks import lean_batches, steps, text_buffers

ROWS = 1500
TRAINED = 64
STEPS = 4
BACKGROUND = 200.0  # weight of the pooled piece probabilities in those of a language
KEPT = 150_000
SCALED = 8  # positions between two scalings
BLOCK = 8192  # words of one lattice
NONE = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    found = _LETTERS.findall(text.lower())
    if not all(map(str.isalpha, found)):  # numerals that are no decimal digits, as in superscripts and fractions
        found = [w for part in found for w in "".join(c if c.isalpha() else " " for c in part).split()]
    return found


def _parts(word: str) -> list[str]:
    return [word[i:i + TRAINED] for i in range(0, len(word), TRAINED)]


def vocabulary(path: str) -> tuple[np.ndarray, int]:
    """Sorted hashes of the vocabulary's letter pieces ("_" marks a word's start) and the length of the longest."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    pieces = {p.replace("▁", "_") for p in pieces}
    pieces = sorted(p for p in pieces if p.replace("_", "", 1).isalpha() and "_" not in p[1:])
    if not pieces:
        return np.zeros(0, np.uint64), 1
    return np.unique(np.concatenate([_codes([p])[2] for p in pieces])), max(map(len, pieces))


def _codes(words: list[str], marked: bool = False):
    """(lengths, starts, whole hashes, prefix sums) of words as code points."""
    text = "".join("_" + w for w in words) if marked else "".join(words)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + marked for w in words], np.int64)
    start = np.cumsum(size) - size
    s = hashing.prefix(hashing.mix(points + np.uint64(1)))
    return size, start, hashing.mix(hashing.spans(s, start, start + size)), s


class _Lattice:
    """All vocabulary pieces inside some words: for each end position and piece length, a piece number per word."""

    def __init__(self, words: list[str], vocab: np.ndarray, longest: int):
        self.size, start, _, self._prefix = _codes(words, marked=True)
        self.vocab, self.longest, self.unknown = vocab, longest, len(vocab)
        order = np.argsort(-self.size, kind="stable")  # longest first: the words that reach a position are a prefix
        self.order, self.sizes = order, self.size[order]
        self._start = start[order]
        self.letters = int(self.sizes[0]) if len(words) else 0

    def at(self, end: int):
        """(words that reach ``end``, (length, words, piece) of the pieces that end there)."""
        n = int(np.searchsorted(-self.sizes, -end, side="right"))
        found = []
        for length in range(1, min(end, self.longest) + 1):
            at = self._start[:n] + end
            h = hashing.mix(hashing.spans(self._prefix, at - length, at))
            piece = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
            hit = np.flatnonzero(self.vocab[piece] == h)
            if length == 1:  # a letter without a piece is the unknown piece
                piece = np.where(self.vocab[piece] == h, piece, self.unknown)
                hit = np.arange(n)
            if len(hit):
                found.append((length, hit, piece[hit]))
        return n, found

    def log_totals(self, p: np.ndarray) -> np.ndarray:
        """log of the forward sum of every word in every language; keeps ``longest`` positions and their scale."""
        langs = p.shape[1]
        ring = np.zeros((self.longest + 1, len(self.order), langs))
        ring[0] = 1
        scale = np.zeros((len(self.order), langs))
        out = np.empty((len(self.order), langs))
        for end in range(1, self.letters + 1):
            n, found = self.at(end)
            row = ring[end % (self.longest + 1)]
            row[:n] = 0
            for length, hit, piece in found:
                row[hit] += ring[(end - length) % (self.longest + 1), hit] * p[piece]
            if end % SCALED == 0:
                top = np.maximum(ring[:, :n].max(axis=0), 1e-300)
                ring[:, :n] /= top
                scale[:n] += np.log(top)
            done = slice(int(np.searchsorted(-self.sizes, -end, side="left")), n)  # the words that end here
            out[self.order[done]] = np.log(np.maximum(row[done], 1e-300)) + scale[done]
        return out

    @cached_property
    def steps(self):
        return [self.at(end) for end in range(1, self.letters + 1)]

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Forward sums: (position, word, language), for words whose sums don't underflow."""
        a = np.zeros((len(self.steps) + 1, len(self.order), p.shape[1]))
        a[0] = 1
        for end, (_, found) in enumerate(self.steps, 1):
            for length, hit, piece in found:
                a[end, hit] += a[end - length, hit] * p[piece]
        return a

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected piece counts over all segmentations, words weighted by language."""
        a = self.forward(p)
        weight = weight[self.order] / np.maximum(a[self.sizes, np.arange(len(self.order))], 1e-300)
        b = np.zeros_like(a)
        b[self.sizes, np.arange(len(self.order))] = 1
        counts = np.zeros_like(p)
        for end in range(len(self.steps), 0, -1):
            for length, hit, piece in self.steps[end - 1][1]:
                through = b[end, hit] * p[piece]
                b[end - length, hit] += through
                through = through * a[end - length, hit] * weight[hit]
                for c in range(p.shape[1]):
                    counts[:, c] += np.bincount(piece, weights=through[:, c], minlength=len(p))
        return counts


def word_scores(words: list[str], model: dict) -> np.ndarray:
    """log probability of each word in each language."""
    out = np.zeros((len(words), len(model["langs"])))
    for k in range(0, len(words), BLOCK):
        out[k:k + BLOCK] = _Lattice(words[k:k + BLOCK], model["vocab"], model["longest"]).log_totals(model["p"])
    return out


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          path: str | None = None, rows: int = ROWS) -> dict:
    """Learn the piece probabilities of every language of the rows where ``learn`` holds."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    named = docs.where(learn & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    per_lang = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(per_lang, key=lambda x: x.encode())
    vocab, longest = vocabulary(path)
    model = {"langs": langs, "vocab": vocab, "longest": longest}
    if not langs:
        return model | {"p": np.ones((len(model["vocab"]) + 1, 0))}
    rate = F.create_map(*[F.lit(x) for k, n in per_lang.items() for x in (k, rows / n)])
    u = F.shiftrightunsigned(F.xxhash64("id", "text"), 11) / float(1 << 53)
    sample = named.where(u < F.element_at(rate, F.col("lang"))).select("lang", "text")

    def count(batches):
        for batch in batches:
            seen: dict = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in (part for word in words_of(text or "") for part in _parts(word)):
                    seen[lang, w] = seen.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

    counted = sample.mapInArrow(lean_batches(count), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return _learn(counted.toArrow(), model)  # the distinct words of the bounded sample


def _learn(counts, model: dict) -> dict:
    langs, vocab = model["langs"], model["vocab"]
    # sorted by length: a block has as many positions as its longest word
    words = sorted(pc.unique(counts.column("word")).to_pylist(), key=lambda w: (len(w), w))
    weight = np.zeros((len(words), len(langs)))
    place = [pc.index_in(counts.column(c), pa.array(x, pa.string())).to_numpy() for c, x in (("word", words), ("lang", langs))]
    np.add.at(weight, tuple(place), counts.column("n").to_numpy())
    p = np.full((len(vocab) + 1, len(langs)), 1.0 / (len(vocab) + 1))
    for _ in range(STEPS if words else 0):
        n = sum(_Lattice(words[k:k + BLOCK], vocab, model["longest"]).expected(p, weight[k:k + BLOCK])
                for k in range(0, len(words), BLOCK))  # one block's lattice at a time
        pooled = n.sum(axis=1, keepdims=True) + 0.05
        pooled /= pooled.sum()
        p = (n + BACKGROUND * pooled) / (n.sum(axis=0) + BACKGROUND)
    return model | {"p": p}


def identify(docs: DataFrame, model: dict, text_col: str = "text", taken=("lang_pred", "score")) -> DataFrame:
    """``docs`` with lang_pred and score, the posterior of lang_pred among the learned languages (even priors).

    A NULL text or one without a letter is ``und`` with score 0, and so is
    every text if no language was learned.  Ties go to the first language by
    code point.
    """
    own = [c for c in docs.columns if c.lower() not in taken]
    at = own.index(text_col)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own] + ["lang_pred string", "score double"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary and the languages

    def run(batches):
        m = shared.value  # one object per worker: it also keeps the words scored so far
        m.setdefault("number", {})
        m.setdefault("scores", np.zeros((0, len(m["langs"]))))
        for batch in batches:
            _, offsets = text_buffers(batch.column(at))
            for a, b in steps(offsets):
                part = batch.slice(a, b - a)
                pred, score = _predict([words_of(t or "") for t in part.column(at).to_pylist()], m)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score)],
                                                 [*own, "lang_pred", "score"])

    return docs.select(*own).mapInArrow(lean_batches(run), schema)


def _predict(texts: list[list[str]], m: dict):
    pred, score = [NONE] * len(texts), np.zeros(len(texts))
    if not m["langs"]:
        return pred, score
    number = m["number"]
    new = {w for ws in texts for w in ws if w not in number}
    if new:
        if len(number) + len(new) > KEPT:
            number.clear()
            m["scores"] = m["scores"][:0]
            new = {w for ws in texts for w in ws}
        new = list(new)
        base = len(m["scores"])
        number.update(zip(new, range(base, base + len(new))))
        m["scores"] = np.concatenate([m["scores"], word_scores(new, m)])
    some = [i for i, ws in enumerate(texts) if ws]
    if some:
        at = np.fromiter((number[w] for i in some for w in texts[i]), np.int64)
        size = np.array([len(texts[i]) for i in some])
        z = np.add.reduceat(m["scores"][at], np.cumsum(size) - size, axis=0)
        best = z.argmax(axis=1)
        post = 1 / np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1)
        for i, b, s in zip(some, best.tolist(), post.tolist()):
            pred[i], score[i] = m["langs"][b], s
    return pred, score


def language_id(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                path: str | None = None) -> DataFrame:
    """Train where ``learn`` holds and the language is given, predict for all rows.

    Returns the columns of ``docs`` with lang_pred and score (see
    ``identify``); columns of these names are replaced.  Rows with a NULL id
    are learned from only if ``learn`` is true for them.  Repeated rows count
    and are predicted each.  An empty table gives an empty table.
    """
    return identify(docs, train(docs, learn, id_col, text_col, lang_col, path), text_col)
