"""Cross-tokenizer alignment against the reference encoders and set-by-set grouping."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tillroll.llm import token_alignment as ta
from tillroll.llm.queries import op12_token_alignment


def _level():
    """The byte of each character of a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    level = _level()
    docs = []
    for t in texts:
        groups = []
        if t:
            ai, bi = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            at = [bytes(level[c] for c in a.id_to_token(i)) for i in ai]
            bt = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                  for i in bi]
            if b"".join(at) == b"".join(bt) == (" " + t).encode():
                ea, eb = (np.cumsum([len(x) for x in z]).tolist() for z in (at, bt))
                i = j = 0
                for end in sorted(set(ea) & set(eb)):
                    i2, j2 = ea.index(end, i) + 1, eb.index(end, j) + 1
                    groups.append((ai[i:i2], bi[j:j2]))
                    i, j = i2, j2
        docs.append(groups)
    held = [{(x, y) for ga, gb in g for x in ga for y in gb} for g in docs]
    count = Counter(p for h in held for p in h)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for g in docs:
        links = [(x, y) for ga, gb in g for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links),
                    sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


COLS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha")
HARD = ["<|endoftext|> and <s> in text", " leading", "trailing  ", "\n\ttabs\r\n", "▁ is no blank", "日本語のテキスト 🎉🎉🎉",
        "naïve café — “quotes”", "a" * 3000, "🎉" * 700, " " * 50, "x\x00y", "ﬁ ligature", "0123456789" * 40, "é" * 999 + " b",
        "same words " * 400]


def result(df, **limits):
    digest = F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise(F.lit(""))
    return ta.link_counts(ta.align(df, **limits).withColumn("sha", digest).drop("groups"), 500)


@pytest.mark.parametrize("lane, pairs", [(4, 100), (ta.LANE, ta.PAIRS)])
def test_hard_texts(spark, docs, lane, pairs):
    rows = [(i, t, "x") for i, t in enumerate([*HARD, *[r.text for r in docs.collect()]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_best string").repartition(3)
    got = result(df, lane=lane, pairs=pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "n_best", "count_sum"]
    want = {(i, *w) for (i, _, _), w in zip(rows, brute([t for _, t, _ in rows]))}
    assert {tuple(r) for r in got.select("doc_id", *COLS).collect()} == want


def test_groups_follow_the_lanes():
    """However many places a document walks in, the groups are those of one walk."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 400))
        ends = np.arange(1, n + 1)
        ea, eb = (np.append(ends[:-1][rng.random(n - 1) < 0.6], n) for _ in range(2))
        common = np.intersect1d(ea, eb)
        for lane in (1, 3, 1000):
            a0, a1, b0, b1 = ta.groups_of(ea, eb, np.array([0, len(ea)]), np.array([0, len(eb)]), lane)
            assert (ea[a1 - 1] == common).all() and (eb[b1 - 1] == common).all()
            assert (a0 == np.append(0, a1[:-1])).all() and (b0 == np.append(0, b1[:-1])).all()


def test_words_by_themselves():
    """Ids of B put together from words are those of the whole text."""
    rnd = np.random.default_rng(4)
    pair = ta._Pair.of(None, None, None)
    parts = ["the", "▁", "▁▁", " ", "a", "\n", "\t", "日本", "🎉", "ing", "Thé", "0", "</s>", "<unk>", "'", "\u00a0", "é", "tion", "x" * 30]
    texts = ["".join(parts[i] + (" " if rnd.random() < 0.5 else "") for i in rnd.integers(0, len(parts), int(rnd.integers(1, 12))))
             for _ in range(3000)]
    for t, ids in zip(texts, pair._b(texts)):
        assert ids.tolist() == pair.b.encode(t), t


def test_a_worker_remembers_no_words():
    """The ids of a span's words go with it, whatever the texts held before."""
    pair = ta._Pair.of(None, None, None)
    texts = [" ".join(f"w{i:x}q{j}" for i in range(j * 40_000, j * 40_000 + 40_000)) for j in range(5)]
    kept = lambda: sum(len(x) for y in (pair, pair.a) for x in vars(y).values() if isinstance(x, dict))
    before = kept()
    for t in texts:
        span = pair.read(pa.array([t, None, "", " ▁", t]))
        (a, n_a), (b, n_b) = span.ids(0, 5)
        assert a.tolist() == pair.a._encode(" " + t) * 2 and b.tolist() == pair.b.encode(t) * 2
        assert n_a.tolist() == [len(a) // 2, 0, 0, 0, len(a) // 2] and n_b.tolist() == [len(b) // 2, 0, 0, 0, len(b) // 2]
        (a, _), (b, _) = span.ids(4, 5)
        assert a.tolist() == pair.a._encode(" " + t) and b.tolist() == pair.b.encode(t)
    assert kept() == before


def test_query(spark, given):
    got = {r.doc_id: tuple(r)[1:] for r in op12_token_alignment(spark, "/root/testdata/sf0.001").collect()}
    rows = given.select("doc_id", "text").collect()
    assert got == {r.doc_id: w for r, w in zip(rows, brute([r.text for r in rows]))}


def test_repeats_and_empty(spark, docs, none):
    assert result(none).count() == 0
    twice = result(docs.unionByName(docs)).select("doc_id", *COLS)
    assert twice.count() == 2 * docs.count()
    once = {(r.doc_id, r.n_links, r.count_sum) for r in result(docs).collect()}
    assert {(r.doc_id, r.n_links, r.count_sum // 2) for r in twice.collect()} == once
    nothing = result(docs.where("coalesce(text, '') = ''"))
    assert {tuple(r)[-7:] for r in nothing.select(*COLS).collect()} == {(0, 0, 0, 0, 0, 0, "")}
