"""Each operator against brute force, on the given documents and on a table of hard cases."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillroll.llm import (ann, language_id, mixing, multiset_hash, ngram_lm, packing, simhash, substring_dedup,
                          suffix_dedup, toxicity)


def crc(m):
    return F.crc32(F.col("doc_id").cast("string")) % m


def key(i):
    return -1 if i is None else i


def tables(docs, given):
    return [docs, given]


# -- 4 substring dedup ------------------------------------------------------------------------------

def test_substring_dedup(docs, given, none):
    for t in tables(docs, given):
        rows = [(key(r.doc_id), (r.text or "").encode().split()) for r in t.collect()]
        low = {}
        for i, w in rows:
            for j in range(len(w) - 49):
                k = tuple(w[j:j + 50])
                low[k] = min(low.get(k, i), i)
        want = []
        for i, w in rows:
            g = [False] * len(w)
            for j in range(len(w) - 49):
                if low[tuple(w[j:j + 50])] < i:
                    g[j:j + 50] = [True] * 50
            want.append((i, len(w), sum(g), b" ".join(x for x, y in zip(w, g) if not y).decode()))
        got = substring_dedup.substring_dedup(t).collect()
        assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.text) for r in got) == sorted(want)
        assert all(sum(x.length for x in r.removed) == r.n_removed for r in got)
    assert substring_dedup.substring_dedup(none).count() == 0


# -- 2 suffix dedup ---------------------------------------------------------------------------------

@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup(docs, given, none, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    for t in tables(docs, given):
        rows = [(key(r.doc_id), (r.text or "").encode()) for r in t.collect()]
        seen = collections.Counter(w[j:j + 200] for _, w in rows for j in range(len(w) - 199))
        want = []
        for i, w in rows:
            m = np.zeros(len(w) + 201, np.int64)
            for j in range(len(w) - 199):
                if seen[w[j:j + 200]] > 1:
                    m[j] += 1
                    m[j + 200] -= 1
            g = np.cumsum(m)[:len(w)] > 0
            runs = int((np.diff(np.concatenate([[0], g, [0]]).astype(int)) == 1).sum())
            want.append((i, len(w), int(g.sum()), runs, np.frombuffer(w, np.uint8)[~g].tobytes()))
        got = suffix_dedup.suffix_dedup(t).collect()
        assert sorted((key(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(want)
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_repeated_suffixes_sorts_whole_windows():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 4000).astype(np.uint8)
    text[1000:1400] = text[2000:2400]
    begin, windows = np.array([0, 1000, 2000]), np.array([100, 201, 201])
    got = suffix_dedup.repeated_suffixes(text, begin, windows, np.ones(3, np.int64), 200)
    raw = text.tobytes()
    all_windows = [raw[b + k:b + k + 200] for b, n in zip(begin, windows) for k in range(n)]
    seen = collections.Counter(all_windows)
    assert got.tolist() == [seen[w] > 1 for w in all_windows]


# -- 10 SimHash -------------------------------------------------------------------------------------

def test_simhash(docs, given, none):
    for t in tables(docs, given):
        rows = t.collect()
        fps = []
        for r in rows:
            w = bytes(c + 32 if 65 <= c <= 90 else c for c in (r.text or "").encode()).split()
            h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
            fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
        v = np.array(fps, np.uint64)
        label = np.arange(len(v))
        simhash._merge(label, *np.nonzero(np.triu(np.bitwise_count(v[:, None] ^ v[None]) <= 4, 1)))
        least = {}
        for r, c in zip(rows, label.tolist()):
            if r.doc_id is not None:
                least[c] = min(least.get(c, r.doc_id), r.doc_id)
        want = sorted((key(r.doc_id), fp, key(least.get(c))) for r, fp, c in zip(rows, fps, label.tolist()))
        got = simhash.simhash_components(t).collect()
        assert sorted((key(r.id), r.fp % (1 << 64), key(r.component_id)) for r in got) == want
        kept = simhash.simhash_dedup(t)
        assert kept.columns == t.columns
        nulls = sum(r.doc_id is None for r in rows)
        assert kept.count() == len(set(least.values())) + nulls
    assert simhash.simhash_components(none).count() == 0


@pytest.mark.parametrize("block", [10, 32_768])
def test_trie_join_finds_every_link(spark, block):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = [base ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)) for _ in range(3)]
    dense = base[0] ^ np.arange(300, dtype=np.uint64)
    v = np.unique(np.concatenate([base, *near, dense]))
    fps = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    from tillroll.llm.graph import components
    got = {r.node: r.root for r in components(simhash.links(fps, 4, block)).collect()}
    label = np.arange(len(v))
    simhash._merge(label, *np.nonzero(np.triu(np.bitwise_count(v[:, None] ^ v[None]) <= 4, 1)))
    groups = collections.defaultdict(set)
    for x, c in zip(v.view(np.int64).tolist(), label.tolist()):
        groups[c].add(x)
    found = collections.defaultdict(set)
    for x in v.view(np.int64).tolist():
        found[got.get(x, x)].add(x)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))


def test_simhash_dedup_keeps_one_row_of_every_component(spark):
    text = [" ".join(f"{c}{i}" for i in range(80)) for c in "abcde"]
    near = [t + " " + t for t in text]  # same shingles but for three
    rows = [(3, text[0]), (5, near[0]), (5, text[1]), (5, text[2]), (7, text[1]), (None, text[2]),
            (None, text[3]), (None, near[3]), (None, text[3]), (9, text[4]), (9, text[4]), (9, near[4])]
    t = spark.createDataFrame(rows, "doc_id long, text string")
    label = {}
    fp = {r.t: r.fp for r in simhash.fingerprints(t.selectExpr("text as t0", "text"), "t0").withColumnRenamed("id", "t").collect()}
    for c, (a, b) in enumerate(zip(text, near)):
        assert ((fp[a] ^ fp.get(b, fp[a])) & (1 << 64) - 1).bit_count() <= 4
        label[a] = label[b] = c
    import corpus_pipeline as P
    want = [(3, 0), (5, 1), (5, 2), (9, 4)]
    for kept, nulls in ((simhash.simhash_dedup(t.repartition(3)), [(None, 2)] + [(None, 3)] * 3),
                        (P.drop_near_duplicates(spark, t.repartition(3), ""), [(None, 3)])):
        assert sorted([(r.doc_id, label[r.text]) for r in kept.collect()], key=str) == sorted(want + nulls, key=str)


def test_trie_blocks_go_on_where_prefixes_are_full(spark):
    v = [(int(x),) for x in np.arange(300, dtype=np.int64) - 150] + [(5 << 48 | i << 20,) for i in range(100)]
    fps = spark.createDataFrame(v, "fp long")
    blocks = simhash._trie_blocks(fps, 10)
    assert sum(n for _, _, n in blocks) == 400 and max(n for _, _, n in blocks) <= 10


# -- chunks -----------------------------------------------------------------------------------------

def test_chunks_hold_even_bytes_and_split_hot_ids(spark):
    from tillroll.llm import chunks

    rows = [(i, f"short {i}") for i in range(600)] + [(600 + i, f"long {i} " * 150) for i in range(60)]
    rows += [(50, f"hot {i} " * 12) for i in range(600)] + [(None, f"null {i} " * 12) for i in range(600)]
    t = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plan = chunks.chunking(t, "doc_id", "text")
    size, seen = collections.Counter(), []
    for r in chunks.packed(t, "doc_id", plan).collect():
        got = chunks.from_blobs([r.blob], ["doc_id", "text"]).to_pylist()
        size[r.chunk] += sum(len(x["text"]) + 64 for x in got)
        seen += [(x["doc_id"], x["text"]) for x in got]
    assert sorted(seen, key=str) == sorted(rows, key=str)
    assert max(size.values()) <= 2 * sum(size.values()) / 12
    got = multiset_hash.edited_fingerprints(t).collect()
    assert len(got) == len(rows)


def test_substring_dedup_of_a_split_id(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(7, f"{words} own{i}") for i in range(400)] + [(9, words), (8, "b " * 10)]
    t = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter((r.doc_id, r.n_removed) for r in substring_dedup.substring_dedup(t).collect())
    assert got == {(7, 0): 400, (9, 60): 1, (8, 0): 1}


# -- 3 packing --------------------------------------------------------------------------------------

def test_packing(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = docs.collect()
    want = []
    for r in rows:
        ids = own.encode(r.text or "", add_special_tokens=False).ids + [2]
        start, size, piece = 0, len(ids) % 1024 or 1024, 0
        while start < len(ids):
            part = np.array(ids[start:start + size], "<u4")
            want.append((key(r.doc_id), piece, start, len(part), zlib.crc32(part.tobytes())))
            start, size, piece = start + size, 1024, piece + 1
    got = packing.pack_documents(docs, with_ids=True).collect()
    assert sorted((key(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert all(len(r.ids) == r.length for r in got)
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(none).count() == 0


def test_rounds_close_gaps(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 400, 4000)
    t = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "id int, length long")
    out = packing.pack(t, 1024, group=500).collect()
    assert sorted(r.id for r in out) == list(range(4000))
    used = collections.defaultdict(int)
    for r in out:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 1024
    # as good as best-fit decreasing over all pieces at once, but for one sequence
    assert packing.lower_bound(sizes, 1024) <= len(used) <= len(packing.best_fit_decreasing(sizes, 1024)[2]) + 1


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sizes = rng.integers(1, 21, rng.integers(1, 30))
        assert packing.lower_bound(sizes, 20) <= len(packing.best_fit_decreasing(sizes, 20)[2])
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3
    assert packing.lower_bound(np.array([7] * 5), 20) == 3


def test_token_ids_equal_the_reference_tokenizer(given):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tillroll.llm.tokens import Encoder

    texts = [r.text or "" for r in given.select("text").limit(60).collect()]
    texts += ["", " ", "a  b", " a", "a ", "x<|endoftext|>y z", "a\n b \n\nc", "it's  we're\t\tx", "é" * 50, "  a  b", "1 22 a1 !!"]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = Encoder.of()
    for t in texts * 2:
        assert np.frombuffer(encode(t), "<u4").tolist() == own.encode(t, add_special_tokens=False).ids, t


# -- 7 mixing ---------------------------------------------------------------------------------------

def test_targets_by_hand(spark):
    t = spark.createDataFrame([("b", 100), ("a", 10), (None, 1000), ("c", 0)], "source string, source_size long")
    got = {r.source: (r.number, r.target) for r in mixing.source_targets(t).collect()}
    # weights a 1, b 2, c 3, None 1 of 1110: a, b and c are full at 30, 300 and 0; the rest goes to None
    assert got["a"] == (0, 30.0) and got["b"] == (1, 300.0) and got["c"] == (2, 0.0)
    assert got[None][0] == 3 and abs(got[None][1] - 780) < 1e-6


def test_mixing(docs, given, none):
    for t in tables(docs, given):
        got = mixing.copies(t).collect()
        again = mixing.copies(t.repartition(3)).collect()
        assert sorted((key(r.id), r.size, r.copies) for r in got) == sorted((key(r.id), r.size, r.copies) for r in again)
        assert len(got) == t.count() and all(0 <= r.copies <= 3 for r in got)
        total = sum(r.size for r in got)
        by = collections.defaultdict(list)
        for r in got:
            by[r.source].append(r)
        assert abs(sum(v[0].target for v in by.values()) - total) < 1e-6 * max(1, total)
        for v in by.values():
            off = abs(sum(r.size * r.copies for r in v) - v[0].target)
            assert off <= max(r.size for r in v) / 2 + 1
        mixed = mixing.mix_documents(t)
        assert mixed.columns == t.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.copies(none).count() == 0 and mixing.mix_documents(none).count() == 0


def test_mixing_takes_documents_by_their_inclusion_odds(spark, monkeypatch):
    sizes, each = (8, 64, 256, 768), 1500
    t = spark.range(len(sizes) * each * 2).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
        F.repeat(F.lit("w "), F.element_at(F.array(*[F.lit(n) for n in sizes]),
                                           ((F.col("id") / 2).cast("int") % len(sizes) + 1))).alias("text")).cache()
    got = mixing.copies(t)
    per = got.groupBy("source", "size").agg(F.min("rate").alias("rate"), F.max("rate").alias("top"), F.avg("copies").alias("mean"),
                                            F.count("*").alias("n")).collect()
    assert len(per) == 8 and all(r.rate == r.top for r in per)
    for r in per:  # four standard errors of a draw of n
        p = r.rate % 1
        assert abs(r.mean - r.rate) <= 4 * math.sqrt(p * (1 - p) / r.n), r
    for source in "ab":
        rates = [r.rate for r in sorted(per, key=lambda r: r["size"]) if r.source == source]
        assert rates == sorted(rates) and rates[-1] - rates[0] > 0.3
        expected = sum(r.rate * r["size"] * r.n for r in per if r.source == source)
        target = got.where(F.col("source") == source).first().target
        assert abs(expected - target) < 1e-6 * target
    # equal preferences are equal rates; one as a column of the documents
    flat = mixing.copies(t, preference=F.lit(0.5)).agg(F.count_distinct("source", "rate")).first()[0]
    assert flat == 2
    # the end of the order found by many small slices is the same as by one sort
    whole = sorted((r.id, r.copies) for r in got.collect())
    monkeypatch.setattr(mixing, "SLICES", 4)
    monkeypatch.setattr(mixing, "SORTED", 3)
    assert sorted((r.id, r.copies) for r in mixing.copies(t).collect()) == whole


def test_mixing_keeps_one_row_of_equal_documents_whatever_the_order(spark):
    rows = [(1, "a b c", "s", 10, 5), (1, "a b c", "s", 11, 5), (1, "a b c", "s", 9, 5), (2, None, "s", 1, 1), (3, "", None, 1, 1)]
    t = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, copies int")
    first = sorted(mixing.mix_documents(t).collect(), key=str)
    assert first and {r["size"] for r in first if r.doc_id == 1} < {9, 10, 11} and len({r["size"] for r in first if r.doc_id == 1}) == 1
    assert sorted(mixing.mix_documents(t.orderBy(F.desc("size")).repartition(4)).collect(), key=str) == first


# -- 6 language model -------------------------------------------------------------------------------

def test_ngram_lm(docs, given, none):
    for t in tables(docs, given):
        learn = crc(7) != 2
        got = ngram_lm.lm_scores(t, learn).collect()
        texts = {}
        train = []
        for r in t.collect():
            w = bytes(c + 32 if 65 <= c <= 90 else c for c in (r.text or "").encode()).split() + [None]
            texts[r.doc_id] = w
            if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
                train.append(w)
        c = collections.Counter(x for w in train for x in w)
        n, kinds = sum(c.values()), len(c)
        pairs = collections.Counter((p, x) for w in train for p, x in zip([0, *w[:-1]], w))
        context, left = collections.defaultdict(lambda: [0] * 4), collections.Counter()
        for (p, x), k in pairs.items():
            context[p][0] += k
            context[p][min(k, 3)] += 1
            left[x] += 1
        d2, d1 = (ngram_lm._discounts([sum(1 for v in y.values() if v == k) for k in (1, 2, 3, 4)]) for y in (pairs, left))
        total = sum(left.values())
        rest = sum(d1[min(v, 3)] for v in left.values())
        for r in got:
            w = texts[r.doc_id]
            base = sum(math.log10((c[x] + 1) / (n + kinds + 1)) for x in w)
            score = 0.0
            for p, x in zip([0, *w[:-1]], w):
                q = (left[x] - d1[min(left[x], 3)]) / total + rest / total / (kinds + 1)
                s, k = context.get(p), pairs.get((p, x), 0)
                score += math.log10((k - d2[min(k, 3)] + sum(d2[i] * s[i] for i in (1, 2, 3)) * q) / s[0] if s else q)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)
    assert ngram_lm.lm_scores(none, crc(7) != 2).count() == 0


def test_ngram_lookup_searches_where_words_were_stored(tmp_path):
    from tillroll.llm.chunks import bucket_cuts

    buckets = 36  # no power of two
    near = [(i << 64) // buckets + d for i in range(1, buckets) for d in (-70_000, -1, 0, 1, 70_000, 1 << 31)]
    w = np.unique(np.array(near, np.uint64))
    word = np.unique(w >> np.uint64(16))
    for keys, at, names in ((w, w, ("token", "count")), (word, word << np.uint64(16), ("word", "left"))):
        cuts = bucket_cuts(at, buckets)
        for b, (x, y) in enumerate(zip(cuts, cuts[1:])):
            ngram_lm._save(str(tmp_path), f"{names[0]}-{b}", keys[x:y])
            ngram_lm._save(str(tmp_path), f"{names[1]}-{b}", np.ones(y - x, np.int64))
    all_of, none_of = np.ones(buckets, bool), np.zeros(buckets, bool)   # no bigram is stored
    model = {"folder": str(tmp_path), "filled": {"token": all_of, "word": all_of, "key": none_of},
             "buckets": buckets, "tokens": len(w), "kinds": len(w), "hot": np.array([ngram_lm.BEGIN]),
             "hot_stats": np.zeros((1, 4), np.int64), "d1": np.array([0, 0.5, 1, 1.5]), "d2": np.zeros(4),
             "left": len(word), "rest": 0.5 * len(word)}
    n, known, base, score = ngram_lm._score(model, ngram_lm._Maps(model), w,
                                            np.append(ngram_lm.BEGIN, w[:-1]), np.array([0]))
    assert n.tolist() == known.tolist() == [len(w)]
    assert math.isclose(base[0], len(w) * math.log10(2 / (2 * len(w) + 1)))
    assert math.isclose(score[0], len(w) * math.log10(0.5 / len(word) + 0.5 / (len(w) + 1)))


# -- 5 multiset hash --------------------------------------------------------------------------------

def test_multiset_hash_is_homomorphic(spark):
    t = spark.createDataFrame([("a\nb\nb\nc d. e", "c d. e\nb\na\nb", "a\nb", "b\nc d. e")], "x string, y string, u string, v string")
    v = {c: multiset_hash.vector(F.col(c)) for c in t.columns}
    r = t.select(
        (v["x"] == v["y"]).alias("order"), (multiset_hash.insert(v["u"], v["v"]) == v["x"]).alias("ins"),
        (multiset_hash.delete(v["x"], v["v"]) == v["u"]).alias("out"), (v["x"] == v["u"]).alias("differ"),
        multiset_hash.digest(v["x"]).alias("d")).first()
    assert r.order and r.ins and r.out and not r.differ and len(r.d) == 8 * 9 + 4 * 128


def test_edited_fingerprints(docs, given, none):
    for t in tables(docs, given):
        rows = sorted(((key(r.doc_id), r.text or "") for r in t.collect()), key=lambda x: x[0])
        got = multiset_hash.edited_fingerprints(t)
        assert "Python" not in got._jdf.queryExecution().toString()
        got = got.collect()
        assert len(got) == len(rows)
        want = []
        for (i, x), (_, y) in zip(rows, rows[1:] + rows[:1]):
            k = len(x) // 4
            want.append((i, len(x), hashlib.sha256((x[:len(x) - k] + y[:k]).encode()).hexdigest()))
        assert sorted((key(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
        text = collections.defaultdict(set)
        for r in got:
            text[r.fingerprint].add(dict(rows)[key(r.doc_id)])
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert all(len({tuple(sorted(p for p in x.split("\n") if p)) for x in s}) <= 2 for s in text.values())
    mean = [np.mean([getattr(r, c) for r in got]) for c in ("near_edited", "near_next")]
    assert mean[0] > 0.6 and mean[1] < 0.2
    assert multiset_hash.edited_fingerprints(none).count() == 0


def test_a_missing_store_file_is_an_error(docs):
    import os

    model = ngram_lm.train(docs)
    want = ngram_lm.score(docs, model).count()
    assert want == docs.count()
    for kind in ("token", "count", "key", "stats", "word"):
        b = int(np.flatnonzero(model["filled"][ngram_lm.STORED_WITH.get(kind, kind)])[0])
        path = f"{model['folder']}/{kind}-{b}.npy"
        held = open(path, "rb").read()
        os.remove(path)
        with pytest.raises(Exception, match="is missing"):
            ngram_lm.score(docs, model).collect()
        with open(path, "wb") as f:
            f.write(held)
    assert ngram_lm.score(docs, model).count() == want


# -- 8 toxicity -------------------------------------------------------------------------------------

def test_toxicity(docs, none, spark):
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(big, labels, crc(3) != 1).collect()}
    held = [(got[r.doc_id], r.toxic) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    hit = sum(s >= 0.7 and y == 1 for s, y in held)
    assert hit >= 0.8 * sum(y for _, y in held) and hit >= 0.85 * sum(s >= 0.7 for s, _ in held)  # 305 toxic training rows
    model = toxicity.fit(big, labels, crc(3) != 1)
    odd = toxicity.toxicity(docs, model)
    assert odd.count() == docs.count() and odd.where("score is null or score < 0 or score > 1").count() == 0
    one = labels.where("toxic = 0")
    assert toxicity.score_toxicity(docs, one, crc(3) != 1).where("score >= 0.7").count() == 0
    assert toxicity.score_toxicity(none, labels, crc(3) != 1).count() == 0


def test_toxicity_counts_all_training_rows(spark):
    words = [f"word{i}" for i in range(40)]
    ids = spark.range(400).withColumn("y", (F.col("id") % 2).cast("int"))
    u = F.shiftrightunsigned(F.xxhash64("id", F.lit(5)), 11) / float(1 << 53)  # rows=20 of 200 a class are sampled
    # every toxic text outside the sample has the marker, no other text
    rows = [(r.id, " ".join(words[(r.id + k) % 40] for k in range(8)) + (" zqxjvk" if r.y and not r.inside else ""), r.y)
            for r in ids.select("id", "y", (u < 0.1).alias("inside")).collect()]
    t = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(t.select("doc_id", "text"), t.select("doc_id", "toxic"), F.lit(True), rows=20, kept=64)
    marker = [int(f[0]) for f, _ in toxicity._grams(np.frombuffer(b"zqxjvk", np.uint8), np.array([0, 6]))]
    assert all(model["table"][f] >= 0 for f in marker)


# -- 1 language ID ----------------------------------------------------------------------------------

def test_forward_algorithm_sums_all_segmentations():
    vocab = np.unique(np.concatenate([language_id._codes([p])[2] for p in ("_", "a", "b", "ab", "_a", "ba", "_aba")]))
    at = {p: int(np.searchsorted(vocab, language_id._codes([p])[2][0])) for p in ("_", "a", "b", "ab", "_a", "ba", "_aba")}
    p = np.random.default_rng(0).random((len(vocab) + 1, 2))

    def total(s, c):
        if not s:
            return 1.0
        return sum((p[at[s[:k]], c] if s[:k] in at else p[-1, c] if k == 1 else 0) * total(s[k:], c)
                   for k in range(1, len(s) + 1))

    words = ["aba", "b", "abx", "bababa"]
    got = language_id.word_scores(words, {"langs": ["x", "y"], "vocab": vocab, "longest": 4, "p": p})
    assert np.allclose(got, [[math.log(total("_" + w, c)) for c in (0, 1)] for w in words])


def test_long_words_and_long_pieces():
    """No cut: pieces of any length count everywhere, also over a word of hundreds of letters."""
    pieces = ["_", "a", "b", "abababababab", "_abababababab", "bb"]
    codes = [int(language_id._codes([x])[2][0]) for x in pieces]
    vocab = np.unique(np.array(codes, np.uint64))
    at = {x: int(np.searchsorted(vocab, np.uint64(c))) for x, c in zip(pieces, codes)}
    p = np.random.default_rng(3).random((len(vocab) + 1, 2)) / 50

    def log_total(word, c):
        s, a = "_" + word, [0.0] + [-math.inf] * (len(word) + 1)   # log forward sums
        for end in range(1, len(s) + 1):
            some = [a[end - len(x)] + math.log(p[at[x], c]) for x in pieces if s[:end].endswith(x)]
            if s[end - 1] not in at:
                some.append(a[end - 1] + math.log(p[-1, c]))
            a[end] = float(np.logaddexp.reduce(some)) if some else -math.inf
        return a[-1]

    words = ["ab" * 6, "ab" * 250 + "x" + "ab" * 6, "b" * 500, "a"]
    got = language_id.word_scores(words, {"langs": ["x", "y"], "vocab": vocab, "longest": 13, "p": p})
    assert np.allclose(got, [[log_total(w, c) for c in (0, 1)] for w in words])
    assert language_id.words_of("A" + "b" * 499) == ["a" + "b" * 499]


def test_words_are_letters_only():
    assert language_id.words_of("² ½ 12 _") == []
    assert language_id.words_of("Aé² x½y 3z") == ["aé", "x", "y", "z"]


def test_language_id(docs, none, spark):
    t = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_id(t, crc(4) != 2).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    model = language_id.train(t, crc(4) != 2)
    for r in language_id.identify(docs, model).collect():
        letters = any(ch.isalpha() for ch in r.text or "")
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
    assert language_id.language_id(none, F.lit(True)).count() == 0
    unnamed = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.language_id(unnamed, F.lit(True)).collect()} == {"und"}


# -- 9 nearest neighbours ---------------------------------------------------------------------------

def brute(rows, k):
    out = {}
    for i, q in rows:
        s = sorted((-sum(float(a) * float(b) for a, b in zip(q, x)), j) for j, x in rows if j != i)
        out[i] = [j for _, j in s[:k]]
    return out


def test_nearest(spark):
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = collections.defaultdict(set)
    for r in ann.nearest(emb, F.col("vec_id") % 20 == 0, block=128).collect():
        got[r.query_id].add(r.vec_id)
    x = np.array([r.embedding for r in emb.orderBy("vec_id").collect()], float)
    recall = []
    for i in range(0, len(x), 20):
        s = x @ x[i]
        s[i] = -np.inf
        recall.append(len(got[i] & set(np.argsort(-s, kind="stable")[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.9


def test_nearest_hard_cases(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(60)] + [(100, [2.0, 1.0]), (100, [2.0, 1.0])]
    odd = [(200, None), (201, [0.0, 0.0]), (202, [float("nan"), 1.0]), (203, [None, 1.0]), (204, [float("inf"), 1.0]),
           (205, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    t = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = collections.defaultdict(list)
    for r in ann.nearest(t, F.lit(True), k=5, sure=1.1).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert dict(got) == brute(sorted(dict(rows).items()), 5)
    assert ann.nearest(t.limit(0), F.lit(True)).count() == 0


# -- pipeline ---------------------------------------------------------------------------------------

def test_pipeline_stages(spark, docs, given, none):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup", "pareto_mixing",
                                        "best_fit_packing"]
    for t in (docs, given, none):
        d = t
        for _, stage in P.STAGES[:-1]:
            after = stage(spark, d, "")
            assert after.schema.simpleString() == t.schema.simpleString() if "n_chars" in t.columns else True
            d = after.cache()
        packed = P.pack_sequences(spark, d, "")
        assert {"doc_id", "piece", "sequence_id", "offset"} <= set(packed.columns)
        assert packed.where("piece = 0").count() == d.count()
    clean = [r.doc_id for r in P.identify_language(spark, given, "").select("doc_id").collect()]
    letters = [r.doc_id for r in given.collect() if any(c.isalpha() for c in r.text or "")]
    assert sorted(clean) == sorted(letters)
