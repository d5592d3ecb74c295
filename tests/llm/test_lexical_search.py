"""Ranked lexical search against a plain scorer on hard tables (the query itself has SQL)."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, want in asked.items():
        found = []
        for i, c in held:
            m = 25 + (75 * sum(c.values()) * n) // total
            score = sum(x * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t, x in want.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found, key=lambda z: z[:3])[:k], 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


WORDS = ["Alpha", "beta", "BETA", "été", "Été", "x1", "1", "a_b", "日本", "🎉", "ſ", "K", "the", "the", "the"]


@pytest.mark.parametrize("block_bytes", [ls.BLOCK_BYTES, 64])
def test_against_brute_force(spark, docs, block_bytes):
    rnd = random.Random(3)
    text = lambda n: "".join(rnd.choice(WORDS) + rnd.choice([" ", "-", "\0", ", ", ""]) for _ in range(n))
    rows = [(i, text(rnd.randrange(30)), 1, 2, 3) for i in range(150)]
    rows += [(r.doc_id, r.text, 1, 2, 3) for r in docs.collect()]
    rows += [(7, "the beta", 1, 2, 3)] * 5 + [(None, "the beta", 1, 2, 3)] * 3 + [(1000 + i, "only here twice", 1, 2, 3) for i in range(40)]
    items = [(i, text(rnd.randrange(1, 12))) for i in range(12)] + [
        (0, "the été"), (None, "beta x1"), (90, None), (91, ""), (92, "-- !"), (93, "absent"), (94, "only twice"), (95, "the " * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score long, rank int, item_id long").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = ls.search(df, asked, 10, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert result(got) == brute([r[:2] for r in rows], items, 10)


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x")], "name string, body string")
    asked = spark.createDataFrame([("q", "X")], "who string, body string")
    got = ls.search(df, asked, 2, "name", "body", "who", "body")
    assert [(r.who, r["rank"], r.name) for r in got.orderBy("rank").collect()] == [("q", 1, None), ("q", 2, "a")]


def test_automaton_matches_whole_terms():
    a = ls.automaton(["art", "été", "1a"])
    texts = ["Art start art", "", "été étés", "1a 1A 11a", "\0art\0art"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    length, doc, term, tf = ls.term_counts(data, offsets, a, 3)
    assert length.tolist() == [3, 0, 2, 3, 2]
    assert list(zip(doc.tolist(), term.tolist(), tf.tolist())) == [(0, 0, 2), (2, 1, 1), (3, 2, 2), (4, 0, 2)]


def test_empty_tables(spark, docs, none):
    asked = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert ls.search(none, asked).count() == 0 and ls.search(docs, asked.limit(0)).count() == 0
    assert ls.search(docs, asked).schema.simpleString() == ls.search(none, asked).schema.simpleString()
