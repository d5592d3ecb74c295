"""Suffix sorting inside anchor groups ranks only the text of windows that may be repeated."""

import collections

import numpy as np

from tillroll.llm import suffix_dedup


def test_places_by_first_bytes_leave_little_to_rank(monkeypatch):
    rng = np.random.default_rng(7)
    width, phrases, groups = 200, [], []
    for g in range(40):
        common = rng.integers(97, 123, 230).astype(np.uint8)
        other = rng.integers(97, 123, 230).astype(np.uint8)
        other[:48] = common[:48]  # the anchor; the windows differ after it
        phrases += [common, other] + ([np.append(common[:215], other[:15])] if g % 4 == 0 else [])
        groups += [g] * (3 if g % 4 == 0 else 2)
    text = np.concatenate(phrases)
    begin, windows = np.arange(len(phrases)) * 230, np.full(len(phrases), 31)
    weight = np.where(np.arange(len(phrases)) % 7 == 0, 2, 1)
    ranked, plain = [], suffix_dedup._ranks
    monkeypatch.setattr(suffix_dedup, "_ranks", lambda t, w: ranked.append(len(t)) or plain(t, w))
    got = suffix_dedup.repeated_suffixes(text, begin, windows, weight, width, np.array(groups))
    raw = text.tobytes()
    at = [b + k for b, n in zip(begin, windows) for k in range(n)]
    total = collections.Counter()
    for p, w in zip(at, np.repeat(weight, windows).tolist()):
        total[raw[p:p + width]] += w
    assert got.tolist() == [total[raw[p:p + width]] > 1 for p in at]
    assert sum(ranked) < len(text) / 3


def test_one_letter_texts_are_ranked_whole():
    text = np.full(1000, 97, np.uint8)
    got = suffix_dedup.repeated_suffixes(text, np.array([0, 500]), np.array([50, 1]), np.ones(2, np.int64), 200, np.array([0, 1]))
    assert got.all()
    text[250] = 98
    got = suffix_dedup.repeated_suffixes(text[:451], np.array([0]), np.array([252]), np.ones(1, np.int64), 200)
    assert got.tolist() == [True] * 51 + [False] * 200 + [True]
