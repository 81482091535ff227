"""Collocations against plain counting, and the quicksort against a dictionary."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from repopulse.llm import collocations as co

CUT, WORD = re.compile("[.,;:!?\n-\r]"), re.compile("[^ \t]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_collocations(rows, min_count, best):
    f: dict = defaultdict(Counter)
    n: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in CUT.split((text or "").translate(UPPER)):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        kept = []
        longest: Counter = Counter()
        for p, b in candidates.items():
            if len(p) == 3:
                longest[p[:2]] = max(longest[p[:2]], b)
                longest[p[1:]] = max(longest[p[1:]], b)
        for phrase, a in candidates.items():
            if longest[phrase] and 100 * longest[phrase] >= 50 * a:
                continue
            cuts = [(counts[phrase[:k]], counts[phrase[k:]], k) for k in range(1, len(phrase))]
            score, _, l, r = min((1_000_000 * a * a // (l * r), k, l, r) for l, r, k in cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(docs, **options):
    return sorted(tuple(row) for row in co.collocations(docs, **options).collect())


def some_docs(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "é", "İx", "\x01", "a\x00b", "a" * 50, *(f"w{k}" for k in range(25))]
    weights = [40, 30] + [3] * (len(vocabulary) - 2)
    rows = []
    for _ in range(n):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        text = "".join(
            (w.upper() if rng.random() < 0.2 else w) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\r\n", ";", "\x0b"])
            for w in words
        )
        rows.append((rng.choice(["en", "en", "en", "und", "x y", None]), text))
    return [*rows, ("en", None), (None, ""), ("en", " \t. "), rows[0], rows[0]]


@pytest.mark.parametrize("seed,bits", [(1, 1 << 26), (2, 8), (3, 512)])
def test_same_as_counting(spark, seed, bits):
    """The bitmap may be as small as it likes; words over a quarter share are routed by three."""
    rows = some_docs(seed)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    for least, best in ((10, 2000), (3, 7)):
        assert got(docs, min_count=least, best=best, bits=bits) == plain_collocations(rows, least, best)


def test_small_holds_change_nothing(spark, monkeypatch):
    rows = some_docs(4)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    by_texts = [_taken(rows, stretch) for stretch in (1 << 20, 16)]
    assert by_texts[0] == by_texts[1]
    assert got(docs, min_count=4) == plain_collocations(rows, 4, 2000)


def _taken(rows, stretch):
    old, co.STRETCH = co.STRETCH, stretch
    try:
        out = []
        for _, text in rows:
            words = co._Words()
            words.add(text or "")
            running, spelled = words.taken()
            pieces = b" ".join(spelled[running]).split(b"\n")
            out.append([p.strip() for p in pieces if p.strip()])
        return out
    finally:
        co.STRETCH = old


def test_awkward_tables(awkward, nothing):
    rows = [(row.lang, row.text) for row in awkward.select("lang", "text").collect()]
    assert got(awkward, min_count=2) == plain_collocations(rows, 2, 2000)
    assert got(nothing) == []
    assert got(awkward.where("text is null")) == []


def test_quicksort_counts_phrases():
    rng = np.random.default_rng(5)
    words = rng.integers(1, 7, (3000, 3)) * np.array([1, 1, 1])
    words[rng.random(3000) < 0.2, 2] = 0
    weights = rng.integers(1, 5, 3000)
    expected: Counter = Counter()
    for row, n in zip(words.tolist(), weights.tolist()):
        for depth in (1, 2, 3):
            if row[depth - 1]:
                expected[tuple(row[:depth])] += n
    for least in (1, 40, 500):
        found = {tuple(words[at, :depth]): n for at, depth, n in co.three_way_quicksort(words, weights, least)}
        assert found == {p: n for p, n in expected.items() if n >= least}


def test_scores_pass_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 3 * 10**12), ("en", "b", 7 * 10**12 + 1)], "lang string, word string, n long")
    phrases = spark.createDataFrame([("en", "a", "b", None, 10**12 + 3)], "lang string, w0 string, w1 string, w2 string, n long")
    (row,) = co.scored_phrases(words, phrases).collect()
    a, l, r = 10**12 + 3, 3 * 10**12, 7 * 10**12 + 1
    assert row.score == 1_000_000 * a * a // (l * r)
