"""Removal of repeated bytes against a dictionary of all strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from repopulse.llm import phrase_parsing as pp


def plain_cut(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of rows (doc_id, text) with distinct ids."""
    seen: set[bytes] = set()
    out = []
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is None, row[0])):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            string = data[p : p + length]
            if string in seen:
                gone[p : p + length] = True
            seen.add(string)
        gone[-1] = False
        spans = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone[:-1]])
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def got(docs, **options):
    rows = pp.remove_repeats(docs, **options).collect()
    return sorted((tuple(row) for row in rows), key=lambda row: (row[0] is None, row[0], row[1:]))


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdeé')}{k:x}{'漢' * (k % 7 == 0)}" for k in range(400)]

    def text(size):
        return " ".join(rng.choices(words, k=size))

    passages = [text(rng.randint(20, 120)) for _ in range(4)]
    rows = []
    for k in range(n):
        kind = rng.random()
        if kind < 0.4:
            out = text(rng.randint(0, 80))
        elif kind < 0.7:
            out = text(rng.randint(0, 40)) + rng.choice(passages) + text(rng.randint(0, 40))
        elif kind < 0.85 and rows:
            old = (rng.choice(rows)[1] or "").split(" ")
            out = " ".join(w if rng.random() > 0.05 else "x" for w in old)
        else:
            out = rng.choice([("ab" * 150), "a" * 333, "abc" * 40 + "a" * 120, text(10) * 6, ""])
        rows.append((k * 7 % n, out))
    return [*rows, (n, None), (None, passages[0] + "!")]


@pytest.mark.parametrize(
    "seed,options",
    [
        (1, {}),
        (2, {"stretch_bytes": 400, "spread": 1}),
        (3, {"stretch_bytes": 3000, "spread": 0, "sorted_bytes": 500}),
        (4, {"length": 40, "window": 20, "crowd": 2}),
        (5, {"length": 37, "window": 29, "stretch_bytes": 200, "spread": 2, "sorted_bytes": 200}),
    ],
)
def test_same_as_all_strings(spark, seed, options):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = plain_cut(rows, options.get("length", pp.LENGTH))
    assert got(docs, **options) == expected
    assert any(row[2] for row in expected)


def test_planted_passage(spark):
    """A passage goes from all documents but the first; what surrounds it stays."""
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh ", k=300))
    rows = [(k, f"{k * 7919}" + "".join(rng.choices("abcdefgh ", k=150)) + passage + f"#{k}end") for k in range(40)]
    kept = {r.doc_id: r.kept.decode() for r in pp.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(7), with_kept=True).collect()}
    assert kept[0] == rows[0][1]
    assert all(len(text) - 10 < len(kept[k]) + 300 <= len(text) + 10 for k, text in rows[1:])


def test_awkward_tables(awkward, nothing):
    rows = [(row.doc_id, row.text) for row in awkward.select("doc_id", "text").collect()]
    out = got(awkward)
    assert len(out) == len(rows) and got(nothing) == []
    # Ids that occur once are as in the plain version, wherever the tied ones stand.
    plain = {row[0]: row for row in plain_cut([r for r in rows if r[0] not in (8, 9, None)], 100)}
    assert {row[0]: row for row in out if row[0] in plain} == plain
    twins = [row for row in out if row[0] == 9]
    assert len(twins) == 2 and twins[0] == twins[1] and twins[0][2] == 0


def test_rows_of_one_id(spark):
    a, b = "one text " * 3 + "x" * 5 + "".join(map(str, range(200))), "".join(map(str, range(200)))
    docs = spark.createDataFrame([(1, a), (1, b), (1, a), (2, b)], "doc_id long, text string").repartition(4)
    out = pp.remove_repeats(docs).collect()
    first = {r.n_bytes: r.n_removed for r in out if r.doc_id == 1}
    assert sorted(bool(v) for v in first.values()) == [False, True]  # one of both texts is first
    assert [r.n_removed for r in out if r.doc_id == 2] == [len(b)]


def test_triggers_depend_on_content_alone():
    rng = np.random.default_rng(7)
    text = rng.integers(0, 4, 3000).astype(np.uint8)
    here = pp.triggers(text, 64)
    there = pp.triggers(text[500:], 64)
    common = len(there) - 72
    assert (here[500 : 500 + common] - 500 == there[:common]).all()
    assert (here[:common] - np.arange(common) < 64).all()


def test_suffix_array():
    rng = random.Random(8)
    contexts = [bytes(rng.choices(b"ab", k=rng.randint(20, 60))) for _ in range(50)]
    order, at = np.array([k % 13 for k in range(50)]), np.array([1000 * (k // 13) for k in range(50)])
    first: dict[bytes, tuple] = {}
    places = [
        (int(order[c]), int(at[c]) + p, c, p) for c in range(50) for p in range(len(contexts[c]) - 12 + 1)
    ]
    for o, a, c, p in sorted(places):
        first.setdefault(contexts[c][p : p + 12], (o, a))
    expected = {(c, p) for o, a, c, p in places if first[contexts[c][p : p + 12]] != (o, a)}
    assert set(map(tuple, pp.repeated_suffixes(contexts, order, at, 12).tolist())) == expected
