"""Vector codes against full measurement in plain loops, and the bounds that spare it."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, vector string"


def plain_codes(rows, parts, entries, rounds, scale):
    """Rows of (vec_id, code, error, label_error) and the digest, by measuring everything."""
    kept = [
        (i, [math.floor(float(np.float32(x)) * scale) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda row: (row[0] is None, row[0], row[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    book = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        assigned = [[nearest(c[p], p)[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for k in range(len(book[p])):
                own = [c[p] for c, a in zip(cut, assigned) if a[p] == k]
                if own:
                    book[p][k] = [sum(xs) // len(own) for xs in zip(*own)]
    final = [[nearest(c[p], p) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in final]
    by_label: dict = {}
    for (_, _, label), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    flat = ",".join(str(x) for part in book for entry in part for x in entry)
    return [
        (i, "".join(f"{k:02x}" for _, k in f), e, by_label[label])
        for (i, _, label), f, e in zip(kept, final, errors)
    ], hashlib.sha256(flat.encode()).hexdigest()


def rows_of(seed, n=300, length=16, spread=0.4):
    rng = random.Random(seed)
    rows = [
        (i * 3 % n, [rng.choice([-1, 0, 1]) * 0.5 + rng.gauss(0, spread) for _ in range(length)], i % 4 or None)
        for i in range(n)
    ]
    rows += [rows[5], rows[5], (None, rows[7][1], 2), (n, None, 1), (n + 1, [math.nan] + [0.0] * 15, 1)]
    rows += [(n + 2, [None] + [0.0] * 15, None), (n + 3, [math.inf] + [0.0] * 15, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", "z") for row in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("seed,length,share", [(1, 16, 0.2), (2, 8, 0.0), (3, 32, 1.0)])
def test_same_as_measuring_everything(spark, seed, length, share):
    rows = [(i, v and (v * 2)[:length], label) for i, v, label in rows_of(seed)]
    got = vc.vector_codes(frame(spark, rows), rewrite_share=share).collect()
    expected, digest = plain_codes(rows, vc.PARTS, vc.ENTRIES, vc.ROUNDS, vc.SCALE)
    assert {row.codebooks_sha256 for row in got} == {digest}
    plain = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str)
    assert plain == sorted(expected, key=str)


def test_few_vectors_and_other_shapes(spark):
    rows = [(3, [0.1, 0.2], 1), (1, [0.3, -0.2], 1), (2, [0.3, -0.2], None)]
    got = vc.vector_codes(frame(spark, rows), parts=2).collect()
    expected, digest = plain_codes(rows, 2, 16, vc.ROUNDS, vc.SCALE)
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(expected)
    assert {row.codebooks_sha256 for row in got} == {digest}


def test_odd_vectors_have_no_code(spark):
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [1.0] * 16, 1), (4, [9e30] * 8, 2), (5, [0.5] * 3, 2)]
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in vc.vector_codes(frame(spark, rows)).collect()}
    assert got[1] == ("00" * 8, 0, 0) and got[2] == ("01" * 8, 0, 0) and got[3] == (None, None, 0)
    assert got[4] == got[5] == (None, None, None)


def test_empty_table(spark):
    assert vc.vector_codes(frame(spark, [(1, [0.5] * 8, 1)]).limit(0)).count() == 0
    assert vc.vector_codes(frame(spark, [(1, [], 1)])).count() == 1
    assert vc.vector_codes(frame(spark, [(1, None, 1)])).count() == 0


def test_bounds_spare_measuring(spark):
    """Clustered vectors settle: later rounds measure few parts, whatever is written anew."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (16, 16))
    rows = [(i, (centres[i % 16] + rng.normal(0, 0.02, 16)).tolist(), 0) for i in range(800)]
    vectors = vc._whole_vectors(frame(spark, rows), 4096, "vec_id", "embedding", "label")
    for share in (0.2, 1.0):
        measures: list[float] = []
        vc.train(vectors, rewrite_share=share, measures=measures)
        assert len(measures) == vc.ROUNDS and measures[0] == 0 and max(measures[3:]) < 0.05


def test_net_displacement_is_tighter_than_drift():
    """An entry that moves and comes back leaves its bounds as they were."""
    there, back = np.zeros((1, 2, 2), np.int64), np.zeros((1, 2, 2), np.int64)
    there[0, 0] = 1000
    books = vc.Codebooks([back, there, back])
    moved, others = books.displacements()
    assert moved[0].max() == 0 and others[0].max() == 0 and moved[1, 0, 0] > 1414


def test_decoded_codes_are_as_far_as_their_error(spark):
    rows = [row for row in rows_of(9) if row[1] and all(x is not None and math.isfinite(x) for x in row[1])]
    vectors = vc._whole_vectors(frame(spark, rows), vc.SCALE, "vec_id", "embedding", "label")
    table, books, length = vc.train(vectors)
    coded = vc._coded(table, books, length).where("vec_id is not null").orderBy("vec_id", "code").collect()
    whole = vectors.where(F.col("vec_id").isNotNull()).collect()
    near = {(r.vec_id, tuple(r.vector)) for r in whole}
    for row, entry in zip(coded, vc.decoded([r.code for r in coded], books.now)):
        own = [np.array(v) for i, v in near if i == row.vec_id]
        assert any(int(((v - entry) ** 2).sum()) == row.error for v in own)
