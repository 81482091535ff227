"""Near duplicates and line dedup against comparing all pairs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.llm import hyperminhash, line_dedup, near_dedup
from repopulse.llm.components import components
from repopulse.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import connect, oracle_rows, spark_rows

from .conftest import AWKWARD, keyed

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    connection = connect(SF)
    names, rows = spark_rows(QUERIES[name](spark, SF))
    expected_names, expected = oracle_rows(connection, ORACLE[name])
    assert names == expected_names and rows == expected and rows


def plain_components(rows):
    """(doc_id, size, component, kept) by comparing all pairs of rows."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        span = min(5, len(words))
        sets.append({tuple(words[k : k + span]) for k in range(len(words) - span + 1)} if words else set())
    # Rows without a number are linked with nothing.
    known = [i for i, (doc_id, _) in enumerate(rows) if doc_id is not None]
    lowest = {i: rows[i][0] for i in known}
    moved = True
    while moved:
        moved = False
        for i in known:
            for j in known:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 75 * len(sets[i] | sets[j]) and lowest[i] < lowest[j]:
                    lowest[j], moved = lowest[i], True
    return [
        (doc_id, len(sets[i]), lowest.get(i), doc_id is None or lowest[i] == doc_id)
        for i, (doc_id, _) in enumerate(rows)
    ]


def test_awkward_documents(spark, awkward, nothing):
    found = near_dedup.find_near_duplicates(awkward).collect()
    assert keyed(found) == keyed(plain_components(AWKWARD))
    assert near_dedup.find_near_duplicates(nothing).count() == 0
    kept = near_dedup.keep_one_each(awkward)
    assert kept.columns == awkward.columns
    # Rows of one number go together: 6 copies 1, 11 nearly copies 10.
    expected = Counter(d for d, _ in AWKWARD if d not in (6, 11))
    assert Counter(r.doc_id for r in kept.collect()) == expected


def test_chains_stars_and_large_groups(spark):
    """A group of edited copies whose members are often unlike each other."""
    chance = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for at in chance.sample(range(120), chance.choice([0, 1, 2, 3])):
            words[at] = f"edit{k}x{at}"
        rows.append((k * 3, " ".join(words)))
    for k in range(60):  # a chain: each drops some words of the one before
        rows.append((1000 + k, " ".join(f"c{j}" for j in range(4 * k, 4 * k + 100))))
    for k in range(40):  # half of the text is one passage: no links
        rows.append((2000 + k, " ".join(base[:60] + [f"own{k}x{j}" for j in range(60)])))
    chance.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = near_dedup.find_near_duplicates(docs).collect()
    assert keyed(found) == keyed(plain_components(rows))


def test_slices_of_a_bucket_meet_each_other(spark, monkeypatch):
    """Groups cut into many slices give the links of one slice."""
    monkeypatch.setattr(near_dedup, "SLICE_SHINGLES", 20_000)
    monkeypatch.setattr(near_dedup, "COLUMNS_AT_ONCE", 64)
    test_chains_stars_and_large_groups(spark)


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 300)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {k: 0 for k in [*range(41), 300]} | {k: 100 for k in range(100, 130)}
    assert {r.node: r.component for r in found} == expected


def test_estimates_are_near_the_truth():
    chance = np.random.default_rng(5)
    for share in (0.2, 0.5, 0.75, 0.95):
        found = []
        for _ in range(60):
            n = 2000
            pool = chance.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
            common = int(2 * n * share / (1 + share))
            a, b = pool[:n], pool[n - common : 2 * n - common]
            sketches = [hyperminhash.registers(x)[None, :] for x in (a, b)]
            found.append(hyperminhash.estimate(*sketches, np.array([n]), np.array([n]))[0][0])
        assert abs(np.mean(found) - share) < 0.03
    # A small set fills all registers with its own.
    assert len(set(hyperminhash.registers(np.array([3, 900], dtype=np.uint64)).tolist())) == 2


def test_small_sets_share_bands_as_they_share_elements():
    chance = np.random.default_rng(6)
    for small, large in ((3, 4), (6, 8), (30, 40)):
        hits = []
        for _ in range(300):
            pool = chance.integers(0, 1 << 63, large, dtype=np.uint64) * np.uint64(2)
            a, b = (hyperminhash.bands(hyperminhash.registers(x)) for x in (pool[:small], pool))
            hits.append((a == b).sum())
        assert abs(np.mean(hits) / hyperminhash.BANDS - 0.75**hyperminhash.BAND_ROWS) < 0.04
        assert min(hits) > 0


def plain_dedup(rows, min_words=4):
    """Texts by row, every run compared with all that came before, quadratic."""
    ordered = sorted(
        {(d, t) for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, str(r[1]))
    )
    seen, out = set(), {}
    for doc_id, text in ordered:
        lines = (text or "").split("\n")
        own = [(k, line) for k, line in enumerate(lines) if line.split()]
        gone, new = set(), []
        for a in range(len(own)):
            for b in range(a, min(len(own), a + min_words)):
                run = tuple(line for _, line in own[a : b + 1])
                if sum(len(line.split()) for line in run) >= min_words:
                    if run in seen:
                        gone.update(k for k, _ in own[a : b + 1])
                    seen.add(run)
        kept = [line for k, line in enumerate(lines) if k not in gone]
        left = any(line.split() for line in kept)
        out[doc_id, text] = (
            text if not gone else "\n".join(kept) if left else "", len(own), len(gone),
        )
    return out


def check_dedup(spark, docs, rows):
    found = line_dedup.dedup_lines(docs)
    counts = found.columns[-2:]
    before = {}
    for (doc_id, text), result in plain_dedup(rows).items():
        before.setdefault(doc_id, Counter())[result] += sum((d, t) == (doc_id, text) for d, t in rows)
    got = {}
    for row in found.select("doc_id", "text", *counts).collect():
        got.setdefault(row[0], Counter())[tuple(row[1:])] += 1
    assert got == before
    return found


def test_lines_of_awkward_documents(spark, awkward, nothing):
    # The order of two texts with one number is by hash: only one such text has lines seen before.
    found = check_dedup(spark, awkward, AWKWARD)
    assert found.columns == [*awkward.columns, "_n_lines", "_n_removed"]
    assert line_dedup.dedup_lines(nothing).count() == 0
    odd = awkward.where("doc_id = 10").select("text", F.lit(None).cast("long").alias("doc_id"))
    assert line_dedup.dedup_lines(odd).count() == 1


def test_lines_of_random_documents(spark):
    chance = random.Random(8)
    pool = ["a", "b b", "c c c", "d d d d", "e e e e e", "", " ", "f"]
    rows = [
        (k, "\n".join(chance.choices(pool, k=chance.randint(0, 14))) or None) for k in range(120)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_dedup(spark, docs, rows)


def test_line_dedup_plan_is_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
