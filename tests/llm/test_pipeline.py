"""The pipeline against its stages' plain versions, and on awkward tables."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry_point
from repopulse.llm import quality
from repopulse.llm.common import stored, table

from .conftest import AWKWARD
from .test_near_dedup import plain_components, plain_dedup
from .test_scans import plain_leaks
from .test_tokens import COLUMNS, check_packing

SF = "/root/testdata/sf0.001"


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_each_stage_does_what_its_plain_version_does(spark):
    docs = table(spark, SF, "documents")
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), name)
        results[name] = before, docs
        if name != "packing":
            assert docs.columns == columns
    before, after = results["quality"]
    model = quality.learn(before, table(spark, SF, "labels"))
    good = quality.score_documents(before, model).where("predicted = 1").collect()
    assert {d for d, _ in rows_of(after)} == {r.doc_id for r in good}
    bad = {r.doc_id for r in table(spark, SF, "labels").where("quality = 0").collect()}
    assert len(bad & {r.doc_id for r in good}) <= 0.1 * len(bad)

    before, after = results["line_dedup"]
    plain = plain_dedup(rows_of(before))
    expected = {(d, t): new for (d, t), (new, _, gone) in plain.items() if not gone or new}
    assert Counter(rows_of(after)) == Counter((d, new) for (d, _), new in expected.items())
    assert after.where("n_chars <> length(text)").count() == 0

    before, after = results["near_dedup"]
    kept = {d for d, _, _, keep in plain_components(rows_of(before)) if keep}
    assert {d for d, _ in rows_of(after)} == kept

    before, after = results["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {d for d, _ in plain_leaks(rows_of(before), items)}
    assert Counter(rows_of(after)) == Counter(r for r in rows_of(before) if r[0] not in leaked)

    before, after = results["packing"]
    pieces = [tuple(r) for r in after.select(*COLUMNS).collect()]
    n, least = check_packing(pieces, rows_of(before), 4096)
    assert n == least
    assert entry_point.queries()["pipeline"](spark, SF).count() == len(pieces)


def test_stages_take_awkward_and_empty_tables(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, SF), name)
            if name != "packing":
                assert out.columns == docs.columns
                assert out.count() <= len(AWKWARD)
            else:
                assert (out.count() > 0) == (docs is awkward)


def test_queries_are_registered():
    names = entry_point.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
