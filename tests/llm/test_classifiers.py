"""Held-out accuracy, defined cases, and compiled rules against numpy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.llm import language, quality
from repopulse.llm.common import table, texts_of
from repopulse.llm.queries import QUERIES

from .conftest import AWKWARD

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF, "documents")


def test_language_of_held_out_documents(spark, documents):
    rows = QUERIES["op6_hierarchical_language"](spark, SF).join(
        documents.select("doc_id", "lang"), "doc_id"
    ).collect()
    assert len(rows) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_languages_of_awkward_documents(spark, documents, awkward, nothing):
    model = language.learn(documents)
    rows = language.predict_language(awkward, model).collect()
    assert len(rows) == len(AWKWARD)
    und = sum(r.lang_pred == "und" for r in rows)
    assert und == sum(not language.has_letter(t or "") for _, t in AWKWARD)
    assert language.predict_language(nothing, model).count() == 0
    empty = language.learn(nothing)
    assert {r.lang_pred for r in language.predict_language(awkward, empty).collect()} == {"und"}
    one = language.learn(awkward)
    assert {r.lang_pred for r in language.predict_language(awkward, one).collect()} == {"en", "und"}


def test_the_sample_of_a_hot_language_is_cut_before_it_is_ranked(spark):
    rows = spark.range(20_000).selectExpr(
        "id AS doc_id", "if(id % 10 < 8, 'en', if(id % 10 = 8, 'de', concat('x', id % 40))) AS lang"
    )
    hashed = rows.selectExpr("doc_id", "lang", "xxhash64(doc_id, 6) AS h").collect()
    for most in (10_000, 100):
        ranked = []
        for lang in {r.lang for r in hashed}:
            own = sorted((r.h, r.doc_id) for r in hashed if r.lang == lang)[:30]
            ranked += [(nth, lang, doc_id) for nth, (_, doc_id) in enumerate(own)]
        expected = {doc_id for *_, doc_id in sorted(ranked)[:most]}
        found = language.sampled_ids(rows, 30, most).collect()
        assert {r._chosen for r in found} == expected


def test_a_long_text_is_read_in_pieces(monkeypatch):
    text = "der die das und nicht mit für " * 200
    found = language.train_model(
        ["de", "en", "fr", "de", "en", "fr"],
        [np.unique(language.grams(t)) for t in (text, "the and of to " * 9, "le la les des " * 9) * 2],
        [np.full(len(np.unique(language.grams(t))), 0.1) for t in (text, "the and of to " * 9, "le la les des " * 9) * 2],
    )
    predictor = language.Predictor(found)
    whole = predictor._margins(text)
    monkeypatch.setattr(language, "CHUNK_CHARS", 1000)
    assert np.allclose(whole, predictor._margins(text), atol=0.02)
    assert predictor.predict(text)[0] == "de"


def test_quality_of_held_out_documents(spark, documents):
    labels = table(spark, SF, "labels")
    rows = QUERIES["op7_rule_ensemble_quality"](spark, SF).join(
        labels.select("doc_id", "quality"), "doc_id"
    ).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.98


def test_compiled_rules_give_the_scores_of_numpy(spark, documents):
    model = quality.learn(documents, table(spark, SF, "labels"))
    assert 0 < len(model.rules) < 200
    frame, names = quality.with_statistics(texts_of(documents))
    values = np.array(
        [row[1:] for row in frame.orderBy("doc_id").collect()], dtype=np.float64
    )
    scores = [r.score for r in quality.score_documents(documents, model).orderBy("doc_id").collect()]
    assert np.allclose(scores, model.score(values, names))


def test_quality_of_awkward_documents(spark, documents, awkward, nothing):
    labels = table(spark, SF, "labels")
    model = quality.learn(documents, labels)
    scored = quality.score_documents(awkward, model).collect()
    assert len(scored) == len(AWKWARD) and all(0 <= r.score <= 1 for r in scored)
    kept = quality.accepted(awkward, model)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(r.predicted for r in scored)
    assert quality.score_documents(nothing, model).count() == 0
    unlabelled = quality.learn(documents, labels.limit(0))
    assert {r.score for r in quality.score_documents(awkward, unlabelled).collect()} == {0.5}
    one_class = quality.learn(documents, labels.where("quality = 1"))
    assert quality.score_documents(awkward, one_class).where("predicted = 0").count() == 0
    odd = labels.limit(3).withColumn("quality", F.lit(None).cast("int"))
    assert quality.learn(documents, odd).rules == []


def test_the_lasso_drops_rules_that_say_nothing():
    chance = np.random.default_rng(3)
    values = chance.random((800, 4))
    good = (values[:, 0] > 0.4) & (values[:, 1] < 0.9)
    model = quality.train(values, good, ["a", "b", "c", "d"])
    used = {name for rule, _ in model.rules for name, _, _ in rule}
    assert {"a", "b"} <= used
    assert ((model.score(values, ["a", "b", "c", "d"]) > 0.5) == good).mean() > 0.95
