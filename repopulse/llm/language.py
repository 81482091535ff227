"""Language identification by hierarchical discrimination (operator 6).

A text is the mean of hashed one-, two- and three-letter runs over all its characters.
First its language family is predicted, then one-versus-one linear support vector
machines tell the languages of that family apart; within both steps the votes decide,
and margins break ties. Training takes at most ``per_language`` documents of each
language and ``most_documents`` in all, those with the smallest hashes of ``doc_id``;
these bounds are the only sampling, prediction reads every text in full.

The families are a fixed table; a language that is not in it is a family of its own.
Defined cases: a null text or one without any letter is ``und`` with score 0; with no
labelled row everything is; with one language all other texts are that, score 1. A
null ``doc_id`` is never held out and stays null. Rows with null or empty ``lang`` are
not learned from. Repeated rows are predicted each, other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.common import _arrow_schema, per_row, texts_of
from repopulse.llm.svm import SparseRows, train

PER_LANGUAGE = 600
MOST_SHARES = 10_000  # languages that are cut by share, the largest; the rest are ranked whole
MOST_DOCUMENTS = 12_000
BUCKETS = 1 << 15
CHUNK_CHARS = 500_000

# Families by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "semitic": "am ar he mt",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg ms tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_SCALE = 8.0


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0], lang)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def has_letter(text: str) -> bool:
    return any(match[0].isalpha() for match in _LETTER.finditer(text))


def grams(text: str) -> np.ndarray:
    """Buckets of all one-, two- and three-character runs, non-letters as one blank kind."""
    codes = np.frombuffer(f"  {text.lower()}  ".encode("utf-32-le", "replace"), dtype="<u4")
    codes = np.where((codes > 96) & (codes < 123) | (codes > 169), codes, 32).astype(np.uint32)
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (codes[1:] + np.uint32(77))) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (codes[2:] + np.uint32(177))) * np.uint32(0xC2B2AE35)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    return np.concatenate([one >> shift, two >> shift, three >> shift])


@dataclass
class Separator:
    """A machine between two names; a positive margin speaks for the first."""

    first: str
    second: str
    weights: np.ndarray
    bias: float


@dataclass
class LanguageModel:
    families: dict[str, list[str]]
    family_machines: list[Separator]
    language_machines: dict[str, list[Separator]]

    def machines(self) -> list[Separator]:
        return self.family_machines + [m for ms in self.language_machines.values() for m in ms]


class Predictor:
    def __init__(self, model: LanguageModel):
        self._model = model
        machines = model.machines()
        self._table = (
            np.stack([m.weights for m in machines], axis=1).astype(np.float32)
            if machines
            else np.zeros((BUCKETS, 0), np.float32)
        )
        self._bias = np.array([m.bias for m in machines])

    def predict(self, text: str) -> tuple[str, float]:
        if not self._model.families or not has_letter(text):
            return UNKNOWN, 0.0
        margins = iter(self._margins(text))
        own = [next(margins) for _ in self._model.family_machines]
        inside = {
            family: [next(margins) for _ in machines]
            for family, machines in self._model.language_machines.items()
        }
        family, sure = _vote(sorted(self._model.families), self._model.family_machines, own)
        lang, surer = _vote(
            self._model.families[family], self._model.language_machines[family], inside[family]
        )
        return lang, sure * surer

    def _margins(self, text: str) -> np.ndarray:
        """Means over the whole text, piece by piece; pieces overlap by the run length."""
        total, n = np.zeros(self._table.shape[1]), 0
        for at in range(0, max(1, len(text)), CHUNK_CHARS):
            found = grams(text[at : at + CHUNK_CHARS])
            total += self._table[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return _SCALE * total / n + self._bias


def _vote(names: list[str], machines: list[Separator], margins: list[float]) -> tuple[str, float]:
    if not machines:
        return names[0], 1.0
    votes = dict.fromkeys(names, 0)
    summed = dict.fromkeys(names, 0.0)
    weakest = dict.fromkeys(names, np.inf)
    for machine, margin in zip(machines, margins):
        for name, own in ((machine.first, margin), (machine.second, -margin)):
            votes[name] += own >= 0 if name == machine.first else own > 0
            summed[name] += own
            weakest[name] = min(weakest[name], own)
    best = max(names, key=lambda name: (votes[name], summed[name]))
    return best, float(1.0 / (1.0 + np.exp(-3.0 * np.clip(weakest[best], -10, 10))))


def sampled_ids(labelled: DataFrame, per_language: int, most_documents: int) -> DataFrame:
    """``_chosen``: ids of the first documents of each language, by a hash of the id."""
    spread = F.xxhash64("doc_id", F.lit(6))
    # Of a large language, only ids below a hash are ranked: over twice the sample is below.
    wanted = 2 * per_language + 50
    shares = (
        labelled.groupBy("lang")
        .agg(F.approx_count_distinct("doc_id").alias("_n"))
        .where(F.col("_n") > 2 * wanted)
        .orderBy(F.desc("_n"), "lang")
        .limit(MOST_SHARES)
        .select("lang", (wanted / F.col("_n")).alias("_share"))
    )
    below = (F.coalesce("_share", F.lit(1.0)) - 0.5) * 2.0**64
    in_language = Window.partitionBy("lang").orderBy(spread, "doc_id")
    return (
        labelled.select("doc_id", "lang")
        .join(F.broadcast(shares), "lang", "left")
        .where(spread <= below)
        .select("doc_id", "lang")
        .distinct()
        .withColumn("_nth", F.row_number().over(in_language))
        .where(F.col("_nth") <= per_language)
        .orderBy("_nth", "lang")
        .limit(most_documents)
        .select(F.col("doc_id").alias("_chosen"))
        .distinct()
    )


def learn(
    docs: DataFrame, per_language: int = PER_LANGUAGE, most_documents: int = MOST_DOCUMENTS
) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of documents that are not held out."""
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"
    ).where(~held_out() & (F.coalesce("lang", F.lit("")) != "") & F.col("text").isNotNull())
    chosen = sampled_ids(labelled, per_language, most_documents)
    # The chosen ids are at most ``most_documents``: a bounded broadcast.
    sample = labelled.join(
        F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("_chosen")), "left_semi"
    )

    def counter():
        def rows_of(lang, text):
            found = np.bincount(grams(text), minlength=BUCKETS)
            used = np.flatnonzero(found)
            share = (found[used] / found.sum()).astype("<f4")
            return [(lang, used.astype("<u4").tobytes(), share.tobytes())]

        return rows_of

    rows = per_row(
        sample, "lang string, buckets binary, shares binary", ("lang", "text"), counter
    ).collect()
    return train_model(
        [row["lang"] for row in rows],
        [np.frombuffer(row["buckets"], "<u4") for row in rows],
        [np.frombuffer(row["shares"], "<f4") * _SCALE for row in rows],
    )


def train_model(
    langs: list[str], buckets: list[np.ndarray], values: list[np.ndarray]
) -> LanguageModel:
    families: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        families.setdefault(family_of(lang), []).append(lang)
    own_family = [family_of(lang) for lang in langs]

    def between(labels: list[str], names: list[str]) -> list[Separator]:
        machines = []
        for first, second in combinations(names, 2):
            rows = [i for i, label in enumerate(labels) if label in (first, second)]
            weights, bias = train(
                SparseRows([buckets[i] for i in rows], [values[i] for i in rows], BUCKETS),
                np.array([labels[i] == first for i in rows]),
            )
            machines.append(Separator(first, second, weights, bias))
        return machines

    return LanguageModel(
        families,
        between(own_family, sorted(families)),
        {family: between(langs, members) for family, members in families.items()},
    )


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every document."""
    texts = texts_of(docs).withColumn("held_out", held_out())
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    arrow_schema = _arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(model)
        for batch in batches:
            found = [predictor.predict(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                schema=arrow_schema,
            )

    return texts.mapInArrow(run, schema)
