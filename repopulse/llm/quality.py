"""Quality classifier as a sparse ensemble of rules (operator 7).

Statistics of the text are Spark columns. Shallow boosted trees over a bounded sample
of labelled documents suggest rules: each path from the root to a node is a conjunction
of thresholds. A logistic model with a lasso penalty weighs the rules and drops most,
and the rest is compiled to one Spark column, so scoring needs no Python.

Training takes at most about ``sample_rows`` labelled documents, those with the
smallest hashes of ``doc_id``; this bound is the only sampling. Defined cases: a null
text is the empty text, whose statistics are all zero; it is scored like any other.
Documents without label are scored only; a label without document, or null, is left
out; a document with several labels counts once for each. With no labelled document,
or one class only, the score is the share of label 1 (0.5 without labels). A null
``doc_id`` is never held out and stays null. Columns of ``docs`` other than ``doc_id``
and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.common import texts_of

SAMPLE_ROWS = 20_000
ACCEPT = 0.3
TREES, DEPTH, CUTS = 24, 3, 32
LASSO = 0.002

Condition = tuple[str, bool, float]  # statistic, True for "above", threshold


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text by name."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / chars

    return {
        "n_chars": F.length(text).cast("double"),
        "n_words": F.size(words).cast("double"),
        "n_lines": F.size(lines).cast("double"),
        "mean_word": F.length(text) / n_words,
        "mean_line": F.length(text) / n_lines,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "upper": share("[A-Z]"),
        "digits": share("[0-9]"),
        "stops": share("[.,;:?]"),
        "bars": share("[|]"),
        "marks": share(r"[!*$%&#@~^|<>{}\[\]=_+/\\]"),
    }


@dataclass
class RuleModel:
    """A logistic model over conjunctions of conditions."""

    rules: list[tuple[tuple[Condition, ...], float]]
    intercept: float

    def column(self, stats: dict[str, Column]) -> Column:
        """The probability of label 1 as a Spark column."""
        logit = F.lit(self.intercept)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for name, above, threshold in conditions:
                holds &= stats[name] > threshold if above else stats[name] <= threshold
            logit += F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-logit))

    def score(self, rows: np.ndarray, names: list[str]) -> np.ndarray:
        logit = np.full(len(rows), self.intercept)
        for conditions, weight in self.rules:
            logit += weight * _holds(conditions, rows, names)
        return 1.0 / (1.0 + np.exp(-logit))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def with_statistics(docs: DataFrame, *kept: str) -> tuple[DataFrame, list[str]]:
    stats = statistics(F.col("text"))
    frame = docs.select("doc_id", *kept, *(c.alias(f"_{name}") for name, c in stats.items()))
    return frame, list(stats)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Learn from labelled documents that are not held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int"))
        .where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out())
    )
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    share = min(1.0, sample_rows / max(1, known.count()))
    # About ``sample_rows`` ids: a bounded broadcast, so texts stay where they are.
    sample = known.where(place < int(share * (1 << 30))).select(
        F.col("doc_id").alias("_id"), "quality"
    )
    found = texts_of(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    frame, names = with_statistics(found, "quality")
    rows = frame.select("doc_id", "quality", *(f"_{n}" for n in names)).collect()
    rows.sort(key=lambda row: tuple(row))
    values = np.array([row[2:] for row in rows], dtype=np.float64).reshape(-1, len(names))
    good = np.array([row["quality"] == 1 for row in rows], dtype=bool)
    return train(values, good, names)


def score_documents(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``."""
    frame, names = with_statistics(texts_of(docs).withColumn("held_out", held_out()), "held_out")
    score = model.column({name: F.col(f"_{name}") for name in names})
    return frame.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int")
    )


def accepted(docs: DataFrame, model: RuleModel) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the model does not reject."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.where(model.column(statistics(text)) >= ACCEPT)


def train(values: np.ndarray, good: np.ndarray, names: list[str]) -> RuleModel:
    if not len(good) or good.all() or not good.any():
        share = float(good.mean()) if len(good) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return RuleModel([], float(np.log(share / (1 - share))))
    rules = _suggest(values, good, names)
    matrix = np.stack([_holds(rule, values, names) for rule in rules], axis=1).astype(np.float64)
    weights, intercept = _lasso(matrix, good)
    used = np.flatnonzero(weights)
    return RuleModel([(rules[i], float(weights[i])) for i in used], intercept)


def _holds(conditions, values: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(values), dtype=bool)
    for name, above, threshold in conditions:
        column = values[:, names.index(name)]
        out &= column > threshold if above else column <= threshold
    return out


def _suggest(values: np.ndarray, good: np.ndarray, names: list[str]) -> list[tuple]:
    """Paths of boosted trees, each tree on its own half of the rows."""
    cuts = [
        np.unique(np.quantile(values[:, j], np.linspace(0, 1, CUTS + 2)[1:-1]))
        for j in range(len(names))
    ]
    bins = np.stack([np.searchsorted(c, values[:, j]) for j, c in enumerate(cuts)], axis=1)
    logit = np.zeros(len(good))
    found: dict[tuple, None] = {}
    chance = np.random.default_rng(7)
    for _ in range(TREES):
        pull = good - 1.0 / (1.0 + np.exp(-logit))
        rows = np.flatnonzero(chance.random(len(good)) < 0.5)
        if not len(rows):
            rows = np.arange(len(good))
        _grow(rows, np.arange(len(good)), (), 0, bins, cuts, pull, logit, names, found)
    return list(found)


def _grow(rows, every, path, depth, bins, cuts, pull, logit, names, found) -> None:
    """Split on the largest gain of squared pull; leaves move the logits of ``every``."""
    best = (1e-9, -1, -1)
    if depth < DEPTH and len(rows) >= 20:
        total, n = pull[rows].sum(), len(rows)
        for j in range(bins.shape[1]):
            width = len(cuts[j]) + 1
            sums = np.bincount(bins[rows, j], pull[rows], minlength=width).cumsum()[:-1]
            sizes = np.bincount(bins[rows, j], minlength=width).cumsum()[:-1]
            enough = (sizes >= 5) & (n - sizes >= 5)
            if not enough.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = sums**2 / sizes + (total - sums) ** 2 / (n - sizes) - total**2 / n
            gain = np.where(enough, gain, -1.0)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), j, at)
    _, j, at = best
    if j < 0:
        if len(rows):
            p = np.clip(1.0 / (1.0 + np.exp(-logit[rows])), 0.02, 0.98)
            logit[every] += np.clip(0.5 * pull[rows].sum() / (p * (1 - p)).sum(), -2, 2)
        return
    for above in (False, True):
        inside = (*path, (names[j], above, float(cuts[j][at])))
        found[tuple(sorted(inside))] = None
        side = bins[:, j] > at if above else bins[:, j] <= at
        _grow(
            rows[side[rows]], every[side[every]], inside, depth + 1,
            bins, cuts, pull, logit, names, found,
        )


def _lasso(matrix: np.ndarray, good: np.ndarray, penalty: float = LASSO, steps: int = 400):
    """Weights of a logistic model with an absolute penalty, by accelerated steps."""
    mean = matrix.mean(axis=0)
    spread = np.maximum(matrix.std(axis=0), 1e-3)
    scaled = (matrix - mean) / spread
    rate = 4.0 * len(good) / (np.linalg.norm(scaled, 2) ** 2 + len(good))
    share = good.mean()
    weights, bias = np.zeros(matrix.shape[1]), float(np.log(share / (1 - share)))
    ahead, ahead_bias, momentum = weights, bias, 1.0
    for _ in range(steps):
        pull = (1.0 / (1.0 + np.exp(-(scaled @ ahead + ahead_bias))) - good) / len(good)
        new = ahead - rate * (scaled.T @ pull)
        new = np.sign(new) * np.maximum(0.0, np.abs(new) - rate * penalty)
        new_bias = ahead_bias - rate * float(pull.sum())
        grown = (1.0 + np.sqrt(1.0 + 4.0 * momentum**2)) / 2.0
        ahead = new + (momentum - 1.0) / grown * (new - weights)
        ahead_bias = new_bias + (momentum - 1.0) / grown * (new_bias - bias)
        weights, bias, momentum = new, new_bias, grown
    weights = weights / spread
    return weights, float(bias - weights @ mean)
