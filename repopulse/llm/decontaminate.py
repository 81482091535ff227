"""Benchmark decontamination by rare words and local alignment (operator 3).

Words are runs of letters, digits and all beyond ASCII, the text in lower case. A document
holds an item if 75 of 100 of the item's words are matched in one alignment by
Smith-Waterman on words (match 2, mismatch and gap -1), so edited copies are found as well.

One pass over the documents counts how many of them have each word of the test items. An
item's seeds are its rarest words, just so many that what is left is less than 75 of 100:
whatever matches enough of the item has a seed. A second pass aligns the item with the
text around its seeds, as far as an alignment can reach. The counts decide how much is
aligned, never what is found.

Test items are searched in blocks of at most ``block_runs`` words, whatever the size of
the benchmark; only such a block is sent to the tasks.

Defined cases: null or empty texts and items hold nothing. Short items are
searched as well: one of a single word is held by every document that has the word. Items with equal text are found each, so are different texts with one
``item_id``, and items without one (their ``item_id`` in the result is null). Rows with one ``doc_id``
count as one document, null ones too. Other columns are not read. An empty table on
either side gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.common import per_row, texts_of
from repopulse.llm.licenses import words_of

SIMILAR, OF = 75, 100
BLOCK_RUNS = 200_000
MATCH, OTHER = 2, -1
# Words of text per matched word, at most: the score of an alignment is positive.
REACH = 1 - MATCH // OTHER

Items = list[tuple[int | None, list[bytes]]]


def align(item: list, passage: list) -> tuple[int, int, int]:
    """Matched words of the best local alignment and its place in the passage."""
    codes = {word: k for k, word in enumerate(dict.fromkeys(item))}
    text = np.array([codes.get(word, -1) for word in passage])
    steps = np.arange(len(passage) + 1, dtype=np.int32) * -OTHER
    table = np.zeros((len(item) + 1, len(passage) + 1), dtype=np.int32)
    for i, word in enumerate(item, 1):
        above = table[i - 1]
        row = np.maximum(above + OTHER, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(text == codes[word], MATCH, OTHER))
        # A gap along the row: the best earlier cell less its distance.
        table[i] = np.maximum.accumulate(row + steps) - steps
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    end, matched = int(j), 0
    while i and j and table[i, j] > 0:
        equal = item[i - 1] == passage[j - 1]
        if table[i, j] == table[i - 1, j - 1] + (MATCH if equal else OTHER):
            matched += equal
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + OTHER:
            i -= 1
        else:
            j -= 1
    return matched, int(j), end


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, block_runs: int = BLOCK_RUNS, item_col: str = "item_id"
) -> DataFrame:
    """``doc_id``, ``item_id``, ``matched``, ``item_words``, ``similarity``,
    ``first_word``, ``end_word`` of each item that a document holds."""
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    # Words are no more than characters; a block keeps below the bound by that count.
    chars = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = -(-chars // block_runs) or 1
    texts = texts_of(docs)
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        own = [(row["item_id"], words_of(row["text"].lower())) for row in part.orderBy("item_id", "text").collect()]
        leaks = _block_leaks(texts, own)
        found = leaks if found is None else found.union(leaks)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no test item."""
    leaks = find_leaks(docs, benchmark).select(F.col("doc_id").alias("_leaks")).distinct()
    return docs.join(leaks, docs["doc_id"].cast("long").eqNullSafe(leaks["_leaks"]), "left_anti")


def _block_leaks(texts: DataFrame, items: Items) -> DataFrame:
    items = [(item_id, words) for item_id, words in items if words]
    codes = {word: k for k, word in enumerate(dict.fromkeys(w for _, own in items for w in own))}
    often = _documents_with(texts, codes)
    ids = [item_id for item_id, _ in items]
    wanted = [Wanted.of([codes[word] for word in words], often) for _, words in items]

    def finder():
        seeds: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for item, own in enumerate(wanted):
            for code, before, after in own.seeds:
                seeds[code].append((item, before, after))
        is_seed = np.zeros(len(codes) + 1, dtype=bool)  # the last for words of no item
        is_seed[list(seeds)] = True

        def rows_of(doc_id, text):
            words = words_of(text.lower())
            known = np.fromiter((codes.get(word, -1) for word in words), np.int64, len(words))
            at = np.flatnonzero(is_seed[known])
            around: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for place, code in zip(at.tolist(), known[at].tolist()):
                for item, before, after in seeds[code]:
                    around[item].append((max(0, place - before), place + after))
            return [
                (doc_id, item, ids[item], matched, len(wanted[item].words), first + start, first + end)
                for item, spans in around.items()
                for first, last in _joined(spans)
                for matched, start, end in wanted[item].held(known[first:last])
            ]

        return rows_of

    rows = per_row(
        texts,
        "doc_id long, item long, item_id long, matched long, item_words long, first_word long, end_word long",
        ("doc_id", "text"),
        finder,
    )
    # The best alignment of a document and item; the earliest of equals.
    best = F.max(F.struct("matched", -F.col("first_word"), -F.col("end_word"), "item_words"))
    return rows.groupBy("doc_id", "item", "item_id").agg(best.alias("b")).select(
        "doc_id",
        "item_id",
        "b.matched",
        "b.item_words",
        (F.col("b.matched") / F.col("b.item_words")).alias("similarity"),
        (-F.col("b.col2")).alias("first_word"),
        (-F.col("b.col3")).alias("end_word"),
    )


def _documents_with(texts: DataFrame, codes: dict[bytes, int]) -> np.ndarray:
    """How many documents have each of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(codes), dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                found = [codes[w] for w in set(words_of(text.as_py().lower())) if w in codes]
                counts[found] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["code", "n"])

    often = np.zeros(len(codes), dtype=np.int64)
    sums = texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # at most the words of one block
        often[row["code"]] = row["n"]
    return often


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


@dataclass(frozen=True)
class Wanted:
    """An item as codes of words; its seeds with the words that an alignment can have
    before them and from them on."""

    words: list[int]
    needed: int
    seeds: list[tuple[int, int, int]]
    distinct: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, words: list[int], often: np.ndarray) -> Wanted:
        needed = -(-SIMILAR * len(words) // OF)
        distinct, times = np.unique(np.array(words, dtype=np.int64), return_counts=True)
        seeds, left = [], len(words)
        for k in np.lexsort((distinct, often[distinct])).tolist():
            if left < needed:
                break
            code = int(distinct[k])
            places = [place for place, word in enumerate(words) if word == code]
            seeds.append((code, REACH * (places[-1] + 1), REACH * (len(words) - places[0])))
            left -= int(times[k])
        return cls(words, needed, seeds, distinct, times)

    def held(self, passage: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Alignments with enough matched words, and their places in the passage."""
        near = np.minimum(np.searchsorted(self.distinct, passage), len(self.distinct) - 1)
        shared = self.distinct[near] == passage
        sums = np.concatenate([[0], np.cumsum(shared)])
        ends = np.minimum(np.arange(len(passage)) + REACH * len(self.words), len(passage))
        starts = np.flatnonzero(shared & (sums[ends] - sums[:-1] >= self.needed))
        at = 0
        while at < len(starts):
            # Alignments that begin within an item's length of each other go together.
            after = int(np.searchsorted(starts, starts[at] + len(self.words)))
            pieces = [(int(starts[at]), int(ends[starts[after - 1]]))]
            at = after
            while pieces:
                first, last = pieces.pop()
                own = near[first:last][shared[first:last]]
                counts = np.bincount(own, minlength=len(self.times))
                if np.minimum(counts, self.times).sum() < self.needed:
                    continue
                matched, start, end = align(self.words, passage[first:last].tolist())
                if matched >= self.needed:
                    yield matched, first + start, first + end
                else:  # a short passage of better score does not hide what lies beside it
                    pieces += [(first, first + start), (first + end, last)]
