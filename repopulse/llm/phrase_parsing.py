"""Removal of repeated bytes by prefix-free parsing and suffix arrays (operator 12).

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier in the
corpus: in a document of smaller id, or further up in the same one.

1. *Parse.* A rolling hash triggers phrases: a place starts one if its hash is the least of
   a window of ``WINDOW`` places. Every string of ``LENGTH`` bytes has its first trigger at
   the same distance wherever it stands, so equal strings lie alike in the parse. A phrase
   here is the run of starts that share a trigger, together with the bytes that
   strings from them reach, so that the words of the parse which follow it up to the depth
   of ``LENGTH`` are part of it.
2. *Dictionary.* Phrases are known by a hash of their content and meet by a hash of the
   bytes after their trigger, which every string of the phrase contains. A phrase
   alone under its trigger's hash holds no repeat: most of a corpus ends here. Of equal
   phrases all but the first are repeats from end to end.
3. *Suffix array.* Different phrases that share a trigger's bytes are the dictionary proper.
   Their suffixes are sorted to the depth of ``LENGTH`` bytes, together with their places,
   and the first of each run of equal suffixes in corpus order stays; the others are repeats.
4. The spans of each document are joined and its bytes cut.

No group meets in one task whole. Phrases that a task sees more than once are settled there
but for the first. Under a trigger's hash with many different phrases (more than ``SPREAD``
in a task's stretch of text, or ``CROWD`` in all) strings are compared one by one, by
128-bit hashes after the same settling in the task, so that they spread over all tasks.

Defined cases: a null text is the empty text. A null ``doc_id`` comes after all others.
Rows of equal ``doc_id`` are ordered by a hash of their text; rows equal in both are one
document, and each gets its result. Texts shorter than ``LENGTH`` bytes stay whole. A very
long text is parsed in stretches; where a stretch cuts a phrase, its halves meet the whole
ones in the suffix array. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.common import stored

LENGTH = 100
WINDOW = 64
SPREAD = 3
CROWD = 5_000
STRETCH = 1 << 20
SORTED_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
PLAIN, SURE, APART, SIGNAL = range(4)
REPEAT, SHARED, CROWDED = range(1, 4)

_UNITS = "route long, content long, doc long, tie long, at int, n int, kind byte"
_SUFFIXES = "route long, other long, doc long, tie long, at int, n int, kind byte, bytes binary"
_SPANS = "doc long, tie long, at int, n int"
_CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


# -- parsing -------------------------------------------------------------------------


def triggers(data: np.ndarray, window: int) -> np.ndarray:
    """For each place the first trigger at or after it: the least hash of its window."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data)]
    hashes = np.ascontiguousarray(words).view("<u8").ravel() * _ODD
    hashes ^= hashes >> np.uint64(29)
    hashes *= _ODD
    # The place in the low half lets the leftmost of equal hashes win.
    low = np.uint64(32)
    least = (hashes >> low << low) | np.arange(len(data), dtype=np.uint64)
    span = 1
    while span < window and len(least) > 1:
        step = min(span, window - span, len(least) - 1)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Stretch:
    """Stretches of documents side by side, parsed together."""

    def __init__(self, length: int = LENGTH, window: int = WINDOW):
        self.length, self.window = length, window
        self.parts: list[bytes] = []
        self.of: list[tuple[int, int, int]] = []  # doc, tie, where the part starts in it
        self.size = 0

    def add(self, doc: int, tie: int, start: int, part: bytes) -> None:
        self.parts.append(part)
        self.of.append((doc, tie, start))
        self.size += len(part)

    def phrases(self) -> dict[str, np.ndarray]:
        """Trigger hash, content hash, part, start in the document and number of starts."""
        text = b"".join(self.parts)
        sizes = np.fromiter(map(len, self.parts), np.int64, len(self.parts))
        ends = np.cumsum(sizes)
        trigger = triggers(np.frombuffer(text, np.uint8), self.window)
        part = np.repeat(np.arange(len(sizes)), sizes)[: len(trigger)]
        whole = np.arange(len(trigger)) + self.length <= ends[part]
        turn = np.ones(len(trigger), bool)
        turn[1:] = (trigger[1:] != trigger[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(turn)
        starts = np.add.reduceat(whole.astype(np.int64), first) if len(first) else first
        first, starts = first[starts > 0], starts[starts > 0]
        digest, reach, key = xxhash.xxh3_64_intdigest, self.length - 1, self.length - self.window + 1
        keys = np.fromiter((digest(text[t : t + key]) for t in trigger[first].tolist()), np.uint64, len(first))
        content = np.fromiter(
            (digest(text[a : a + n + reach], 1) for a, n in zip(first.tolist(), starts.tolist())),
            np.uint64,
            len(first),
        )
        part = part[first]
        begins = np.fromiter((o[2] for o in self.of), np.int64, len(self.of)) - (ends - sizes)
        return {"key": keys, "content": content, "part": part, "at": first + begins[part], "n": starts}

    def order(self) -> np.ndarray:
        """Rank of each part's document in the corpus order; parts of one are equal."""
        _, rank = np.unique(np.array([o[:2] for o in self.of], np.int64).reshape(-1, 2), axis=0, return_inverse=True)
        return rank.reshape(-1)


def _runs(part: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjoining or overlapping spans of a part as one."""
    if not len(part):
        return part, at, n
    order = np.lexsort((at, part))
    part, at, end = part[order], at[order], (at + n)[order]
    base = part * (int(end.max()) + 1)  # spans of different parts are kept apart
    reached = np.maximum.accumulate(base + end)
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (base[1:] + at[1:] > reached[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(part)]]) - 1
    return part[first], at[first], reached[last] - base[first] - at[first]


def _settled(stretch: Stretch, spread: int) -> pa.RecordBatch | None:
    """A stretch's phrases: firsts under their trigger's hash, and what is settled by now."""
    found = stretch.phrases()
    if not len(found["key"]):
        return None
    rank = stretch.order()[found["part"]]
    order = np.lexsort((found["at"], rank, found["content"], found["key"]))
    found, rank = {name: values[order] for name, values in found.items()}, rank[order]
    new_key = np.ones(len(rank), bool)
    new_key[1:] = found["key"][1:] != found["key"][:-1]
    new = new_key.copy()
    new[1:] |= found["content"][1:] != found["content"][:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(rank)), 0))
    twin = (rank == rank[head]) & (found["at"] == found["at"][head]) & ~new  # a row read twice
    different = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
    apart = new & (different > spread)
    signal = new_key & (different > spread)
    sure = ~new & ~twin

    part, at, n = _runs(found["part"][sure], found["at"][sure], found["n"][sure])
    columns: dict[str, list[np.ndarray]] = {name: [] for name in ("route", "content", "part", "at", "n", "kind")}

    def add(kind: int, key, content, part, at, n) -> None:
        for name, values in zip(columns, (key, content, part, at, n, np.full(len(at), kind, np.int8))):
            columns[name].append(values)

    def dealt(part: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Any place will do: settled rows are spread by where they stand."""
        doc = np.array([o[0] for o in stretch.of], np.int64).astype(np.uint64)
        return (doc[part] * _ODD + at.astype(np.uint64)) * _ODD

    for kind, rows in ((PLAIN, new & ~apart), (APART, apart), (SIGNAL, signal)):
        own = {name: values[rows] for name, values in found.items()}
        key = dealt(own["part"], own["at"]) if kind == APART else own["key"]
        add(kind, key, own["content"], own["part"], own["at"], own["n"])
    add(SURE, dealt(part, at), np.zeros(len(at), np.uint64), part, at, n)

    joined = {name: np.concatenate(values) for name, values in columns.items()}
    where = np.array([o[:2] for o in stretch.of], np.int64)[joined["part"]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(joined["route"].view(np.int64)),
            pa.array(joined["content"].view(np.int64)),
            pa.array(where[:, 0]),
            pa.array(where[:, 1]),
            pa.array(joined["at"], pa.int32()),
            pa.array(joined["n"], pa.int32()),
            pa.array(joined["kind"], pa.int8()),
        ],
        names=["route", "content", "doc", "tie", "at", "n", "kind"],
    )


def _parsed(docs: DataFrame, length: int, window: int, spread: int, stretch_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = Stretch(length, window)
        for batch in batches:
            ids = zip(batch.column("doc").to_pylist(), batch.column("tie").to_pylist())
            for (doc, tie), value in zip(ids, batch.column("bytes")):
                text = value.as_py()
                for start in range(0, max(1, len(text) - length + 1), stretch_bytes):
                    stretch.add(doc, tie, start, text[start : start + stretch_bytes + length - 1])
                    if stretch.size >= stretch_bytes:
                        if (rows := _settled(stretch, spread)) is not None:
                            yield rows
                        stretch = Stretch(length, window)
        if stretch.size and (rows := _settled(stretch, spread)) is not None:
            yield rows

    return docs.where(F.length("bytes") >= length).select("doc", "tie", "bytes").mapInArrow(run, _UNITS)


def _judged(units: DataFrame, crowd: int) -> DataFrame:
    """``doc, tie, at, n`` and what they are: repeats, shared phrases, or crowded ones."""
    settled = F.col("kind").isin(SURE, APART)
    units = units.withColumn("settled", settled)
    equal = Window.partitionBy("route", "settled", "content").orderBy("doc", "tie", "at")
    met = Window.partitionBy("route", "settled")
    kind, first = F.col("kind"), F.col("nth") == 1
    crowded = (F.col("signals") > 0) | (F.col("met") > crowd)
    return (
        units.withColumn("nth", F.rank().over(equal))
        .withColumn("met", F.count(F.lit(1)).over(met))
        .withColumn("differ", F.min("content").over(met) != F.max("content").over(met))
        .withColumn("signals", F.max(F.when(kind == SIGNAL, 1).otherwise(0)).over(met))
        .select(
            "doc", "tie", "at", "n",
            F.when(kind == SURE, REPEAT)
            .when(kind == APART, CROWDED)
            .when((kind == PLAIN) & ~first, REPEAT)
            .when((kind == PLAIN) & crowded, CROWDED)
            .when((kind == PLAIN) & F.col("differ"), SHARED)
            .alias("what"),
        )
        .where(F.col("what").isNotNull())
    )


# -- suffixes ------------------------------------------------------------------------


def _spelled(joined: DataFrame, length: int, window: int) -> DataFrame:
    """Shared phrases with their bytes, and the strings of crowded ones by their hashes.

    ``joined`` has a document's ``doc``, ``tie``, ``bytes`` and its ``spans``.
    """
    key = length - window + 1

    def rows_of(doc: int, tie: int, text: bytes, spans) -> Iterator[tuple]:
        for span in spans:
            at, n = span["at"], span["n"]
            context = text[at : at + n + length - 1]
            if span["what"] == SHARED:
                # The trigger of the first start is that of all.
                b = int(triggers(np.frombuffer(context[: window + 7], np.uint8), window)[0])
                yield _signed(xxhash.xxh3_64_intdigest(context[b : b + key])), 0, doc, tie, at, n, SHARED, context
            else:
                for p in range(n):
                    pair = xxhash.xxh3_128_intdigest(context[p : p + length])
                    yield _signed(pair >> 64), _signed(pair & (1 << 64) - 1), doc, tie, at + p, 1, CROWDED, None

    def run(batches):
        for batch in batches:
            held: list[tuple] = []
            firsts: dict[tuple[int, int], int] = {}
            for doc, tie, text, spans in zip(
                batch.column("doc").to_pylist(), batch.column("tie").to_pylist(),
                batch.column("bytes"), batch.column("spans"),
            ):
                if not spans.is_valid:
                    continue
                for row in rows_of(doc, tie, text.as_py(), spans.as_py()):
                    if row[6] == CROWDED:
                        # Of equal strings here the first goes on, the others are settled.
                        known = firsts.setdefault(row[:2], len(held))
                        if known < len(held):
                            old = held[known]
                            if row[2:5] == old[2:5]:
                                continue
                            if row[2:5] < old[2:5]:
                                held[known], row = row, old
                            row = (_signed(row[2] * 31 + row[4]), 0, *row[2:6], REPEAT, None)
                    held.append(row)
                if len(held) > 20_000:
                    yield _suffix_batch(held)
                    held, firsts = [], {}
            if held:
                yield _suffix_batch(held)

    return joined.mapInArrow(run, _SUFFIXES)


def _signed(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def _suffix_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int8(), pa.binary()]
    names = ["route", "other", "doc", "tie", "at", "n", "kind", "bytes"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def repeated_suffixes(contexts: list[bytes], order: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """(context, offset) of every suffix that an earlier one equals in its first ``length`` bytes.

    ``order`` ranks the contexts' documents and ``at`` is where they start. The suffix array
    is sorted by big-endian words of eight bytes, then by place in the corpus.
    """
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    begins = np.cumsum(sizes) - sizes
    starts = sizes - length + 1
    context = np.repeat(np.arange(len(contexts)), starts)
    offset = np.arange(len(context)) - np.repeat(np.cumsum(starts) - starts, starts)
    text = np.frombuffer(b"".join(contexts) + bytes(8), np.uint8)
    place = begins[context] + offset
    words = np.lib.stride_tricks.sliding_window_view(text, 8)
    cuts = [*range(0, length - 7, 8)] + ([length - 8] if length % 8 else [])
    columns = [np.ascontiguousarray(words[place + cut]).view(">u8").ravel().astype(np.uint64) for cut in cuts]
    corpus = order[context] * (int(at.max()) + int(sizes.max()) + 1) + at[context] + offset
    array = np.lexsort((corpus, *reversed(columns)))
    new = np.zeros(len(array), bool)
    new[:1] = True
    for column in columns:
        ranked = column[array]
        new[1:] |= ranked[1:] != ranked[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(array)), 0))
    later = corpus[array] != corpus[array][head]
    return np.stack([context[array][later], offset[array][later]], axis=1)


def _compared(suffixes: DataFrame, length: int, sorted_bytes: int) -> DataFrame:
    """Spans that repeat earlier ones: by suffix arrays, and by order among equal hashes."""
    routed = suffixes.repartition("route").sortWithinPartitions("route", "other", "doc", "tie", "at")

    def sorted_spans(table: pa.Table) -> pa.RecordBatch:
        ids = np.stack([table.column(c).to_numpy() for c in ("doc", "tie")], axis=1)
        at = table.column("at").to_numpy().astype(np.int64)
        _, rank = np.unique(ids, axis=0, return_inverse=True)
        contexts = [value.as_py() for value in table.column("bytes")]
        later = repeated_suffixes(contexts, rank.reshape(-1), at, length)
        context, offset, n = _runs(later[:, 0], later[:, 1], np.ones(len(later), np.int64))
        return _spans(ids[context, 0], ids[context, 1], at[context] + offset, n)

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            sure = batch.filter(pa.array(kind == REPEAT))
            if sure.num_rows:
                yield _spans(*(sure.column(c).to_numpy() for c in ("doc", "tie", "at", "n")))
            strings = batch.filter(pa.array(kind == CROWDED))
            if strings.num_rows:
                rows = np.stack([strings.column(c).to_numpy() for c in ("route", "other", "doc", "tie", "at")], axis=1).astype(np.int64)
                if last is not None:
                    rows = np.concatenate([last[None], rows])
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
                head = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
                later = (rows[:, 2:] != rows[head, 2:]).any(axis=1)
                last = rows[head[-1]]
                if later.any():
                    yield _spans(rows[later, 2], rows[later, 3], rows[later, 4], np.ones(int(later.sum()), np.int64))
            shared = batch.filter(pa.array(kind == SHARED))
            if shared.num_rows:
                held.append(shared)
                size += shared.column("bytes").nbytes
            if size >= sorted_bytes:
                table = pa.Table.from_batches(held)
                route = table.column("route").to_numpy()
                whole = int(np.searchsorted(route, route[-1]))  # the last group may go on
                if whole:
                    yield sorted_spans(table.slice(0, whole))
                    held = table.slice(whole).combine_chunks().to_batches()
                    size = sum(b.column("bytes").nbytes * b.num_rows // max(1, table.num_rows) for b in held)
        if held:
            yield sorted_spans(pa.Table.from_batches(held))

    return routed.mapInArrow(run, _SPANS)


def _spans(doc, tie, at, n) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(values), kind) for values, kind in zip((doc, tie, at, n), kinds)],
        names=["doc", "tie", "at", "n"],
    )


# -- the operator ----------------------------------------------------------------------


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``bytes`` and the order ``doc``, ``tie``; ties are told apart where there are any."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    number = F.col(id_col).cast("long")
    doc = F.coalesce(number, F.lit((1 << 63) - 1))
    tied = docs.select(doc.alias("doc")).groupBy("doc").count().where("count > 1")
    tie = F.lit(0).cast("long") if tied.isEmpty() else F.xxhash64(text, number.isNull())
    return docs.select(
        number.alias("doc_id"), text.cast("binary").alias("bytes"), doc.alias("doc"), tie.alias("tie")
    )


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_kept: bool = False,
    spread: int = SPREAD,
    crowd: int = CROWD,
    stretch_bytes: int = STRETCH,
    sorted_bytes: int = SORTED_BYTES,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for,
    the ``kept`` bytes of every row."""
    if not 8 <= window <= length - 8:
        raise ValueError("a window needs 8 places, and 8 bytes after its last")
    texts = _identified(docs, id_col, text_col)
    units = _parsed(texts, length, window, spread, stretch_bytes)
    judged = stored(_judged(units, crowd), "phrases", "zstd")

    def with_spans(spans: DataFrame) -> DataFrame:
        """Both joins take the same columns, so that texts are shuffled once."""
        listed = spans.groupBy("doc", "tie").agg(
            F.collect_list(F.struct(*(c for c in spans.columns if c not in ("doc", "tie")))).alias("spans")
        )  # as many as a document has phrases
        return texts.join(listed, ["doc", "tie"], "left").select("doc_id", "bytes", "doc", "tie", "spans")

    open_spans = judged.where(F.col("what") != REPEAT)
    compared = _compared(_spelled(with_spans(open_spans), length, window), length, sorted_bytes)
    repeats = judged.where(F.col("what") == REPEAT).select("doc", "tie", "at", "n")
    return _cut(with_spans(repeats.unionByName(compared)), length, with_kept)


def _cut(joined: DataFrame, length: int, with_kept: bool) -> DataFrame:
    def row_of(doc_id, text: bytes, spans) -> tuple:
        removed, n_spans, kept, upto = 0, 0, [], 0
        if spans:
            at = np.array([s["at"] for s in spans], np.int64)
            n = np.array([s["n"] for s in spans], np.int64) + length - 1
            _, at, n = _runs(np.zeros(len(at), np.int64), at, n)
            n_spans, removed = len(at), int(n.sum())
            for a, size in zip(at.tolist(), n.tolist()):
                kept.append(text[upto:a])
                upto = a + size
        kept.append(text[upto:])
        left = b"".join(kept)
        return doc_id, len(text), removed, n_spans, hashlib.sha256(left).hexdigest(), left

    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    width = len(names) if with_kept else len(names) - 1

    def run(batches):
        for batch in batches:
            values = zip(batch.column("doc_id").to_pylist(), batch.column("bytes"), batch.column("spans"))
            rows = [row_of(doc_id, text.as_py(), spans.as_py())[:width] for doc_id, text, spans in values]
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names[:width])

    return joined.mapInArrow(run, _CUT + (", kept binary" if with_kept else ""))
