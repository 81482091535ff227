"""Collocations by sorting suffix pointers, routed by their leading words (operator 13).

Every word of a piece of text starts a suffix of at most ``DEPTH`` words; the pointers to
equal beginnings, side by side in sorted order, are the occurrences of a phrase.

1. Words are counted. A word that occurs less than ``min_count`` times is in no phrase
   that does; suffixes are abandoned there. Tasks know the frequent words by a bitmap of
   fixed size, whose false hits let more suffixes through and change no count.
2. Suffixes that agree to the last word collapse into one weighted pointer in each task,
   and pointers are routed by their two leading words, so that all of a phrase's are in
   one place. A pair of words that are both very frequent (each more than a quarter of a
   task's share of all words; at most four times as many words as there are partitions)
   is routed by three words, and its count is added up from the parts.
3. A routed group below ``min_count`` is abandoned unsorted. The rest of a partition is
   sorted, some million pointers at a time, by multikey three-way quicksort: a partition is
   split by its word at the present depth into smaller, equal and greater, the equal part
   goes on at the next depth, and its weight is the count of the phrase so far. Parts
   below ``min_count`` are abandoned.

Counts are exact; scores are computed in decimals of 38 digits, which hold products of
counts up to 10**15. The best phrases of each language are the best of the best of 64 shares of
its phrases, ranked apart.

Words are what lies between blanks and tabs after A-Z are lower-cased and the text is cut
at ``. , ; : ! ?`` and line ends (LF, VT, FF, CR). Defined cases: a null or empty text has
no words; a null ``lang`` counts as ``und``; repeated rows are counted each; a very long
text is taken in stretches that end at a cut. Other columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.common import stored

MIN_COUNT, BEST, DEPTH = 10, 2000, 3
KEPT_SHARE = 50  # a phrase with this percentage of its occurrences in a longer one goes
BITMAP_BITS = 1 << 26
# Words and pointers that a task holds at a time.
HELD_WORDS = 3_000_000
SORTED_POINTERS = 1_000_000
STRETCH = 1 << 20
RANKED_APART = 64

# Blanks, and where pieces end.
_TABLE = bytes(
    ord("\n") if b in b".,;:!?\n\x0b\x0c\r" else ord(" ") if b == ord("\t") else b for b in range(256)
)
_CUT = 1  # the number of a cut among words; 0 is no word


# -- words of a task -----------------------------------------------------------------


class _Words:
    """Texts of one language as numbers of distinct words, with cuts between pieces."""

    def __init__(self):
        number = count()
        self.numbers: dict[bytes, int] = defaultdict(number.__next__)
        assert self.numbers[b""] == 0 and self.numbers[b"\n"] == _CUT
        self.runs: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        plain = text.encode("utf-8", "replace").lower().translate(_TABLE)
        at = 0
        while at < len(plain):
            end = len(plain) if len(plain) - at <= STRETCH else plain.find(b"\n", at + STRETCH) + 1 or len(plain)
            words = plain[at:end].replace(b"\n", b" \n ").split(b" ")
            words.append(b"\n")
            run = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
            run = run[run > 0]
            self.runs.append(run)
            self.size += len(run)
            at = end

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """The running words, and the words by number."""
        running = np.concatenate(self.runs) if self.runs else np.zeros(0, np.int32)
        spelled = np.empty(len(self.numbers), object)
        spelled[:] = list(self.numbers)
        return running, spelled


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, _Words]]:
    by_lang: dict[str, _Words] = defaultdict(_Words)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            words = by_lang[lang]
            size -= words.size
            words.add(text.as_py())
            size += words.size
            if size >= HELD_WORDS:
                yield by_lang
                by_lang, size = defaultdict(_Words), 0
    yield by_lang


def _strings(values) -> pa.Array:
    return pa.array(list(values), pa.binary()).cast(pa.string())


def _pieces_of(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang, text = F.col(lang_col).cast("string"), F.col(text_col).cast("string")
    return docs.where(text.isNotNull()).select(
        F.coalesce(lang, F.lit("und")).alias("lang"), text.alias("text")
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``word`` and ``n``, its occurrences. ``docs`` has ``lang`` and ``text``."""

    def run(batches):
        for by_lang in _held(batches):
            for lang, words in by_lang.items():
                running, spelled = words.taken()
                n = np.bincount(running, minlength=len(spelled))
                n[:2] = 0
                (seen,) = np.nonzero(n)
                if len(seen):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(seen)), _strings(spelled[seen]), pa.array(n[seen])],
                        names=["lang", "word", "n"],
                    )

    found = docs.mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


# -- frequent words as a bitmap --------------------------------------------------------


def _bit(lang: str, word: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b" " + word) % bits


def frequent_bitmap(frequent: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits of the words of ``frequent``: ``bits`` / 8 bytes, however many words there are.

    Tasks send a row per 4,096 bits that are not all clear, which a sum per row joins.
    """

    def run(batches):
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, word in zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist()):
                bit = _bit(lang, word.encode(), bits)
                row = rows.setdefault(bit >> 12, np.zeros(512, np.uint8))
                row[bit >> 3 & 511] |= 1 << (bit & 7)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int32()), pa.array([r.tobytes() for r in rows.values()], pa.binary())],
                names=["row", "bytes"],
            )

    def joined(batches):
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, raw in zip(batch.column("row").to_pylist(), batch.column("bytes").to_pylist()):
                have = rows.setdefault(row, np.zeros(512, np.uint8))
                have |= np.frombuffer(raw, np.uint8)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int32()), pa.array([r.tobytes() for r in rows.values()], pa.binary())],
                names=["row", "bytes"],
            )

    kind = "row int, bytes binary"
    parts = frequent.select("lang", "word").mapInArrow(run, kind).repartition("row").mapInArrow(joined, kind)
    out = np.zeros(-(-bits // 4096) * 512, np.uint8)
    for row in parts.toLocalIterator():  # each row of the bitmap once
        out[row["row"] * 512 : row["row"] * 512 + 512] = np.frombuffer(row["bytes"], np.uint8)
    return out


# -- suffix pointers ------------------------------------------------------------------


def _collapsed(running: np.ndarray, alive: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of two or three words, as numbers (0: ended), and how often each is."""
    if len(running) < 2:
        return np.zeros((0, DEPTH), np.int64), np.zeros(0, np.int64)
    ends = np.concatenate([running, [_CUT, _CUT]]).astype(np.int64)
    good = alive[ends]
    first, second, third = ends[:-2], ends[1:-1], ends[2:]
    starts = good[:-2] & good[1:-1]
    third = np.where(good[2:], third, 0)[starts]
    packed = (first[starts] * n_words + second[starts]) * n_words + third
    leaves, weights = np.unique(packed, return_counts=True)
    words = np.stack([leaves // n_words // n_words, leaves // n_words % n_words, leaves % n_words], axis=1)
    return words, weights


def _pointers(docs: DataFrame, bitmap, bits: int, heavy) -> DataFrame:
    """Weighted suffixes: ``pointer`` is ``w0 w1 w2``, a line end and the language, with
    nothing for ``w2`` where the piece ends, and ``n`` its weight.

    ``bitmap`` and ``heavy`` are broadcast values: frequent words, and (lang, word) pairs
    whose combinations are routed by three words (``split``).
    """

    def run(batches):
        table, very_frequent = bitmap.value, heavy.value
        for by_lang in _held(batches):
            for lang, words in by_lang.items():
                running, spelled = words.taken()
                alive = np.zeros(len(spelled), bool)
                wide = np.zeros(len(spelled), bool)
                for number in range(2, len(spelled)):
                    bit = _bit(lang, spelled[number], bits)
                    if table[bit >> 3] >> (bit & 7) & 1:
                        alive[number] = True
                        wide[number] = (lang, spelled[number]) in very_frequent
                leaves, weights = _collapsed(running, alive, len(spelled))
                split = wide[leaves[:, 0]] & wide[leaves[:, 1]]
                vocabulary = pa.array(spelled, pa.binary())
                for at in range(0, len(leaves), 100_000):
                    rows = slice(at, at + 100_000)
                    three = [vocabulary.take(pa.array(leaves[rows, depth])) for depth in range(DEPTH)]
                    spelt = pc.binary_join_element_wise(*three, b" ")
                    pointer = pc.binary_join_element_wise(spelt, lang.encode(), b"\n")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pointer.cast(pa.string()),
                            pa.array(weights[rows], pa.int32()),
                            pa.array(split[rows]),
                        ],
                        names=["pointer", "n", "split"],
                    )

    return docs.mapInArrow(run, "pointer string, n int, split boolean")


def three_way_quicksort(
    words: np.ndarray, weights: np.ndarray, least: int, spare: np.ndarray | None = None
) -> list[tuple[int, int, int]]:
    """(a pointer, depth, weight) of every phrase of at least ``least`` occurrences.

    ``words`` holds the words of each pointer's suffix as numbers, column by column; 0 ends
    a suffix. Phrases are the words of the pointer up to the depth, from depth 1 on.
    """
    found = []
    depths = words.shape[1]
    todo = [(np.arange(len(words)), 0)]
    while todo:
        pointers, depth = todo.pop()
        weight = int(weights[pointers].sum())
        if weight < least:
            continue  # abandoned: no phrase in it can reach the count
        own = words[pointers, depth]
        if len(pointers) > 2:
            pivot = np.partition(own[[0, len(own) // 2, -1]], 1)[1]
        else:
            pivot = own[0]
        todo.append((pointers[own < pivot], depth))
        todo.append((pointers[own > pivot], depth))
        equal = pointers[own == pivot]
        n = int(weights[equal].sum())
        if pivot and n >= least:
            found.append((int(equal[0]), depth + 1, n))
            if depth + 1 < depths:
                todo.append((equal, depth + 1))
    return found


def _spelled(pointers: pa.Array) -> pa.Table:
    """Language and words of pointers."""
    parts = pc.split_pattern(pointers, "\n", max_splits=1)
    words = pc.split_pattern(pc.list_element(parts, 0), " ")
    columns = {"lang": pc.list_element(parts, 1)}
    return pa.table(columns | {f"w{depth}": pc.list_element(words, depth) for depth in range(DEPTH)})


def _said(rows: pa.Table, depth: int, n: np.ndarray) -> pa.Table:
    third = rows.column("w2").combine_chunks() if depth == 3 else pa.nulls(rows.num_rows, pa.string())
    columns = {name: rows.column(name) for name in ("lang", "w0", "w1")}
    return pa.table(columns | {"w2": third, "n": pa.array(n, pa.int64())})


def _sorted_chunk(chunk: pa.Table, least: int) -> pa.Table | None:
    """Counts of the phrases of whole routed groups; of split groups, pairs as parts."""
    route = chunk.column("route").to_numpy()
    weights = chunk.column("n").to_numpy().astype(np.int64)
    split = chunk.column("split").to_numpy(zero_copy_only=False)
    bounds = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))
    groups = np.diff(np.concatenate([bounds, [len(route)]]))
    totals = np.repeat(np.add.reduceat(weights, bounds), groups)
    pointers = chunk.column("pointer").combine_chunks()
    out: list[pa.Table] = []
    if split.any():
        pairs = _spelled(pointers.filter(pa.array(split))).select(["lang", "w0", "w1"])
        pairs = pairs.append_column("n", pa.array(weights[split]))
        summed = pairs.group_by(["lang", "w0", "w1"]).aggregate([("n", "sum")])
        out.append(_said(summed, 2, summed.column("n_sum").to_numpy()))
    kept = np.flatnonzero(totals >= least)
    if len(kept):
        rows = _spelled(pointers.take(pa.array(kept)))
        columns = []
        for name in rows.column_names:
            values = rows.column(name).combine_chunks()
            numbers = values.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
            if name == "w2":
                numbers[pc.equal(values, "").to_numpy(zero_copy_only=False)] = 0
            columns.append(numbers)
        found = three_way_quicksort(np.stack(columns, axis=1), weights[kept], least)
        for depth in (2, 3):
            hits = np.array([(at, n) for at, d, n in found if d == depth + 1], np.int64).reshape(-1, 2)
            if depth == 2:  # split pairs are added up elsewhere
                hits = hits[~split[kept][hits[:, 0]]]
            if len(hits):
                out.append(_said(rows.take(pa.array(hits[:, 0])), depth, hits[:, 1]))
    return pa.concat_tables(out).combine_chunks() if out else None


def phrase_counts(pointers: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """``lang, w0, w1, w2, n``: phrases of two words (``w2`` null) and three, ``least`` or more."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= SORTED_POINTERS:
                table = pa.Table.from_batches(held).combine_chunks()
                route = table.column("route").to_numpy()
                whole = int(np.searchsorted(route, route[-1]))  # the last group may go on
                if whole:
                    result = _sorted_chunk(table.slice(0, whole), least)
                    if result is not None:
                        yield from result.to_batches()
                held = table.slice(whole).to_batches()
                rows -= whole
        if rows:
            result = _sorted_chunk(pa.Table.from_batches(held).combine_chunks(), least)
            if result is not None:
                yield from result.to_batches()

    # The route is worked out on both sides of the shuffle, which then need not carry it.
    leading = F.substring_index("pointer", " ", 2)
    route = F.xxhash64(F.when(F.col("split"), F.col("pointer")).otherwise(leading))
    routed = pointers.repartition(route).withColumn("route", route).sortWithinPartitions("route")
    parts = routed.mapInArrow(run, "lang string, w0 string, w1 string, w2 string, n long")
    return parts.groupBy("lang", "w0", "w1", "w2").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- scores ---------------------------------------------------------------------------


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = [c.cast("decimal(38,0)") for c in (a, left, right)]
    square = (F.lit(1_000_000).cast("decimal(38,0)") * wide[0]).cast("decimal(38,0)") * wide[0]
    product = (wide[1] * wide[2]).cast("decimal(38,0)")
    return F.call_function("div", square.cast("decimal(38,0)"), product)


def _cut(k: int, left: str, right: str) -> Column:
    score = _score(F.col("a"), F.col(left), F.col(right))
    return F.struct(
        score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r")
    )


def scored_phrases(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score``: candidates by their lowest cut, contained ones gone.

    ``words`` has ``lang, word, n``; ``phrases`` is that of :func:`phrase_counts`.
    """

    def of(names: dict[str, str], table: DataFrame, value: str) -> DataFrame:
        return table.select("lang", *(F.col(c).alias(to) for c, to in names.items()), F.col("n").alias(value))

    pairs, triples = phrases.where("w2 is null"), phrases.where("w2 is not null")
    two = (
        of({"w0": "w0", "w1": "w1"}, pairs, "a")
        .join(of({"word": "w0"}, words, "f0"), ["lang", "w0"])
        .join(of({"word": "w1"}, words, "f1"), ["lang", "w1"])
    )
    three = (
        of({"w0": "w0", "w1": "w1", "w2": "w2"}, triples, "a")
        .join(of({"word": "w0"}, words, "f0"), ["lang", "w0"])
        .join(of({"word": "w2"}, words, "f2"), ["lang", "w2"])
        .join(of({"w0": "w0", "w1": "w1"}, pairs, "f01"), ["lang", "w0", "w1"])
        .join(of({"w0": "w1", "w1": "w2"}, pairs, "f12"), ["lang", "w1", "w2"])
    )
    longer = (
        triples.select(
            "lang",
            F.explode(F.array(F.struct(F.col("w0"), F.col("w1")), F.struct(F.col("w1").alias("w0"), F.col("w2").alias("w1")))).alias("p"),
            "n",
        )
        .groupBy("lang", "p.w0", "p.w1")
        .agg(F.max("n").alias("longest"))
    )
    two = two.join(longer, ["lang", "w0", "w1"], "left").where(
        F.col("longest").isNull() | (100 * F.col("longest") < KEPT_SHARE * F.col("a"))
    )
    shown = ["lang", "phrase", "a", "cut.l", "cut.r", "cut.score"]
    two = two.withColumn("phrase", F.concat_ws(" ", "w0", "w1")).withColumn("cut", _cut(1, "f0", "f1"))
    three = three.withColumn("phrase", F.concat_ws(" ", "w0", "w1", "w2")).withColumn(
        "cut", F.array_min(F.array(_cut(1, "f0", "f12"), _cut(2, "f01", "f2")))
    )
    return two.select(*shown).unionByName(three.select(*shown))


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    best: int = BEST,
    lang_col: str = "lang",
    text_col: str = "text",
    bits: int = BITMAP_BITS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``best`` phrases."""
    spark = docs.sparkSession
    pieces = _pieces_of(docs, lang_col, text_col)
    counted = word_counts(pieces)
    # Frequent words as a table; what the rest adds to a language's total goes in one row.
    frequent = F.col("n") >= min_count
    words = stored(
        counted.groupBy("lang", F.when(frequent, F.col("word")).alias("word")).agg(F.sum("n").alias("n")),
        "words",
    )
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    words = words.where(F.col("word").isNotNull())
    total = sizes.agg(F.sum("n").alias("n")).first()["n"]
    if not total:
        return spark.createDataFrame([], RESULT)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = total / (4 * partitions)  # so at most 4 * partitions words are heavier
    heavy = {(r["lang"], r["word"].encode()) for r in words.where(F.col("n") > share).collect()}
    bitmap = frequent_bitmap(words, bits)
    sent = [spark.sparkContext.broadcast(value) for value in (bitmap, heavy)]
    phrases = stored(phrase_counts(_pointers(pieces, sent[0], bits, sent[1]), min_count), "phrases")
    return (
        _best(_best(scored_phrases(words, phrases), best, RANKED_APART), best)
        .join(sizes, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def _best(scored: DataFrame, best: int, apart: int = 1) -> DataFrame:
    """The ``best`` phrases of each language, or of each of ``apart`` shares of its phrases, so
    that one task never ranks more than ``apart * best`` of them in the end."""
    share = F.pmod(F.xxhash64("phrase"), F.lit(apart)) if apart > 1 else F.lit(0)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = Window.partitionBy("lang", "share").orderBy(*order)
    return (
        scored.withColumn("share", share)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= best)
        .drop("share")
    )


RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH pieces AS (
  SELECT lang, unnest(pieces) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang,
           regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents)),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]'), lambda w: w <> '') AS ws FROM pieces),
running AS MATERIALIZED (
  SELECT lang, unnest(ws) AS w0, unnest(list_concat(ws[2:], [NULL])) AS w1,
         unnest(list_concat(ws[3:], [NULL, NULL])) AS w2
  FROM worded WHERE len(ws) > 0),
sizes AS (SELECT lang, count(w0) AS n FROM running GROUP BY lang),
one AS MATERIALIZED (SELECT lang, w0, count(*) AS f FROM running WHERE w0 IS NOT NULL GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
two AS MATERIALIZED (SELECT lang, w0, w1, count(*) AS f FROM running WHERE w1 IS NOT NULL
  GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
three AS MATERIALIZED (SELECT lang, w0, w1, w2, count(*) AS f FROM running WHERE w2 IS NOT NULL
  GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
longer AS (
  SELECT lang, a, b, max(f) AS f FROM (
    SELECT lang, w0 AS a, w1 AS b, f FROM three UNION ALL SELECT lang, w1, w2, f FROM three)
  GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.w0 || ' ' || t.w1 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM two t JOIN one x ON x.lang = t.lang AND x.w0 = t.w0 JOIN one y ON y.lang = t.lang AND y.w0 = t.w1
  LEFT JOIN longer b ON b.lang = t.lang AND b.a = t.w0 AND b.b = t.w1
  WHERE b.f IS NULL OR 100 * b.f < {KEPT_SHARE} * t.f
  UNION ALL
  SELECT t.lang, t.w0 || ' ' || t.w1 || ' ' || t.w2, t.f, 1, x.f, y.f
  FROM three t JOIN one x ON x.lang = t.lang AND x.w0 = t.w0
  JOIN two y ON y.lang = t.lang AND y.w0 = t.w1 AND y.w1 = t.w2
  UNION ALL
  SELECT t.lang, t.w0 || ' ' || t.w1 || ' ' || t.w2, t.f, 2, x.f, y.f
  FROM three t JOIN two x ON x.lang = t.lang AND x.w0 = t.w0 AND x.w1 = t.w1
  JOIN one y ON y.lang = t.lang AND y.w0 = t.w2),
scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, s.n, r.score
FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE r.rank <= {BEST}
"""
