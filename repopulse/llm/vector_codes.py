"""Vectors as short codes of codebook entries, trained under norm-of-sum bounds (operator 11).

A vector is cut into equal parts; each part is replaced by the number of the nearest
entry in the codebook of its position. Codebooks are trained by rounds of assignment and
averaging in whole numbers, so every result is exact and the same on every run.

Each part keeps an upper bound on the distance to its entry and a lower bound on the
distance to all others, each with the round it was measured in. All rounds' codebooks are
retained, so a bound of round ``r`` is carried to the present by the net displacement of
its entry, the norm of the summed moves, which is never more than the sum of the moves'
norms. A part whose upper bound stays below its lower bound keeps its entry without a
look; else the distance to its entry is measured, and only if that does not settle it are
all entries measured again. As stamps keep old bounds usable, bounds are only written
anew after a round that measured more than ``rewrite_share`` of the parts.

Sums and counts of each round are added up in the tasks; the driver holds the codebooks
(``parts * entries`` rows, whatever the number of vectors).

Defined cases: vectors that are null or hold a null, NaN or infinite component are
dropped. Repeated rows and ids each count. A null id comes after all others when the
first codebook is chosen; rows of one id are ordered by their components. A vector whose
length is not that of the first one, or not a multiple of ``parts``, and one with a
component beyond 2**26 after scaling (squares would leave 64 bits) gets null ``code`` and
``error`` and takes no part in training. With fewer vectors than entries there are as many
entries as vectors. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.common import stored
from repopulse.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
REWRITE_SHARE = 0.2
LARGEST = 1 << 26
# Room for rounding: stored bounds are single precision.
_ABOVE, _BELOW = 1 + 1e-6, 1 - 1e-6


def _state_type(parts: int) -> np.dtype:
    return np.dtype(
        [
            ("code", "u1", parts),
            ("upper", "<f4", parts),
            ("upper_round", "u1", parts),
            ("lower", "<f4", parts),
            ("lower_round", "u1", parts),
        ]
    )


@dataclass
class Codebooks:
    """The codebooks of all rounds so far, each ``(parts, entries, width)``."""

    history: list[np.ndarray] = field(default_factory=list)

    @property
    def now(self) -> np.ndarray:
        return self.history[-1]

    def displacements(self) -> tuple[np.ndarray, np.ndarray]:
        """By round, part and entry: how far the entry is from where it was, and the
        most that any other entry of its part has moved since."""
        moved = np.stack([np.sqrt(((self.now - old) ** 2).sum(axis=2).astype(float)) for old in self.history])
        moved *= _ABOVE
        others = np.zeros_like(moved)
        for entry in range(moved.shape[2]):
            rest = np.delete(moved, entry, axis=2)
            if rest.shape[2]:
                others[:, :, entry] = rest.max(axis=2)
        return moved, others


def squared(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances ``(n, entries)`` of one position's parts to its entries."""
    width = parts.shape[1]
    largest = max((int(np.abs(a).max()) for a in (parts, entries) if a.size), default=0)
    # Products and sums of doubles are exact below 2**53, and faster than those of integers.
    kind = np.float64 if 4 * largest * largest * max(1, width) < 1 << 53 else np.int64
    p, e = parts.astype(kind), entries.astype(kind)
    out = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)[None, :]
    return out.astype(np.int64)


def to_own(parts: np.ndarray, entries: np.ndarray, code: np.ndarray) -> np.ndarray:
    difference = parts.astype(np.int64) - entries[code]
    return (difference * difference).sum(axis=1)


def measured(vectors: np.ndarray, books: Codebooks) -> np.ndarray:
    """States by full measurement against the newest codebooks."""
    return advanced(vectors, None, books)[0]


def advanced(
    vectors: np.ndarray, states: np.ndarray | None, books: Codebooks
) -> tuple[np.ndarray, int]:
    """States that hold for the newest codebooks, and how many parts were measured in full."""
    n_parts, entries, width = books.now.shape
    now = len(books.history) - 1
    out = np.zeros(len(vectors), _state_type(n_parts)) if states is None else states.copy()
    moved, others = books.displacements() if states is not None else (None, None)
    rescans = 0
    for part in range(n_parts):
        own = vectors[:, part * width : (part + 1) * width]
        book = books.now[part]
        if states is None:
            again = np.arange(len(vectors))
        else:
            code = states["code"][:, part]
            upper = states["upper"][:, part] + moved[states["upper_round"][:, part], part, code]
            lower = states["lower"][:, part] - others[states["lower_round"][:, part], part, code]
            unsure = np.flatnonzero(~(upper < lower))
            tight = np.sqrt(to_own(own[unsure], book, code[unsure]).astype(float)) * _ABOVE
            out["upper"][unsure, part] = tight
            out["upper_round"][unsure, part] = now
            again = unsure[~(tight < lower[unsure])]
        rescans += len(again)
        if len(again):
            distance = squared(own[again], book)
            nearest = distance.argmin(axis=1)
            row = np.arange(len(again))
            best = distance[row, nearest]
            distance[row, nearest] = np.iinfo(np.int64).max
            out["code"][again, part] = nearest
            out["upper"][again, part] = np.sqrt(best.astype(float)) * _ABOVE
            out["lower"][again, part] = (
                np.sqrt(distance.min(axis=1).astype(float)) * _BELOW if entries > 1 else np.inf
            )
            out["upper_round"][again, part] = out["lower_round"][again, part] = now
    return out, rescans


# -- Spark ---------------------------------------------------------------------------


def _whole_vectors(
    table: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str
) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` in whole numbers; null where they are too large."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    floors = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(v, lambda x: F.abs(x.cast("double") * scale) < LARGEST)
    return table.where(v.isNotNull() & ~bad).select(
        F.col(id_col).alias("vec_id"),
        F.col(label_col).alias("label"),
        F.when(fits, floors.cast("array<int>")).alias("vector"),
    )


def _binary(rows: np.ndarray) -> pa.Array:
    size = rows.dtype.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    data = np.ascontiguousarray(rows).tobytes()
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
    )


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, width)


def _states(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    raw = b"".join(value.as_buffer() for value in batch.column("state"))
    return np.frombuffer(raw, _state_type(parts))


def _with_states(table: DataFrame, books: Codebooks, length: int) -> DataFrame:
    """The table with states for the newest codebooks, in place of older ones if it has any."""
    kept = ["vec_id", "label", "vector"]
    parts = books.now.shape[0]
    first = "state" not in table.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch, length)
            states = None if first else _states(batch, parts)
            new, _ = advanced(vectors, states, books)
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, _binary(new)], names=[*kept, "state"])

    schema = ", ".join(f"`{name}` {table.schema[name].dataType.simpleString()}" for name in kept)
    return table.mapInArrow(run, schema + ", state binary")


def _totals(table: DataFrame, books: Codebooks, length: int) -> tuple[np.ndarray, int]:
    """Sums of parts and, last, their number, by part and entry; and how many were measured
    in full (slot -1). A task gives a row per slot at most."""
    parts, entries, width = books.now.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        rescans = 0
        for batch in batches:
            vectors = _matrix(batch, length)
            states, again = advanced(vectors, _states(batch, parts), books)
            rescans += again
            for part in range(parts):
                code = states["code"][:, part]
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                own = vectors[order, part * width : (part + 1) * width].astype(np.int64)
                total[part, used, :width] += np.add.reduceat(own, first, axis=0)
                total[part, :, width] += np.bincount(code, minlength=entries)
        slots = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1, *slots.tolist()], pa.int32()),
                pa.array([rescans, *total.ravel()[slots].tolist()], pa.int64()),
            ],
            names=["slot", "value"],
        )

    sums = table.mapInArrow(run, "slot int, value long").groupBy("slot").agg(F.sum("value").alias("value"))
    out = np.zeros(parts * entries * (width + 1) + 1, np.int64)
    for row in sums.collect():  # one row per slot at most
        out[row.slot] = row.value
    return out[:-1].reshape(parts, entries, width + 1), int(out[-1])


def _averaged(book: np.ndarray, totals: np.ndarray) -> np.ndarray:
    sums, count = totals[:, :, :-1], totals[:, :, -1:]
    return np.where(count > 0, sums // np.maximum(count, 1), book)


def codebooks_sha256(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


class _Versions:
    """The vectors with their states; only the newest version is kept on disk."""

    def __init__(self, spark):
        self._spark, self._root, self._number = spark, scratch_path(spark, "vector-codes"), 0

    def written(self, df: DataFrame) -> DataFrame:
        old, self._number = self._number, self._number + 1
        df.write.parquet(f"{self._root}/{self._number}")
        if old:
            path = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{old}")
            path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
        return self._spark.read.schema(df.schema).parquet(f"{self._root}/{self._number}")


def train(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    rewrite_share: float = REWRITE_SHARE,
    measures: list[float] | None = None,
) -> tuple[DataFrame, Codebooks, int] | None:
    """Vectors with states, the codebooks and the vectors' length; None without any vectors.

    ``vectors`` has ``vec_id``, ``label`` and ``vector``. The share of parts that each
    round measured in full is added to ``measures``.
    """
    by_id = [F.col("vec_id").asc_nulls_last(), F.size("vector"), "vector"]
    usable = vectors.where(F.col("vector").isNotNull() & (F.size("vector") % parts == 0))
    smallest = usable.orderBy(*by_id).select("vector").first()
    if smallest is None:
        return None
    length = len(smallest.vector)
    usable = usable.where(F.size("vector") == length)
    first = usable.orderBy(*by_id).select("vector").limit(entries).collect()
    start = np.array([row.vector for row in first], np.int64)
    books = Codebooks([start.reshape(len(first), parts, length // parts).transpose(1, 0, 2).copy()])
    versions = _Versions(vectors.sparkSession)
    table = versions.written(_with_states(usable, books, length))
    for _ in range(rounds):
        totals, rescans = _totals(table, books, length)
        share = rescans / max(1, totals[:, :, -1].sum())
        if measures is not None:
            measures.append(float(share))
        if share > rewrite_share:
            table = versions.written(_with_states(table, books, length))
        books.history.append(_averaged(books.now, totals))
    return table, books, length


def vector_codes(
    embeddings: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    rewrite_share: float = REWRITE_SHARE,
) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part), ``error``, ``label_error`` and
    ``codebooks_sha256`` of every kept vector."""
    vectors = _whole_vectors(embeddings, scale, id_col, vector_col, label_col)
    trained = train(vectors, parts, entries, rounds, rewrite_share)
    uncoded = vectors
    digest = codebooks_sha256(np.zeros(0, np.int64))
    if trained is not None:
        table, books, length = trained
        uncoded = vectors.where(F.col("vector").isNull() | (F.size("vector") != length))
        digest = codebooks_sha256(books.now)
    coded = uncoded.select(
        "vec_id",
        "label",
        F.lit(None).cast("string").alias("code"),
        F.lit(None).cast("long").alias("error"),
    )
    if trained is not None:
        coded = _coded(table, books, length).unionByName(coded)
    coded = stored(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _coded(table: DataFrame, books: Codebooks, length: int) -> DataFrame:
    """Codes under the last codebooks with their exact errors."""
    parts, _, width = books.now.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch, length)
            states, _ = advanced(vectors, _states(batch, parts), books)
            code = np.ascontiguousarray(states["code"])
            error = np.zeros(len(vectors), np.int64)
            for part in range(parts):
                error += to_own(vectors[:, part * width : (part + 1) * width], books.now[part], code[:, part])
            digits = code.tobytes().hex()
            wide = 2 * parts
            texts = [digits[at : at + wide] for at in range(0, len(digits), wide)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = ", ".join(f"{name} {table.schema[name].dataType.simpleString()}" for name in ("vec_id", "label"))
    return table.mapInArrow(run, kinds + ", code string, error long")


def decoded(codes: Sequence[str], book: np.ndarray) -> np.ndarray:
    """The vectors, in whole numbers, that codes stand for."""
    parts, _, width = book.shape
    index = np.array([list(bytes.fromhex(code)) for code in codes]).reshape(-1, parts)
    return np.concatenate([book[part][index[:, part]] for part in range(parts)], axis=1).reshape(-1, parts * width)


def _round_sql(number: int) -> str:
    """One round: nearest entries by exact distance, then floored averages."""
    return f"""
near{number} AS MATERIALIZED (
  SELECT id, part, arg_min(entry, distance * {ENTRIES} + entry) AS entry, min(distance) AS distance
  FROM (
    SELECT c.id, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v))::BIGINT AS distance
    FROM cells c JOIN book{number} b ON b.part = c.part AND b.pos = c.pos
    GROUP BY ALL)
  GROUP BY id, part),"""


def _average_sql(number: int) -> str:
    return f"""
book{number + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos,
         coalesce((s.total - ((s.total % s.n) + s.n) % s.n) // s.n, b.v)::BIGINT AS v
  FROM book{number} b LEFT JOIN (
    SELECT c.part, a.entry, c.pos, sum(c.v)::BIGINT AS total, count(*) AS n
    FROM near{number} a JOIN cells c ON c.id = a.id AND c.part = a.part GROUP BY ALL) s
  ON s.part = b.part AND s.entry = b.entry AND s.pos = b.pos),"""


ORACLE = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT id, (i - 1) // (n // {PARTS}) AS part, (i - 1) % (n // {PARTS}) AS pos,
         floor(x::DOUBLE * {SCALE})::BIGINT AS v
  FROM (SELECT id, len(embedding) AS n, unnest(embedding) AS x,
               generate_subscripts(embedding, 1) AS i FROM kept)),
book0 AS MATERIALIZED (
  SELECT part, id - 1 AS entry, pos, v FROM cells WHERE id <= {ENTRIES}),
{"".join(_round_sql(k) + _average_sql(k) for k in range(ROUNDS))}
{_round_sql(ROUNDS)}
coded AS (
  SELECT k.vec_id, any_value(k.label) AS label,
         string_agg(printf('%02x', a.entry), '' ORDER BY a.part) AS code,
         sum(a.distance)::BIGINT AS error
  FROM near{ROUNDS} a JOIN kept k ON k.id = a.id GROUP BY k.id, k.vec_id),
digest AS (
  SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM book{ROUNDS})
SELECT vec_id, code, error,
       sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded, digest
"""
