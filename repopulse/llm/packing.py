"""Packing of tokenised documents into sequences of a fixed capacity (operator 4).

A document longer than a sequence is cut into full pieces and a rest; no other is
cut. The pieces are packed by :mod:`repopulse.llm.bin_completion` over the number of
pieces of each length, which has at most ``capacity`` entries however many documents
there are. Its answer, a list of bin contents with multiplicities, is dealt to the
pieces by their rank among the pieces of their length. Ranks are counted in salted
slices of a length, so that a length that most pieces share is no single group.

Defined cases: a null text is the empty text, whose one piece is the end id. A null
``doc_id`` stays null. Repeated rows are packed as often as they occur. Other columns
are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import logging
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.bin_completion import search
from repopulse.llm.common import per_row, stored, texts_of
from repopulse.llm.tokens import shared_encoder

_log = logging.getLogger(__name__)

CAPACITY = 4096
SLICE_PIECES = 1_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = "sequence_id long, offset long"


def pieces_of(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece; ``ids`` (little-endian u32) if asked for."""
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def cutter():
        encoder = shared_encoder(vocabulary)

        def rows_of(doc_id, text):
            ids = encoder.encode(text) + end
            out = []
            for piece, at in enumerate(range(0, len(ids), width)):
                part = ids[at : at + width]
                row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                out.append((*row, part) if with_ids else row)
            return out

        return rows_of

    schema = _PIECES + ", ids binary" if with_ids else _PIECES
    return per_row(texts_of(docs, id_col, text_col), schema, ("doc_id", "text"), cutter)


def pack(pieces: DataFrame, capacity: int = CAPACITY, slice_pieces: int = SLICE_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. The table is read several times: store it."""
    counts = {
        row["length"]: row["n"]
        for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    }  # at most one entry per length up to the capacity
    found = search(counts, capacity)
    _log.info(
        "%d sequences, lower bound %d, fewest: %s",
        found.used, found.bound, "proven" if found.proven else "search ended first",
    )
    places = _places(found.bins)

    # How many slices each length has, by length: one number per length up to the capacity.
    slices = [1 - counts.get(n, 0) // -slice_pieces for n in range(capacity + 1)]
    own = F.element_at(F.array(*map(F.lit, slices)), F.col("length").cast("int") + 1)
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), own).cast("int")
    salted = pieces.withColumn("_slice", salt)
    in_slice = Window.partitionBy("length", "_slice").orderBy(
        "doc_id", "piece", "ids_crc32", "start"
    )
    before = (
        Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    slice_starts = (
        salted.groupBy("length", "_slice")
        .agg(F.count("*").alias("_n"))
        .select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    ranked = (
        salted.withColumn("_row", F.row_number().over(in_slice))
        .join(slice_starts, ["length", "_slice"])
        .withColumn("_rank", F.col("_before") + F.col("_row") - 1)
        .select(*pieces.columns, "_rank")
    )

    names = list(pieces.columns)

    def run(batches):
        for batch in batches:
            sequence, offset = _placed(
                places,
                batch.column("length").to_numpy(zero_copy_only=False),
                batch.column("_rank").to_numpy(zero_copy_only=False),
            )
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    return ranked.mapInArrow(run, f"{schema}, {_PLACED}")


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    return pack(stored(pieces_of(docs, vocabulary, end_id, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence; ``packed`` must have ``ids``. A group is one sequence at most."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(ordered.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, part: F.concat(acc, part["ids"]))
    return grouped.select("sequence_id", F.col("parts.doc_id").alias("doc_ids"), joined.alias("ids"))


Places = dict[int, tuple[np.ndarray, ...]]


def _places(packing: list[tuple[tuple[int, ...], int]]) -> Places:
    """Per length, the ranks at which a run of equal bins begins, and where its pieces go."""
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    taken: Counter = Counter()
    first_sequence = 0
    for pattern, times in packing:
        offset = 0
        for length, each in sorted(Counter(pattern).items(), reverse=True):
            rows[length].append((taken[length], first_sequence, each, offset))
            taken[length] += each * times
            offset += each * length
        first_sequence += times
    return {length: tuple(np.array(runs, dtype=np.int64).T) for length, runs in rows.items()}


def _placed(places: Places, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        first_rank, first_sequence, each, first_offset = places[int(length)]
        run = np.searchsorted(first_rank, ranks[rows], "right") - 1
        nth = ranks[rows] - first_rank[run]
        sequence[rows] = first_sequence[run] + nth // each[run]
        offset[rows] = first_offset[run] + nth % each[run] * length
    return sequence, offset
