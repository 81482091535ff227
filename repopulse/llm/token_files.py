"""Token ids of documents as compressed binary files (operator 10).

The files are a Parquet table with one row per block. Spark's committer writes it,
so a lost executor leaves nothing half written, and any store Spark reaches will do.
A block holds whole documents in ascending ``doc_id`` order; its ids are coded by
:mod:`repopulse.llm.rans` with one frequency table for all blocks, which lies beside
them. Blocks decode alone, and within a block every checkpoint does.

    blocks/  part int, block int       the place: parts, and blocks in a part, ascend
             first_token long          ids before the block in its part
             n_tokens int
             doc_ids array<long>, doc_tokens array<int>
             payload binary            see ``rans``
    model/   symbol int, freq int

Defined cases: a null text is the empty text, which still has its end id. A null
``doc_id`` comes first. Rows with equal ``doc_id`` are ordered by text; repeated rows
are all written. Other columns are not read. Empty tables give files without blocks.
A document longer than a block is a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import rans
from repopulse.llm.common import _arrow_schema, per_row, stored, texts_of, to_batch
from repopulse.llm.tokens import shared_encoder

BLOCK_TOKENS = 1 << 19

_PLACE = (
    "part int, block int, first_token long, n_tokens int, "
    "doc_ids array<long>, doc_tokens array<int>, "
)
_RAW = _PLACE + "ids binary"
_BLOCKS = _PLACE + "payload binary"


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Tokenise whole texts and write the files under ``path``."""
    raw = stored(
        _raw_blocks(docs, vocabulary, end_id, block_tokens, id_col, text_col), "raw-tokens", "zstd"
    )
    counts = _symbol_counts(raw)
    symbols = np.array([row["symbol"] for row in counts], dtype=np.int64)
    dense = np.zeros(int(symbols.max()) + 1 if len(symbols) else 0, dtype=np.int64)
    dense[symbols] = [row["n"] for row in counts]
    freq = rans.frequencies(dense)

    def coder():
        model = rans.Model(freq)
        return lambda part, block, first, n, doc_ids, doc_tokens, ids: [
            (part, block, first, n, doc_ids, doc_tokens, rans.encode_block(_ids(ids), model))
        ]

    columns = tuple(raw.columns)
    per_row(raw, _BLOCKS, columns, coder).write.parquet(f"{path}/blocks")
    used = np.flatnonzero(freq)
    table = pa.table({"symbol": used.astype(np.int32), "freq": freq[used].astype(np.int32)})
    docs.sparkSession.createDataFrame(
        table.to_pandas(), "symbol int, freq int"
    ).coalesce(1).write.parquet(f"{path}/model")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, and its
    ``ids`` (little-endian u32) if asked for."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    model_rows = spark.read.schema("symbol int, freq int").parquet(f"{path}/model")
    rows = model_rows.orderBy("symbol").collect()  # at most the vocabulary
    freq = np.zeros(rows[-1]["symbol"] + 1 if rows else 0, dtype=np.uint32)
    freq[[row["symbol"] for row in rows]] = [row["freq"] for row in rows]
    # One row per part; parts are as many as the partitions that wrote the files.
    parts = blocks.groupBy("part").agg(F.sum(F.col("n_tokens").cast("long")).alias("n"))
    before, total = {}, 0
    for row in parts.orderBy("part").collect():
        before[row["part"]] = total
        total += row["n"]

    def decoder():
        model = rans.Model(freq)

        def rows_of(part, first, doc_ids, doc_tokens, payload):
            ids = rans.decode_block(payload, model).astype("<u4")
            at, out = 0, []
            for doc_id, n in zip(doc_ids, doc_tokens):
                own = ids[at : at + n].tobytes()
                row = (doc_id, before[part] + first + at, n, zlib.crc32(own))
                out.append((*row, own) if with_ids else row)
                at += n
            return out

        return rows_of

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return per_row(
        blocks,
        schema + ", ids binary" if with_ids else schema,
        ("part", "first_token", "doc_ids", "doc_tokens", "payload"),
        decoder,
    )


def _raw_blocks(docs, vocabulary, end_id, block_tokens, id_col, text_col) -> DataFrame:
    ordered = (
        texts_of(docs, id_col, text_col)
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
    )
    schema = _arrow_schema(docs.sparkSession, _RAW)
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary)
        part, number, first = 0, 0, 0
        doc_ids: list = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        n = 0

        def block() -> pa.RecordBatch:
            return to_batch(
                [(part, number, first, n, doc_ids, lengths, _narrow(np.concatenate(held)))], schema
            )

        for batch in batches:
            part = batch.column("part")[0].as_py() if len(batch) else part
            texts = (text.as_py() for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode_all(texts)):
                if lengths and n + len(ids) + 1 > block_tokens:
                    yield block()
                    number, first = number + 1, first + n
                    doc_ids, lengths, held, n = [], [], [], 0
                doc_ids.append(doc_id)
                lengths.append(len(ids) + 1)
                held += ids, end
                n += len(ids) + 1
        if lengths:
            yield block()

    return ordered.mapInArrow(run, _RAW)


def _symbol_counts(raw: DataFrame) -> list:
    """Counts over all documents; at most one row per entry of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                block = np.bincount(_ids(ids.as_py()), minlength=len(counts))
                block[: len(counts)] += counts
                counts = block
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["symbol", "n"]
        )

    sums = raw.select("ids").mapInArrow(run, "symbol int, n long")
    return sums.groupBy("symbol").agg(F.sum("n").alias("n")).collect()


def _narrow(ids: np.ndarray) -> bytes:
    """The ids in two bytes each if they fit, after a byte that names the width."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def _ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype=f"<u{packed[0]}", offset=1).astype(np.uint32)
