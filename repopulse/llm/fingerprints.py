"""Document fingerprints by content-defined chunking (operator 8).

Chunk boundaries depend on the 32 bytes before them, by a gear hash, so an insertion
moves boundaries only nearby. Chunking is normalised: up to the wanted size a boundary
must clear more zero bits, beyond it fewer, which keeps sizes close together. A
fingerprint is the set of the chunks' digests with their lengths; the containment of
one text in another is the share of its chunk bytes that the other has too.

Each document is also compared with its successor by ``doc_id``. Documents are dealt
to buckets of consecutive ids, and the first document of a bucket goes to the bucket
before it as well, so one shuffle brings every document next to its successor.

Defined cases: a null text is the empty text, whose fingerprint is the empty string;
two empty texts contain each other, and an empty text is contained in no other. A null
``doc_id`` comes before all others. Rows with equal ``doc_id`` follow one another by
text; repeated rows are all kept. The last document's successor is the first, which
for a single document is itself. Other columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.common import _arrow_schema, texts_of, to_batch

SMALLEST, WANTED, LARGEST = 16, 64, 256
STRICT_BITS, LOOSE_BITS = 7, 5
BUCKET_ROWS = 2_000
MOST_BUCKETS = 32_768

GEAR = np.array(
    [
        struct.unpack("<I", hashlib.blake2b(bytes([b]), digest_size=4).digest())[0]
        for b in range(256)
    ],
    dtype=np.uint32,
)

_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)

Chunks = dict[int, int]


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: 32 bytes count, the last one least shifted."""
    h = GEAR[data]
    for reach in (1, 2, 4, 8, 16):
        older = h[:-reach] << np.uint32(reach)
        h = h.copy()
        h[reach:] += older
    return h


def boundaries(data: np.ndarray) -> list[int]:
    """Chunk ends, ascending; the last is the length."""
    size = len(data)
    if size <= SMALLEST:
        return [size] if size else []
    h = gear_hashes(data)
    loose = np.flatnonzero(h < np.uint32(1 << (32 - LOOSE_BITS)))
    strict = loose[h[loose] < np.uint32(1 << (32 - STRICT_BITS))].tolist()
    loose = loose.tolist()
    ends, start = [], 0
    while size - start > SMALLEST:
        at = bisect_left(strict, start + SMALLEST - 1)
        end = strict[at] + 1 if at < len(strict) else size
        if end > start + WANTED:
            at = bisect_left(loose, start + WANTED - 1)
            end = loose[at] + 1 if at < len(loose) else size
            end = min(end, start + LARGEST, size)
        ends.append(end)
        start = end
    if start < size:
        ends.append(size)
    return ends


def chunks_of(text: str) -> Chunks:
    """Digest to length, over the chunks of the text."""
    from xxhash import xxh3_64_intdigest

    data = text.encode("utf-8", "replace")
    found, start = {}, 0
    for end in boundaries(np.frombuffer(data, dtype=np.uint8)):
        found[xxh3_64_intdigest(data[start:end])] = end - start
        start = end
    return found


def as_string(chunks: Chunks) -> str:
    """19 hexadecimal digits a chunk, digest and length, in order of digest."""
    return "".join(f"{digest:016x}{chunks[digest]:03x}" for digest in sorted(chunks))


def containment(a: Chunks, b: Chunks) -> float:
    """The share of a's bytes whose chunks b has."""
    if not a or not b:
        return float(not a and not b)
    return sum(n for digest, n in a.items() if digest in b) / sum(a.values())


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(
    docs: DataFrame, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    rows = _next_to_successor(texts_of(docs, id_col, text_col), bucket_rows)
    schema = _arrow_schema(docs.sparkSession, _SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: tuple | None = None
        for batch in batches:
            for bucket, doc_id, text, tail in zip(
                *(batch.column(c) for c in ("bucket", "doc_id", "text", "tail"))
            ):
                bucket, tail, text = bucket.as_py(), tail.as_py(), text.as_py()
                if tail and (held is None or held[0] != bucket):
                    continue
                chunks = chunks_of(text)
                if held is not None:
                    out.append(_row(*held[1:], text, chunks))
                held = None if tail else (bucket, doc_id.as_py(), text, chunks)
                if len(out) >= 1000:
                    yield to_batch(out, schema)
                    out = []
        if out:
            yield to_batch(out, schema)

    return rows.mapInArrow(run, _SCHEMA)


def _row(doc_id, text: str, chunks: Chunks, next_text: str, next_chunks: Chunks) -> tuple:
    other = edited(text, next_text)
    other_chunks = chunks_of(other)
    return (
        doc_id,
        len(text),
        hashlib.sha256(other.encode("utf-8", "replace")).hexdigest(),
        as_string(chunks),
        as_string(other_chunks),
        containment(chunks, other_chunks),
        containment(chunks, next_chunks),
    )


def _next_to_successor(texts: DataFrame, bucket_rows: int) -> DataFrame:
    """Rows in order of ``doc_id`` within buckets, each bucket ended by its successor's first."""
    spark = texts.sparkSession
    ids = texts.select("doc_id")
    n = ids.count()
    wanted = max(1, min(MOST_BUCKETS, n // bucket_rows))
    shares = [k / wanted for k in range(1, wanted)]
    inner = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * wanted))).first()[0] if shares else []
    splits = [float("-inf"), *sorted({float(x) for x in inner or []}), float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="_place", outputCol="_bucket")

    def bucketed(frame: DataFrame) -> DataFrame:
        placed = frame.withColumn(
            "_place", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
        )
        if len(splits) == 2:
            return placed.withColumn("bucket", F.lit(0))
        return dealt.transform(placed).withColumn("bucket", F.col("_bucket").cast("int"))

    firsts = [
        (row["bucket"], row["first"])
        for row in bucketed(ids)
        .groupBy("bucket")
        .agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("least"))
        .select("bucket", F.col("least.doc_id").alias("first"))
        .orderBy("bucket")
        .collect()
    ]  # at most MOST_BUCKETS rows
    ends = [
        (first, bucket)
        for (bucket, _), (_, first) in zip(firsts, [*firsts[1:], *firsts[:1]])
    ]
    tails = F.broadcast(
        spark.createDataFrame(ends, "_first long, _ends int")
        .groupBy("_first")
        .agg(F.collect_list("_ends").alias("_ends"))
    )
    own = F.array(F.struct(F.col("bucket"), F.lit(False).alias("tail")))
    ending = F.transform(
        F.coalesce("_ends", F.array().cast("array<int>")),
        lambda b: F.struct(b.alias("bucket"), F.lit(True).alias("tail")),
    )
    return (
        bucketed(texts)
        .join(tails, F.col("doc_id").eqNullSafe(F.col("_first")), "left")
        .select("doc_id", "text", F.explode(F.concat(own, ending)).alias("_at"))
        .select(F.col("_at.bucket").alias("bucket"), F.col("_at.tail").alias("tail"), "doc_id", "text")
        .repartitionById(max(1, len(splits) - 1), F.col("bucket"))
        .sortWithinPartitions("bucket", "tail", "doc_id", "text")
    )
