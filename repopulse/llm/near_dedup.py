"""Near-duplicate documents by HyperMinHash (operator 2).

Documents are linked if their sets of distinct five-word shingles have a Jaccard
similarity of 0.75 or more. Sets that are equal are one class and go on as its
smallest ``doc_id``. A class has 128 compressed registers (see
:mod:`repopulse.llm.hyperminhash`); 32 bands of four are the candidate search, which
misses a pair at 0.75 with a chance of 5 in a million.

Buckets are never paired out as rows. First each bucket's smallest member is compared
with its others, by a collision-corrected estimate that drops a pair only six standard
deviations below 0.75, and then on the full sets; that links most copies. Buckets whose
members are still in several components are compared in full inside tasks: their sets
are dealt to slices of bounded size, every two slices meet in one task, and the task
counts common shingles by a matrix product and returns a spanning forest of the links it
finds. So every candidate pair is compared or already connected, while what is
shuffled and returned follows the members, not the pairs.

Defined cases: a text that is null or has no words has the empty set and is linked with
nothing; with fewer than five words the whole sequence is the one shingle. Equal texts
and repeated rows are linked by their equal sets. Rows with one ``doc_id`` and several
texts are compared each; classes with the same smallest ``doc_id`` count as one. A null
``doc_id`` is linked with nothing, its component is null and it is kept. Other columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm import hyperminhash
from repopulse.llm.common import per_row, stored, texts_of
from repopulse.llm.components import components

SHINGLE_WORDS = 5
SIMILAR, OF = 75, 100  # 100 * intersection >= 75 * union
SLICE_SHINGLES = 200_000  # of a bucket's slice; a member counts for LEAST_COUNTED at least
LEAST_COUNTED = 500
COLUMNS_AT_ONCE = 4_096
SIGMAS = 6.0

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    from xxhash import xxh64_intdigest

    # On UTF-8 bytes lower() and split() know ASCII only: A-Z, blank and \x09-\x0D.
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(SHINGLE_WORDS, len(words))
    mixed = np.full(len(words) - span + 1, span, dtype=np.uint64)
    for k in range(span):
        mixed = (mixed * _ODD) ^ hashes[k : k + len(mixed)]
        mixed ^= mixed >> np.uint64(31)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed * _MIX)


def find_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row."""
    texts = texts_of(docs, id_col, text_col)
    sketches = stored(_sketched(texts), "sketches")
    members = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ("set_hash", "set_hash2", "n_shingles")
    classes = stored(
        members.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")),
        "classes",
    )
    joined = _component_of(texts, classes)
    reps = classes.select(*same, "rep").join(joined, F.col("rep") == F.col("node"), "left")
    return (
        sketches.join(
            reps.select(*same, F.coalesce("component", "rep").alias("component_id")),
            list(same),
            "left",
        )
        .withColumn(
            "component_id",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")),
        )
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, of one ``doc_id`` of each component.

    Rows that share the ``doc_id`` that stays are all kept, equal ones too.
    """
    found = find_near_duplicates(docs)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def _sketched(texts: DataFrame) -> DataFrame:
    def sketcher():
        from xxhash import xxh3_128_intdigest

        def rows_of(doc_id, text):
            found = shingles(text)
            if not len(found):
                return [(doc_id, 0, 0, 0, [])]
            whole = np.array(
                divmod(xxh3_128_intdigest(found.tobytes()), 1 << 64), dtype=np.uint64
            ).view(np.int64)
            keys = hyperminhash.bands(hyperminhash.registers(found))
            return [(doc_id, len(found), int(whole[0]), int(whole[1]), keys.tolist())]

        return rows_of

    schema = "doc_id long, n_shingles long, set_hash long, set_hash2 long, bands array<long>"
    return per_row(texts, schema, ("doc_id", "text"), sketcher)


def _component_of(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``node``, ``component`` of the classes that some verified link joins."""
    spread = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    crowded = (
        spread.groupBy("band", "key")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
        .where("hub <> last")
        .drop("last")
    )
    buckets = stored(spread.join(crowded, ["band", "key"]), "buckets").dropDuplicates()
    asked = buckets.select(F.col("rep").alias("_rep")).distinct()
    sets = stored(_sets(texts, asked), "sets")
    pairs = buckets.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    links = stored(_verified(classes, sets, pairs.distinct()), "links")
    labels = stored(components(links), "components")
    return _merged(labels, stored(_links_inside(buckets, classes, sets, labels), "links"))


def _sets(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """``rep`` and its sorted shingles as little-endian 64-bit numbers."""
    wanted = texts.join(asked, F.col("doc_id") == F.col("_rep"), "left_semi")

    def setter():
        return lambda doc_id, text: [(doc_id, shingles(text).astype("<u8").tobytes())]

    return per_row(wanted, "rep long, shingles binary", ("doc_id", "text"), setter)


def _links_inside(
    buckets: DataFrame, classes: DataFrame, sets: DataFrame, labels: DataFrame
) -> DataFrame:
    """Links between components that meet in a bucket."""
    known = labels.select(F.col("node").alias("rep"), "component")
    sizes = classes.select("rep", F.col("n_shingles").alias("n")).dropDuplicates(["rep"])
    members = (
        buckets.select("band", "key", "rep")
        .join(known, "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
        .join(sizes, "rep")
    )
    members = stored(members, "members")
    split = (
        members.groupBy("band", "key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.sum(F.greatest("n", F.lit(LEAST_COUNTED))).alias("total"),
        )
        .where("low <> high")
        .select("band", "key", F.ceil(F.col("total") / SLICE_SHINGLES).cast("int").alias("slices"))
    )
    slice_ = F.pmod(F.xxhash64("rep", "band"), F.col("slices")).cast("int")
    # A member goes to the meetings of its slice with every slice, itself included.
    meetings = F.transform(
        F.sequence(F.lit(0), F.col("slices") - 1),
        lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")),
    )
    dealt = (
        members.join(split, ["band", "key"])
        .withColumn("own", slice_)
        .withColumn("meeting", F.explode(meetings))
        .select("band", "key", "meeting.i", "meeting.j", "own", "rep", "component")
        .join(sets, "rep")
    )

    def meet(frame):
        import pandas as pd

        found = _forest(
            frame["rep"].to_numpy(), frame["component"].to_numpy(), frame["own"].to_numpy(),
            [np.frombuffer(s, "<u8") for s in frame["shingles"]],
        )
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("band", "key", "i", "j").applyInPandas(meet, "a long, b long").distinct()


def _forest(reps, own_component, own_slice, sets) -> list[tuple[int, int]]:
    """Links that join the components of a meeting; pairs of one slice only where both are it."""
    if len(set(own_component)) < 2:
        return []
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = seen[column] > 1
    row, column = row[often], column[often]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    columns = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, columns, COLUMNS_AT_ONCE):
        width = min(COLUMNS_AT_ONCE, columns - first)
        low, high = np.searchsorted(column, [first, first + width])
        present = np.zeros((len(sets), width), dtype=np.float32)
        present[row[low:high], column[low:high] - first] = 1
        shared += present @ present.T
    size = np.array([len(s) for s in sets], dtype=np.int64)
    common = shared.astype(np.int64)
    linked = OF * common >= SIMILAR * (size[:, None] + size[None, :] - common)
    linked &= own_component[:, None] != own_component[None, :]
    if own_slice.min() != own_slice.max():
        linked &= own_slice[:, None] != own_slice[None, :]
    root = {c: c for c in own_component.tolist()}

    def top(c: int) -> int:
        while root[c] != c:
            c = root[c] = root[root[c]]
        return c

    found = []
    for x, y in np.argwhere(np.triu(linked)):
        a, b = top(int(own_component[x])), top(int(own_component[y]))
        if a != b:
            root[max(a, b)] = min(a, b)
            found.append((int(reps[x]), int(reps[y])))
    return found


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: those are drawn between components first."""
    if links.isEmpty():
        return labels
    name = labels.select("node", F.col("component").alias("own"))
    drawn = (
        links.join(name.withColumnsRenamed({"node": "a", "own": "in_a"}), "a", "left")
        .join(name.withColumnsRenamed({"node": "b", "own": "in_b"}), "b", "left")
        .select(F.coalesce("in_a", "a").alias("a"), F.coalesce("in_b", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    moved = stored(components(drawn), "moved")
    lower = moved.select(F.col("component").alias("lower"), F.col("node").alias("component"))
    lowered = labels.join(lower, "component", "left").select(
        "node", F.coalesce("lower", "component").alias("component")
    )
    # A node that had no link so far has no label of its own yet.
    added = moved.join(labels.select("node"), "node", "left_anti")
    return stored(lowered.union(added.select("node", "component")), "components")


def _verified(classes: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are similar enough on their full sets."""
    both = (
        _likely(classes, pairs)
        .join(sets.withColumnsRenamed({"rep": "a", "shingles": "set_a"}), "a")
        .join(sets.withColumnsRenamed({"rep": "b", "shingles": "set_b"}), "b")
    )

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = (np.frombuffer(x.as_py(), "<u8") for x in (a, b))
                common = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(OF * common >= SIMILAR * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long").distinct()


def _likely(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose estimate does not rule it out."""
    sketch = classes.select("rep", F.col("n_shingles").alias("n"), "bands")
    both = (
        pairs.join(sketch.withColumnsRenamed({"rep": "a", "n": "n_a", "bands": "bands_a"}), "a")
        .join(sketch.withColumnsRenamed({"rep": "b", "n": "n_b", "bands": "bands_b"}), "b")
        .where(OF * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b"))
    )
    limit = SIMILAR / OF

    def run(batches):
        for batch in batches:
            a, b = (
                np.asarray(batch.column(c).flatten(), dtype="<i8")
                .view("<u2")
                .reshape(len(batch), -1)
                for c in ("bands_a", "bands_b")
            )
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b")]
            found, behind = hyperminhash.estimate(a, b, *sizes)
            spread = np.sqrt(limit * (1 - limit) / np.maximum(behind, 1))
            keep = pa.array(found >= limit - SIGMAS * spread - 1 / np.maximum(behind, 1))
            yield batch.select(["a", "b"]).filter(keep)

    return both.mapInArrow(run, "a long, b long").distinct()


ORACLE = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < {SHINGLE_WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + {SHINGLE_WORDS - 1}], ' ')
                        FOR i IN range(1, len(w) - {SHINGLE_WORDS - 2})]) END AS s
  FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
flat AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
repeated AS (
  SELECT shingle, row_number() OVER () AS k FROM flat GROUP BY shingle HAVING count(*) > 1),
coded AS (SELECT doc_id, k FROM flat JOIN repeated USING (shingle)),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM coded x JOIN coded y ON x.k = y.k AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id),
halves AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE {OF} * c >= {SIMILAR} * (p.n + q.n - c)),
linked AS (SELECT a, b FROM halves UNION ALL SELECT b, a FROM halves),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a)
SELECT sizes.doc_id, n AS n_shingles, min(b) AS component_id, sizes.doc_id = min(b) AS kept
FROM sizes JOIN reach ON reach.a = sizes.doc_id GROUP BY sizes.doc_id, n
"""
