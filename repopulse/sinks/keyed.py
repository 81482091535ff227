"""Keyed tables as batches of changes, resolved when they are read.

A batch writes its own rows into a folder of its own and touches no other, so its cost
follows the batch, not the table, and running it again replaces what it wrote. The
state of a key is worked out on read. Rows lie sorted by key with a Bloom filter per row
group, so a lookup of few keys opens few of them. ``compact`` folds batches of like size
from time to time; without it a table gains one folder a batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions.timeframes import ntz_literal
from repopulse.operators.scd2 import OPEN_END, VERSION_COLUMNS
from repopulse.sinks.lake import Lake

BATCH_PARTITION = "batch"


# Batches of one size class that are folded together, and the size where classes begin.
FAN = 4
SMALLEST_CLASS = 32 << 20
ROW_GROUP = 16 << 20


def _file_options(key: str) -> dict[str, str]:
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        # Grown to what a row group holds.
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.block.size": str(ROW_GROUP),
    }


def upsert_table(
    lake: Lake, source: DataFrame, table: str, batch: int, key: str | None = None
) -> None:
    """Add one-row-per-key ``source`` as batch number ``batch``; batches count up in time."""
    options = _file_options(key) if key else {}
    rows = source.sortWithinPartitions(key) if key else source
    lake.replace_partition(rows, table, f"{BATCH_PARTITION}={batch}", options)


def read_keyed(
    lake: Lake,
    table: str,
    key: str,
    version: str,
    only: DataFrame | Sequence | None = None,
) -> DataFrame:
    """One row per key: what merging the batches in order would leave.

    A row gives way to one of a later batch only if its ``version`` is strictly
    older; equal or null versions on either side keep it. ``only`` holds the keys
    asked for, and other rows are dropped before the shuffle: by a join if it is a frame, in
    the scan, row group by row group, if it is a list of some keys.
    """
    rows = lake.read(table)
    if isinstance(only, DataFrame):
        rows = rows.join(only.select(key).distinct(), key, "left_semi")
    elif only is not None:
        rows = _of_keys(rows, key, only)
    return _newest(rows, key, version).drop(BATCH_PARTITION)


def _of_keys(rows: DataFrame, key: str, keys: Sequence) -> DataFrame:
    # Several short lists: the scan checks each against statistics and Bloom filters.
    at_once = int(rows.sparkSession.conf.get("spark.sql.parquet.pushdown.inFilterThreshold"))
    asked = sorted({value for value in keys if value is not None})
    lists = [asked[at : at + at_once] for at in range(0, len(asked), at_once)]
    return rows.where(reduce(or_, [F.col(key).isin(some) for some in lists], F.lit(False)))


def _newest(rows: DataFrame, key: str, version: str) -> DataFrame:
    # A null version in the first batch of a key stays for good.
    first = F.min(BATCH_PARTITION).over(Window.partitionBy(key))
    stays = F.col(version).isNull() & (F.col(BATCH_PARTITION) == first)
    best = Window.partitionBy(key).orderBy(
        stays.desc(), F.col(version).desc_nulls_last(), BATCH_PARTITION
    )
    return (
        rows.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") == 1).drop("_nth")
    )


def _folded(rows: DataFrame, key: str, version: str) -> DataFrame:
    """What neighbouring batches leave to those before and after them: the newest row of a
    key, and one without version if it comes first, for the case that nothing is before."""
    first = F.min(BATCH_PARTITION).over(Window.partitionBy(key))
    best = Window.partitionBy(key).orderBy(F.col(version).desc_nulls_last(), BATCH_PARTITION)
    unversioned = F.col(version).isNull() & (F.col(BATCH_PARTITION) == first)
    return (
        rows.withColumn("_nth", F.row_number().over(best))
        .withColumn("_stays", unversioned)
        .where((F.col("_nth") == 1) | F.col("_stays"))
        .drop("_nth", "_stays")
    )


def size_classes(sizes: Sequence[tuple[str, int]], fan: int) -> list[list[str]]:
    """Neighbouring batches to fold: ``fan`` of a class make one of the next class up."""
    stack: list[tuple[int, int, list[str]]] = []
    for name, size in sizes:
        stack.append((_class_of(size, fan), size, [name]))
        while len(stack) >= fan and len({level for level, _, _ in stack[-fan:]}) == 1:
            joined, stack = stack[-fan:], stack[:-fan]
            total = sum(size for _, size, _ in joined)
            level = max(_class_of(total, fan), joined[0][0] + 1)
            stack.append((level, total, [name for _, _, names in joined for name in names]))
    return [names for _, _, names in stack if len(names) > 1]


def _class_of(size: int, fan: int) -> int:
    level = 0
    while size > SMALLEST_CLASS * fan**level:
        level += 1
    return level


def compact(lake: Lake, table: str, key: str, version: str, fan: int = FAN) -> None:
    """Fold batches of like size, each run of neighbours into the newest of them.

    A row is written again once per size class, not each time. The folded batch is
    written first and the others go after it; what they held is in it, so a run that breaks
    off in between leaves a table that reads the same.
    """
    sizes = [(name, lake.size_of(table, name)) for name in lake.partitions(table)]
    for names in size_classes(sizes, fan):
        numbers = [int(name.split("=")[1]) for name in names]
        rows = lake.read(table).where(F.col(BATCH_PARTITION).isin(numbers))
        folded = _folded(rows, key, version).repartitionByRange(key).sortWithinPartitions(key)
        lake.rewrite_partition(folded, table, names[-1], _file_options(key))
        lake.drop_partitions(table, names[:-1])


def _first_sightings(rows: DataFrame, key: str) -> DataFrame:
    """The sightings that start a version: the first of a key, and those with another hash
    than the one before in time. Of two at one time that of the earlier batch counts."""
    # One exchange for all windows below: they are partitioned by the key or finer.
    rows = rows.repartition(key)
    twins = Window.partitionBy(key, "valid_from").orderBy(BATCH_PARTITION)
    in_time = Window.partitionBy(key).orderBy("valid_from")
    before = F.lag(F.struct("hash_diff")).over(in_time)
    changed = F.col("_before.hash_diff") != F.col("hash_diff")
    return (
        rows.withColumn("_twin", F.row_number().over(twins))
        .where(F.col("_twin") == 1)
        .withColumn("_before", before)
        .where(F.col("_before").isNull() | changed)
        .drop("_twin", "_before")
    )


def read_dimension(
    lake: Lake, table: str, key: str = "user_id", only: DataFrame | None = None
) -> DataFrame:
    """All versions, by gaps and islands over the sightings of all batches.

    A run of sightings with one hash is a version; it ends where the next begins. The order
    in which the batches were written does not matter.
    """
    rows = lake.read(table)
    if only is not None:
        rows = rows.join(only.select(key).distinct(), key, "left_semi")
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    open_end = ntz_literal(OPEN_END)
    return (
        _first_sightings(rows, key)
        .drop(BATCH_PARTITION)
        .withColumn("valid_to", F.coalesce(following, open_end))
        .withColumn("is_current", F.col("valid_to") == open_end)
    )


def scd2_merge_table(lake: Lake, changes: DataFrame, table: str, batch: int) -> None:
    """Keep what a batch of rows with ``valid_from`` and ``hash_diff`` saw.

    Every sighting is kept, unchanged ones too: one that comes between two others may
    make the later one a new version. Nothing is read or compared here.
    """
    columns = [name for name in changes.columns if name not in VERSION_COLUMNS[1:]]
    lake.replace_partition(changes.select(*columns), table, f"{BATCH_PARTITION}={batch}")


def compact_dimension(lake: Lake, table: str, key: str, before: int) -> None:
    """Fold the batches before ``before`` into the newest of them, as versions only.

    Unchanged sightings go, so a batch older than the fold that is written later is only
    compared with versions. Broken off half way, the table reads the same.
    """
    old = [name for name in lake.partitions(table) if int(name.split("=")[1]) < before]
    if len(old) > 1:
        rows = lake.read(table).where(F.col(BATCH_PARTITION) < before)
        lake.rewrite_partition(_first_sightings(rows, key), table, old[-1])
        lake.drop_partitions(table, old[:-1])


def create_current_view(lake: Lake, table: str, name: str, key: str = "user_id") -> None:
    """A view in the session's catalog of each key's current version, straight off the files.

    It holds no rows: batches written later show without creating it again.
    """
    columns = [c for c in lake.read(table).columns if c not in (BATCH_PARTITION, "valid_from")]
    shown = ", ".join(f"`{c}`" for c in columns)
    lake.spark.sql(
        f"""
CREATE OR REPLACE VIEW {name} AS
SELECT {shown}, valid_from FROM (
  SELECT *, row_number() OVER (PARTITION BY `{key}` ORDER BY valid_from DESC) AS _newest FROM (
    SELECT *, lag(struct(hash_diff)) OVER (PARTITION BY `{key}` ORDER BY valid_from) AS _before FROM (
      SELECT *, row_number() OVER (PARTITION BY `{key}`, valid_from ORDER BY {BATCH_PARTITION}) AS _twin
      FROM parquet.`{lake.path(table)}`)
    WHERE _twin = 1)
  WHERE _before IS NULL OR _before.hash_diff <> hash_diff)
WHERE _newest = 1"""
    )
