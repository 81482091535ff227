"""Parquet tables of a lake folder: partitioned writes, window reads, staged batches."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.timeframes import Interval, hour_key
from repopulse.sinks.schemas import TABLE_SCHEMAS

HOUR_PARTITION = "ingested_hour"
# Tables that are recomputed window by window hold several hours a folder, sorted by time
# inside: a month is 124 folders, and a run of one hour rewrites six hours at most.
BLOCK_PARTITION = "ingested_block"
BLOCK_HOURS = 6


@dataclass(frozen=True)
class Lake:
    """Tables under ``root``, named like ``silver/watch_events``."""

    spark: SparkSession
    root: str

    # -- paths -----------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _hadoop(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _children(self, path: str) -> list[str]:
        """Names in a folder but for markers; its first level only."""
        filesystem, hadoop_path = self._hadoop(path)
        if not filesystem.exists(hadoop_path):
            return []
        names = [status.getPath().getName() for status in filesystem.listStatus(hadoop_path)]
        return [name for name in names if not name.startswith(("_", "."))]

    def exists(self, table: str) -> bool:
        """Whether any rows were ever written."""
        return bool(self._children(self.path(table)))

    def layout(self, table: str) -> tuple[str, int]:
        """The partition column of an hourly table and the hours that one folder holds."""
        return self._layout(self._children(self.path(table)))

    @staticmethod
    def _layout(names: Sequence[str]) -> tuple[str, int]:
        hourly = any(name.startswith(f"{HOUR_PARTITION}=") for name in names)
        return (HOUR_PARTITION, 1) if hourly else (BLOCK_PARTITION, BLOCK_HOURS)

    def _window_folders(self, table: str, interval: Interval) -> dict[int, str]:
        """The window's folders that exist, by key: one listing, however many hours there are."""
        names = set(self._children(self.path(table)))
        column, hours = self._layout(names)
        wanted = {key: f"{column}={key}" for key in interval.hour_keys(hours)}
        return {key: f"{self.path(table)}/{name}" for key, name in wanted.items() if name in names}

    # -- reads -----------------------------------------------------------------

    def read(self, table: str, *, merge_schema: bool = False) -> DataFrame:
        """The table as a DataFrame, partition columns included; empty before the first write.

        ``merge_schema`` opens every file's footer, so only ask for it where
        columns were added over time.
        """
        if table in TABLE_SCHEMAS and not self.exists(table):
            return self.spark.createDataFrame([], TABLE_SCHEMAS[table])
        return self._reader(table, merge_schema).parquet(self.path(table))

    def _reader(self, table: str, merge_schema: bool = False):
        reader = self.spark.read.option("mergeSchema", str(merge_schema).lower())
        declared = TABLE_SCHEMAS.get(table)
        return reader.schema(declared) if declared and not merge_schema else reader

    def read_partition(self, table: str, partition: str) -> DataFrame:
        """One partition, like ``run=r1``; other folders are not listed."""
        path = self.path(table)
        return self._reader(table).option("basePath", path).parquet(f"{path}/{partition}")

    def read_window(self, table: str, interval: Interval, column: str = "ingested_at") -> DataFrame:
        """Rows of ``[start, end)``; folders outside it are neither listed nor opened."""
        rows = self.read_folders(table, self._window_folders(table, interval).values())
        return rows.where(interval.contains(column))

    def read_folders(self, table: str, folders: Iterable[str]) -> DataFrame:
        """The rows of some folders of an hourly table, without its partition column."""
        folders = list(folders)
        if folders:
            rows = self._reader(table).option("basePath", self.path(table)).parquet(*folders)
        else:
            rows = self.read(table).where(F.lit(False))
        return rows.drop(HOUR_PARTITION, BLOCK_PARTITION)

    def read_keys(self, table: str, keys: Iterable[int]) -> DataFrame:
        """The rows of the folders with these keys, as far as they exist."""
        names = set(self._children(self.path(table)))
        column, _ = self._layout(names)
        wanted = [f"{column}={key}" for key in sorted(set(keys))]
        return self.read_folders(table, [f"{self.path(table)}/{n}" for n in wanted if n in names])

    def register_view(self, table: str, name: str, condition: str | None = None) -> DataFrame:
        df = self.read(table)
        df = df.where(condition) if condition else df
        df.createOrReplaceTempView(name)
        return df

    # -- writes ----------------------------------------------------------------

    def overwrite_partitions(
        self,
        df: DataFrame,
        table: str,
        partition: Sequence[str],
        sort: Sequence[str | Column] = (),
        balance: bool = True,
    ) -> None:
        """Replace exactly the partitions that occur in ``df``, creating the table if needed.

        ``balance`` lets Spark size the files at run time: small partitions are
        merged into one writer, an oversized one is spread over several. It
        costs a shuffle, so rows that are laid out well already go without.
        """
        if balance:
            df = df.hint("rebalance", *[F.col(name) for name in partition])
        if sort:
            df = df.sortWithinPartitions(*partition, *sort)
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition)
            .parquet(self.path(table))
        )

    def overwrite_hours(
        self,
        df: DataFrame,
        table: str,
        sort: Sequence[str | Column] = (),
        column: str = "ingested_at",
        balance: bool = True,
    ) -> None:
        """Replace the hours that occur in ``df``: running a window again changes nothing."""
        keyed = df.withColumn(HOUR_PARTITION, hour_key(column))
        self.overwrite_partitions(keyed, table, [HOUR_PARTITION], sort, balance)

    def replace_hours(
        self, df: DataFrame, table: str, interval: Interval, sort: Sequence[str | Column] = ()
    ) -> None:
        """Make the interval's hours hold exactly ``df``: an hour without rows is emptied.

        A folder that the interval covers in part keeps its other hours. Folders are written
        aside and moved in, so ``df`` may read the table.
        """
        touched = self._window_folders(table, interval)
        column, hours = self.layout(table)
        rows = df.where(interval.contains("ingested_at"))
        partly = [path for key, path in touched.items() if not interval.covers(key, hours)]
        if partly:
            others = self.read_folders(table, partly).where(~interval.contains("ingested_at"))
            rows = rows.unionByName(others, allowMissingColumns=True)
        keyed = rows.withColumn(column, hour_key("ingested_at", hours))
        # Sorted by time, so that row groups of other hours are skipped on read.
        sort = ["ingested_at", *sort]
        if not touched:
            self.overwrite_partitions(keyed, table, [column], sort)
            return
        first, last = min(touched), max(touched)
        aside = self.staging(f"hours-{table.replace('/', '-')}-{first}-{last}")
        aside.discard()
        aside.overwrite_partitions(keyed, table, [column], sort)
        self.replace_partitions(aside, table, [f"{column}={key}" for key in touched])

    def replace_partitions(self, aside: Lake, table: str, names: Sequence[str]) -> None:
        """Move in what was written aside; those of ``names`` that got no rows there go."""
        written = set(aside._children(aside.path(table)))
        self.publish(aside, [table])
        self.drop_partitions(table, [name for name in names if name not in written])
        aside.discard()

    def partitions(self, table: str) -> list[str]:
        """First-level partitions like ``batch=7``, by their number."""
        return sorted(self._children(self.path(table)), key=lambda name: int(name.split("=")[1]))

    def replace_partition(
        self, df: DataFrame, table: str, partition: str, options: Mapping[str, str] | None = None
    ) -> None:
        """Make one partition hold exactly ``df``; no other is looked at."""
        df.write.mode("overwrite").options(**(options or {})).option(
            "partitionOverwriteMode", "static"
        ).parquet(f"{self.path(table)}/{partition}")

    def rewrite_partition(
        self, df: DataFrame, table: str, partition: str, options: Mapping[str, str] | None = None
    ) -> None:
        """The same where ``df`` reads the table: written aside, then moved in."""
        aside = self.staging(f"rewrite-{table.replace('/', '-')}")
        column = partition.split("=")[0]
        aside.replace_partition(df.drop(column), table, partition, options)
        self.publish(aside, [table])
        aside.discard()

    def size_of(self, table: str, partition: str) -> int:
        """Bytes of one partition's files."""
        filesystem, folder = self._hadoop(f"{self.path(table)}/{partition}")
        return filesystem.getContentSummary(folder).getLength()

    def drop_partitions(self, table: str, names: Sequence[str]) -> None:
        for name in names:
            filesystem, folder = self._hadoop(f"{self.path(table)}/{name}")
            filesystem.delete(folder, True)

    def append_hours(self, df: DataFrame, table: str, column: str = "ingested_at") -> None:
        (
            df.withColumn(HOUR_PARTITION, hour_key(column))
            .write.mode("append")
            .partitionBy(HOUR_PARTITION)
            .parquet(self.path(table))
        )

    def replace(self, df: DataFrame, table: str, partition: Sequence[str] = ()) -> None:
        """Create the table or replace all of it."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *partition
        ).parquet(self.path(table))

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(self.path(table))

    def drop(self, table: str) -> None:
        filesystem, hadoop_path = self._hadoop(self.path(table))
        filesystem.delete(hadoop_path, True)

    # -- staged batches: write, audit, publish -----------------------------------

    def staging(self, name: str) -> Lake:
        """A side folder with the same table names, which sees only what it was given."""
        return replace(self, root=f"{self.root}/_staging/{name}")

    def publish(self, staged: Lake, tables: Sequence[str]) -> None:
        """Move the staged partitions into these tables, in place of those of the same name.

        Files are renamed, not written again. A partition is put aside before its successor
        takes its name and deleted after, so it is missing between two renames only.
        Publishing a batch that broke off half way again moves what is left.
        """
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        for table in tables:
            filesystem, target = self._hadoop(self.path(table))
            filesystem.mkdirs(target)
            for name in self._children(staged.path(table)):
                folder = hadoop(f"{self.path(table)}/{name}")
                # Readers pass over names with an underscore in front.
                replaced = hadoop(f"{self.path(table)}/_replaced-{name}")
                if filesystem.exists(folder):
                    filesystem.delete(replaced, True)
                    filesystem.rename(folder, replaced)
                if not filesystem.rename(hadoop(f"{staged.path(table)}/{name}"), folder):
                    raise OSError(f"{name} of {table} was not moved")
                filesystem.delete(replaced, True)

    def discard(self) -> None:
        """Delete a staged batch."""
        if "/_staging/" not in self.root:
            raise ValueError("only a staged batch is discarded")
        filesystem, hadoop_path = self._hadoop(self.root)
        filesystem.delete(hadoop_path, True)
