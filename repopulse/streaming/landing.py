"""Files as they land: each is handed on in one batch, by a stream that remembers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def landed_files(
    spark: SparkSession,
    folder: str,
    progress: str,
    files_at_once: int,
    take: Callable[[DataFrame, int], None],
    pattern: str = "*.json*",
) -> None:
    """Call ``take`` with batches of the folder's files (``path``) not handed on before; return
    when there are no more.

    Batches are numbered and fixed before they are handed on: one whose ``take`` did not
    end comes again with the same files and number, so ``take`` must replace what it wrote.
    Contents are not read here.
    """
    listed = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_at_once)
        .load(folder)
        .select("path")
    )
    query = (
        listed.writeStream.foreachBatch(take)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
