"""Batched lookups of actors against an outside source, partition by partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions.text import user_node_id
from repopulse.functions.timeframes import event_time

# node ids -> one JSON object (or None) per id, in order. Runs on executors.
Lookup = Callable[[Sequence[str]], Sequence[str | None]]

# Users per request, how many partitions ask at once, and how many
# requests each of them has under way.
REQUEST_SIZE = 50
REQUEST_PARTITIONS = 5
REQUESTS_IN_FLIGHT = 5

FOUND, MISSING, FAILED = "found", "missing", "failed"

RESPONSE_SCHEMA = "actor_id BIGINT, status STRING, node STRING, error STRING"

NODE_SCHEMA = (
    "databaseId BIGINT, login STRING, name STRING, company STRING, location STRING, "
    "followers STRUCT<totalCount: INT>, following STRUCT<totalCount: INT>, "
    "createdAt STRING, updatedAt STRING"
)


def fetch_nodes(
    actors: DataFrame,
    lookup: Lookup,
    *,
    partitions: int = REQUEST_PARTITIONS,
    request_size: int = REQUEST_SIZE,
    in_flight: int = REQUESTS_IN_FLIGHT,
    beside: str | None = None,
) -> DataFrame:
    """One row per actor id: status (found, missing, failed), the node's JSON, the error.

    ``partitions`` tasks call the source at the same time, each with ``in_flight``
    requests under way. The ids must be distinct already. ``beside`` names a column of
    ``actors`` whose values the lookup gets as well, in the order of the ids: answers kept
    from an earlier run, say.
    """

    # Kept inside, so it travels to the executors by value and needs no package there.
    def ask(batch: pd.DataFrame) -> pd.DataFrame:
        answer = pd.DataFrame({"actor_id": batch["actor_id"].to_numpy()})
        try:
            extra = [] if beside is None else [batch[beside].tolist()]
            nodes = list(lookup(batch["node_id"].tolist(), *extra))
            if len(nodes) != len(batch):
                raise ValueError(f"asked for {len(batch)} users, got {len(nodes)}")
        except Exception as error:  # reported in the rows of this request; the job goes on
            return answer.assign(status=FAILED, node=None, error=str(error))
        answer["status"] = [MISSING if node is None else FOUND for node in nodes]
        return answer.assign(node=nodes, error=None)

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as lanes:
            for frame in frames:
                starts = range(0, len(frame), request_size)
                yield from lanes.map(ask, [frame.iloc[at : at + request_size] for at in starts])

    node_id = user_node_id(F.col("actor_id").cast("string")).alias("node_id")
    ids = actors.select("actor_id", node_id, *([] if beside is None else [beside]))
    return ids.repartition(partitions, "actor_id").mapInPandas(fetch, RESPONSE_SCHEMA)


def best_answers(responses: DataFrame) -> DataFrame:
    """One answer per actor where some were asked for again: any other before a failed one."""
    answered_first = Window.partitionBy("actor_id").orderBy(F.col("status") == FAILED, "status", "node")
    return (
        responses.withColumn("_nth", F.row_number().over(answered_first))
        .where(F.col("_nth") == 1)
        .drop("_nth")
    )


def flatten_nodes(responses: DataFrame) -> DataFrame:
    """User attributes from the JSON of found nodes; missing counts are 0, bad dates null."""
    node = F.from_json("node", NODE_SCHEMA).alias("n")
    counts = {"followers_count": "n.followers.totalCount", "following_count": "n.following.totalCount"}
    times = {"user_created_at": "n.createdAt", "user_updated_at": "n.updatedAt"}
    return (
        responses.where(F.col("node").isNotNull())
        .select(node)
        .select(
            F.col("n.databaseId").alias("user_id"),
            "n.login",
            "n.name",
            "n.company",
            "n.location",
            *[F.coalesce(path, F.lit(0)).cast("bigint").alias(name) for name, path in counts.items()],
            *[event_time(path, "string").alias(name) for name, path in times.items()],
        )
    )


def fetch_summary(responses: DataFrame) -> DataFrame:
    """How many ids were found, missing and failed."""
    return responses.groupBy("status").agg(F.count(F.lit(1)).alias("n_actors"))
