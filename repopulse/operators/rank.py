"""Global ranking without one task seeing every row, and rank movement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ids per slice of a tie group: the most rows one ranking task sorts.
ID_SLICE = 1 << 20

RANK_PAIRS = {"star_rank": "star_count", "fork_rank": "fork_count"}


def distributed_ranks(
    df: DataFrame,
    ranks: Mapping[str, str],
    tie: str,
    within: Sequence[str] = (),
    id_slice: int = ID_SLICE,
    slice_of: Column | None = None,
) -> DataFrame:
    """``rank() over (partition by within order by score desc, tie asc)`` for each named score.

    ``ranks`` maps the new column to its score, a count; ``tie`` is an integer
    id, unique per ``within``; neither they nor ``within`` may be null.

    Rows fall into slices ``(score, tie div id_slice)`` that sort like the rows
    themselves. A rank is the number of rows in earlier slices plus the rank
    inside the slice, and both sides of that join are partitioned by slice.
    Only the running total over slice sizes is taken per ``within`` group: one
    row per distinct score and id slice, already aggregated.

    All scores are ranked in one pass over a long form (one row per score), so
    both sides of the join read the same columns and Spark computes ``df`` once
    for the two. The way back to one row per ``tie`` leaves the rows
    partitioned by ``tie`` for whatever follows. ``slice_of`` replaces the division for
    ids that are sparse or no numbers: see :func:`ranks_of_any_ids`.
    """
    within = list(within)
    scores = F.array(
        *[
            F.struct(F.lit(name).alias("_rank"), F.col(score).alias("_score"))
            for name, score in ranks.items()
        ]
    )
    # Declared non-null: a null check on one side only would cost the shared pass.
    id_part = F.expr(f"`{tie}` div {id_slice}") if slice_of is None else slice_of
    id_part = F.coalesce(id_part, F.lit(0)).alias("_slice")
    scored = df.select(*df.columns, id_part, F.explode(scores).alias("_s")).select(
        *df.columns, "_slice", "_s._rank", "_s._score"
    )
    slice_key = [*within, "_rank", "_score", "_slice"]
    earlier = (
        Window.partitionBy(*within, "_rank")
        .orderBy(F.col("_score").desc(), F.col("_slice").asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        scored.groupBy(*slice_key)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_ahead", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    inside = F.rank().over(Window.partitionBy(*slice_key).orderBy(F.col(tie).asc()))
    ranked = (
        scored.withColumn("_inside", inside)
        .join(offsets, slice_key)
        .withColumn("_position", (F.col("_ahead") + F.col("_inside")).cast("int"))
    )
    if len(ranks) == 1:
        return ranked.select(*df.columns, F.col("_position").alias(next(iter(ranks))))
    return (
        ranked.repartition(tie)
        .groupBy(*df.columns)
        .agg(*[F.max(F.when(F.col("_rank") == n, F.col("_position"))).alias(n) for n in ranks])
    )


def _position(tie: str, kind: str) -> Column:
    """A number that never falls as the id grows; ids it does not tell apart share a slice."""
    if kind == "string":
        # The first seven bytes; a double holds 53 bits of them.
        head = F.substring(F.hex(F.encode(tie, "UTF-8")), 1, 14)
        return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("double")
    return F.col(tie).cast("double")


def _slice_between(value: Column, bounds: Sequence[float], first: int = 0) -> Column:
    """How many bounds lie below ``value``, by halving: as deep as their number has digits."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    above = _slice_between(value, bounds[middle + 1 :], first + middle + 1)
    return F.when(value > bounds[middle], above).otherwise(
        _slice_between(value, bounds[:middle], first)
    )


def ranks_of_any_ids(
    df: DataFrame,
    ranks: Mapping[str, str],
    tie: str,
    within: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """The same ranks where ids are hashed, negative, far apart or strings.

    The ids are cut into ranges at their approximate quantiles, as many as there are
    shuffle partitions, so a tie of any size is spread evenly whatever its ids look like,
    and the running total has at most one row per score and range. The quantiles cost a
    pass over ``df`` when this is called: store it before if it is dear. They only decide
    where a slice ends; ranks are exact.
    """
    kind = df.schema[tie].dataType.simpleString()
    if slices is None:
        slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    where = [n / slices for n in range(1, slices)] or [0.5]
    position = _position(tie, kind)
    row = df.agg(F.percentile_approx(position, where, 20 * slices).alias("bounds")).first()
    return distributed_ranks(
        df, ranks, tie, within, slice_of=_slice_between(position, sorted(set(row.bounds or [])))
    )


def with_star_and_fork_ranks(
    counts: DataFrame, within: Sequence[str] = ("ingested_at",), id_slice: int = ID_SLICE
) -> DataFrame:
    return distributed_ranks(counts, RANK_PAIRS, "repo_id", within, id_slice)


def _movement(previous: Column, current: Column) -> Column:
    return F.when(previous.isNull(), F.lit(0)).otherwise(previous - current).cast("int")


def _trend_columns(previous: str) -> list[Column]:
    """Previous values, newness and rank movement from a struct of the previous hour."""
    prev = {
        name: F.col(f"{previous}.{name}")
        for name in ("star_count", "fork_count", "star_rank", "fork_rank")
    }
    return [
        *[value.alias(f"prev_{name}") for name, value in prev.items()],
        prev["star_rank"].isNull().alias("is_new"),
        _movement(prev["star_rank"], F.col("star_rank")).alias("star_trend"),
        _movement(prev["fork_rank"], F.col("fork_rank")).alias("fork_trend"),
    ]


def _metrics(struct_of: str | None = None) -> Column:
    names = ("star_count", "fork_count", "star_rank", "fork_rank")
    prefix = f"{struct_of}." if struct_of else ""
    return F.struct(*[F.col(prefix + name).alias(name) for name in names])


def rank_trend(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Compare each row with the same repo one hour earlier, by left join.

    ``previous`` holds ranked rows with their own ``ingested_at``; an empty one
    gives the first-load defaults.
    """
    shifted = previous.select(
        F.col("repo_id"),
        (F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
        _metrics().alias("_previous"),
    )
    return (
        current.join(shifted, ["repo_id", "ingested_at"], "left")
        .select(*current.columns, *_trend_columns("_previous"))
    )


def rank_trend_over_history(ranked: DataFrame) -> DataFrame:
    """The same for a complete history of hours, in one pass per repo instead of a join.

    A repo has one row per hour here, so its window grows with time only, never
    with the number of events.
    """
    by_hour = Window.partitionBy("repo_id").orderBy("ingested_at")
    last = F.lag(F.struct(F.col("ingested_at"), _metrics().alias("m"))).over(by_hour)
    adjacent = F.col("_last.ingested_at") == F.col("ingested_at") - F.expr("INTERVAL 1 HOUR")
    return (
        ranked.withColumn("_last", last)
        .withColumn("_previous", F.when(adjacent, F.col("_last.m")))
        .select(*ranked.columns, *_trend_columns("_previous"))
    )
