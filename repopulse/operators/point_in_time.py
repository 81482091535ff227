"""Events joined to the dimension version valid when they happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values of a numeric time that share a stretch; of timestamps it is a calendar unit.
NUMERIC_STRETCH = 1 << 20


def _stretch(at: Column, kind: str, length: str | int) -> Column:
    if kind.startswith(("timestamp", "date")):
        return F.date_trunc(length, at)
    return F.floor(at / (length if isinstance(length, int) else NUMERIC_STRETCH))


def point_in_time_join(
    events: DataFrame,
    versions: DataFrame,
    *,
    event_key: str = "actor_id",
    version_key: str = "user_id",
    at: str = "created_at",
    how: str = "inner",
    stretch: str | int = "hour",
    strategy: str | None = "shuffle_hash",
) -> DataFrame:
    """The version with ``valid_from <= at < valid_to`` of the same key; ``how`` is inner or left.

    The versions of a key must not overlap, as those of a dimension do not. Bound columns of
    ``versions`` (``valid_from``, ``valid_to``) come along; any other column name must occur
    on one side only.

    A merge, not a join on a range: events and versions are stacked, dealt by key and stretch
    of time (``stretch``, a unit like hour or year, or a number for numeric times) and sorted once, and each event takes
    the last version before it. What a stretch begins with is carried over from those before
    it, one row per key and stretch, so a key that holds a third of all events
    is spread over its stretches. Both steps read the same shuffle: events are read once, and
    no version is copied. ``strategy`` is the join hint for the rows carried over.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    keyed = versions.withColumnRenamed(version_key, event_key)
    shown = [name for name in keyed.columns if name != event_key]
    kind = events.schema[at].dataType.simpleString()
    event, version = F.struct(*events.columns), F.struct(*shown)
    matchable = F.col(event_key).isNotNull() & F.col(at).isNotNull()
    happened = events.where(matchable).select(
        F.col(event_key).alias("_key"),
        _stretch(F.col(at), kind, stretch).alias("_stretch"),
        F.col(at).alias("_at"),
        F.lit(1).alias("_side"),
        event.alias("_event"),
        F.lit(None).cast(_type_of(keyed, shown)).alias("_version"),
    )
    begun = keyed.where(F.col(event_key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(event_key).alias("_key"),
        _stretch(F.col("valid_from"), kind, stretch).alias("_stretch"),
        F.col("valid_from").alias("_at"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(_type_of(events, events.columns)).alias("_event"),
        version.alias("_version"),
    )
    dealt = happened.unionByName(begun).repartition("_key", "_stretch")

    # A version comes before the events of its moment, an empty one before its successor.
    order = ["_at", "_side", F.col("_version.valid_to")]
    inside = Window.partitionBy("_key", "_stretch").orderBy(*order)
    merged = dealt.withColumn("_last", F.last("_version", ignorenulls=True).over(inside)).where(
        F.col("_side") == 1
    )
    # Counting events keeps the columns of both steps alike, so that they share the shuffle.
    ends = dealt.groupBy("_key", "_stretch").agg(
        F.max_by("_version", F.when(F.col("_side") == 0, F.struct("_at", "_version.valid_to"))).alias("_ending"),
        F.count("_event").alias("_events"),
    )
    before = Window.partitionBy("_key").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.withColumn("_carried", F.last("_ending", ignorenulls=True).over(before))
        .where((F.col("_events") > 0) & F.col("_carried").isNotNull())
        .select("_key", "_stretch", "_carried")
    )
    if strategy is not None:
        carried = carried.hint(strategy)
    found = F.coalesce("_last", "_carried")
    valid = F.col("_found.valid_to") > F.col("_at")
    joined = merged.join(carried, ["_key", "_stretch"], "left").withColumn("_found", found)
    joined = joined.select("_event", F.when(valid, F.col("_found")).alias("_found"))
    if how == "inner":
        joined = joined.where(F.col("_found").isNotNull())
    out = joined.select("_event.*", *[F.col(f"_found.{name}").alias(name) for name in shown])
    if how == "left":
        nothing = [F.lit(None).cast(keyed.schema[name].dataType).alias(name) for name in shown]
        out = out.unionByName(events.where(~matchable).select("*", *nothing))
    return out


def _type_of(df: DataFrame, names: list[str]) -> str:
    return df.select(*names).schema.simpleString()
