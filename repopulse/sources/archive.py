"""Hourly archive files: names, gaps and the scan into bronze rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.timeframes import Interval, hour_of, ntz_literal

# Payload differs by event type and stays text; declaring it a string makes the
# JSON reader hand over the raw object, and no inference pass is needed.
RAW_EVENT_SCHEMA = (
    "id STRING, type STRING, "
    "actor STRUCT<id: BIGINT, login: STRING, display_login: STRING, gravatar_id: STRING, "
    "url: STRING, avatar_url: STRING>, "
    "repo STRUCT<id: BIGINT, name: STRING, url: STRING>, "
    "org STRUCT<id: BIGINT, login: STRING, gravatar_id: STRING, url: STRING, avatar_url: STRING>, "
    "payload STRING, public BOOLEAN, created_at STRING"
)

# One gzip file of JSON lines per hour. The public archive does
# not pad the hour in its file names, our keys do, so that they sort by time.
ARCHIVE_KEY_FORMAT = "yyyy-MM-dd-HH"
REMOTE_FILE_FORMAT = "yyyy-MM-dd-H"
ARCHIVE_SUFFIX = ".json.gz"


def archive_key(hour: Column | str, folder: str = "raw/archive") -> Column:
    """File key of an hour, zero-padded."""
    stamp = F.date_format(hour, ARCHIVE_KEY_FORMAT)
    return F.concat(F.lit(f"{folder}/"), stamp, F.lit(ARCHIVE_SUFFIX))


def remote_file(hour: Column | str) -> Column:
    return F.concat(F.date_format(hour, REMOTE_FILE_FORMAT), F.lit(ARCHIVE_SUFFIX))


def archive_path(hour: datetime, folder: str) -> str:
    return f"{folder}/{hour:%Y-%m-%d-%H}{ARCHIVE_SUFFIX}"


# Hours in file names: of the archive, padded or not, and of our own hour folders.
ARCHIVE_NAME = (r"(\d{4}-\d{2}-\d{2}-\d{1,2})[.]json", REMOTE_FILE_FORMAT)


def hour_in_path(path: Column | str, name: tuple[str, str] = ARCHIVE_NAME) -> Column:
    """The hour that a file's path names; null if it names none."""
    pattern, stamp = name
    found = F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    return F.try_to_timestamp(found, F.lit(stamp)).cast("timestamp_ntz")


def hours_in(bounds: DataFrame) -> DataFrame:
    """Every hour from ``first_hour`` to ``last_hour``, both included, of a one-row frame."""
    spine = F.sequence(
        F.col("first_hour").cast("timestamp_ntz"),
        F.col("last_hour").cast("timestamp_ntz"),
        F.expr("INTERVAL 1 HOUR"),
    )
    return bounds.select(F.explode(spine).alias("hour"))


def hours_of_interval(spark: SparkSession, interval: Interval) -> DataFrame:
    whole = interval.aligned("hour")
    if whole.end <= whole.start:
        return spark.range(0).select(ntz_literal(whole.start).alias("hour"))
    bounds = spark.range(1).select(
        ntz_literal(whole.start).alias("first_hour"),
        (ntz_literal(whole.end) - F.expr("INTERVAL 1 HOUR")).alias("last_hour"),
    )
    return hours_in(bounds)


def hour_bounds(events: DataFrame, column: str = "ingested_at") -> DataFrame:
    return events.agg(
        hour_of(F.min(column)).alias("first_hour"), hour_of(F.max(column)).alias("last_hour")
    )


def missing_hours(spine: DataFrame, landed: DataFrame, column: str = "ingested_at") -> DataFrame:
    """Hours of the spine with no row landed, with the file each comes from and its key here."""
    have = landed.select(hour_of(column).alias("hour")).distinct()
    return spine.join(have, "hour", "left_anti").select(
        "hour",
        archive_key("hour").alias("archive_key"),
        remote_file("hour").alias("remote_file"),
    )


# Lines that do not parse, as they are.
CORRUPT = "_corrupt_line"


FILE_PATH = "_file"


def read_raw_events(
    spark: SparkSession, path: str | list[str], with_path: bool = False
) -> DataFrame:
    """Events of archive files; a line that is no JSON object is kept in ``CORRUPT``.

    ``with_path`` adds the file each line came from as ``FILE_PATH``.
    """
    reader = spark.read.schema(f"{RAW_EVENT_SCHEMA}, {CORRUPT} STRING")
    raw = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return raw.select("*", F.col("_metadata.file_path").alias(FILE_PATH)) if with_path else raw


def well_formed(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(raw: DataFrame) -> DataFrame:
    # Spark reads no file for the corrupt column alone, hence the id.
    lines = raw.where(F.col(CORRUPT).isNotNull()).withColumn("line", F.col(CORRUPT))
    return lines.select("id", "line", *(c for c in raw.columns if c == "ingested_at"))


def as_bronze(raw: DataFrame, ingested_at: Column) -> DataFrame:
    """Payload kept as text, batch time stamped on every row.

    A payload that is a parsed struct (or map) is written back to text.
    """
    if raw.schema["payload"].dataType.simpleString() == "string":
        payload = F.col("payload")
    else:
        payload = F.to_json("payload")
    return raw.withColumns({"payload_raw": payload, "ingested_at": ingested_at}).drop("payload")
