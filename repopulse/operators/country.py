"""Free-text location to country and country code, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions.text import clean_location
from repopulse.operators.metrics import UNKNOWN_COUNTRY
from repopulse.operators.skew import HOT_ROWS, salted_join

# Countries by their own two- and three-letter codes and names.
LOOKUP_COLUMNS = ("alpha_2", "alpha_3", "name", "official_name", "common_name")


def gazetteer(subdivisions: DataFrame, countries: DataFrame) -> DataFrame:
    """``token, country, priority`` from a list of subdivisions.

    ``subdivisions``: position, name, country_code; ``countries``: alpha_2, name.
    A name listed twice takes the country listed last and keeps the place of
    its first mention. Countries not in the list are left out.
    """
    named = subdivisions.join(
        countries.select(F.col("alpha_2").alias("country_code"), F.col("name").alias("country")),
        "country_code",
    )
    return named.groupBy(F.lower("name").alias("token")).agg(
        F.max_by("country", "position").alias("country"),
        F.min("position").alias("priority"),
    )


def country_of_location(locations: DataFrame, places: DataFrame) -> DataFrame:
    """``location, country`` for each distinct location of the input.

    A place matches when its token is one of the blank-separated words; among
    several the lowest priority wins. Places of several words never match.
    """
    distinct = locations.select("location").where(F.col("location").isNotNull()).distinct()
    words = distinct.select(
        "location", F.explode(F.split(F.lower(clean_location("location")), " ")).alias("token")
    )
    return (
        words.join(places, "token")
        .groupBy("location")
        .agg(F.min_by("country", F.struct("priority", "token")).alias("country"))
    )


def with_country(df: DataFrame, places: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``country``. Text is matched once per distinct location, not once per row.

    On the way back to the rows, locations that very many actors share are split,
    and so are the rows without one.
    """
    return salted_join(
        df, country_of_location(df, places), ["location"], how="left", hot_rows=hot_rows
    )


def country_codes(countries: DataFrame) -> DataFrame:
    """``country, country_code``: every spelling of a country in lower case, to its alpha-3 code.

    Where two countries share a spelling, codes go before names.
    """
    present = [name for name in LOOKUP_COLUMNS if name in countries.columns]
    spellings = F.array(
        *[F.struct(F.lit(i).alias("rank"), F.col(c).alias("spelling")) for i, c in enumerate(present)]
    )
    return (
        countries.select("alpha_3", F.explode(spellings).alias("s"))
        .where(F.col("s.spelling").isNotNull())
        .groupBy(F.lower("s.spelling").alias("country"))
        .agg(F.min_by("alpha_3", F.struct("s.rank", "alpha_3")).alias("country_code"))
    )


def with_country_code(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Add ``country_code``; no country or one not listed gives UNKNOWN.

    ``codes`` is a reference list with one row per spelling. No broadcast is
    forced: Spark broadcasts it when its size allows, and splits skewed
    countries when it does not.
    """
    listed = codes.select(
        F.lower("country").alias("_spelling"), F.col("country_code").alias("_code")
    )
    return (
        df.join(listed, F.lower(F.trim("country")) == F.col("_spelling"), "left")
        .withColumn("country_code", F.coalesce("_code", F.lit(UNKNOWN_COUNTRY)))
        .drop("_spelling", "_code")
    )
