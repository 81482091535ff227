"""Reference lists a deployment brings along: countries and their subdivisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repopulse.operators.country import country_codes, gazetteer

COUNTRY_COLUMNS = (
    "alpha_2 STRING, alpha_3 STRING, name STRING, official_name STRING, common_name STRING"
)
SUBDIVISION_COLUMNS = "position INT, name STRING, country_code STRING"


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header: the ISO 3166-1 codes and names of each country."""
    return spark.read.schema(COUNTRY_COLUMNS).csv(path, header=True, enforceSchema=False)


def read_subdivisions(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header: the ISO 3166-2 subdivisions, numbered in list order."""
    return spark.read.schema(SUBDIVISION_COLUMNS).csv(path, header=True, enforceSchema=False)


def places_and_codes(
    spark: SparkSession, subdivisions_path: str, countries_path: str
) -> tuple[DataFrame, DataFrame]:
    countries = read_countries(spark, countries_path)
    return gazetteer(read_subdivisions(spark, subdivisions_path), countries), country_codes(countries)
