"""Actor details made ready for the slowly changing dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from repopulse.functions.text import change_hash, clean_company
from repopulse.operators.country import with_country, with_country_code
from repopulse.operators.latest import latest_per_key
from repopulse.operators.scd2 import first_versions

DIMENSION_COLUMNS = (
    "user_id", "login", "name", "company", "location",
    "followers_count", "following_count", "user_created_at", "user_updated_at",
    "ingested_at", "country", "country_code",
    "valid_from", "valid_to", "is_current", "hash_diff",
)


def prepare_actor_details(
    raw: DataFrame, places: DataFrame, codes: DataFrame, batch_time: datetime
) -> DataFrame:
    """Latest detail per actor with clean company, country, code, validity and change hash."""
    cleaned = latest_per_key(raw, "user_id", ["ingested_at"]).withColumn(
        "company", clean_company("company")
    )
    located = with_country_code(with_country(cleaned, places), codes)
    versions = first_versions(located, batch_time).withColumn("hash_diff", change_hash())
    return versions.select(*DIMENSION_COLUMNS)
