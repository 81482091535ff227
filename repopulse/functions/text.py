"""Text clean-up, change hash and node ids; all JVM-side expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on them.
COMPANY_LEADING_AT = r"^@"
COMPANY_DROPPED_CHARACTERS = r"[^\p{L}\p{N}\s\-_&,().]"
LOCATION_PUNCTUATION = r"[()\[\],]"
UNICODE_BLANKS = r"(?U)\s+"
EMPTY_LOCATION_WORDS = ("null", "none", "nan", "")
CHANGE_HASH_SEPARATOR = "|"
CHANGE_HASH_COLUMNS = ("name", "country", "company")
USER_NODE_PREFIX = "04:User"
BOT_LOGIN_SUFFIX = "[bot]"


def strip_company(company: Column | str) -> Column:
    """One leading @ and all symbols outside the kept classes removed."""
    without_at = F.regexp_replace(company, COMPANY_LEADING_AT, "")
    return F.regexp_replace(without_at, COMPANY_DROPPED_CHARACTERS, "")


def clean_company(company: Column | str) -> Column:
    return F.trim(F.initcap(strip_company(company)))


def clean_location(location: Column | str) -> Column:
    """Brackets and commas to blanks, blanks squeezed; filler words to null."""
    col = F.col(location) if isinstance(location, str) else location
    spaced = F.regexp_replace(col, LOCATION_PUNCTUATION, " ")
    squeezed = F.trim(F.regexp_replace(spaced, UNICODE_BLANKS, " "))
    return F.when(~F.lower(col).isin(*EMPTY_LOCATION_WORDS), squeezed)


def change_hash(columns: Sequence[str] = CHANGE_HASH_COLUMNS) -> Column:
    """SHA-256 over the tracked columns, null read as empty text."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    return F.sha2(F.concat_ws(CHANGE_HASH_SEPARATOR, *parts), 256)


def user_node_id(user_id: Column | str) -> Column:
    text = F.concat(F.lit(USER_NODE_PREFIX), F.col(user_id) if isinstance(user_id, str) else user_id)
    return F.base64(F.encode(text, "UTF-8"))


def is_person(login: Column | str) -> Column:
    """Not a bot login. A null login is neither, so a filter drops it."""
    col = F.col(login) if isinstance(login, str) else login
    return ~col.endswith(BOT_LOGIN_SUFFIX)
