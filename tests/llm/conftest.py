from __future__ import annotations

import pytest
from pyspark.sql import functions as F

LONG = "\n".join(f"long line {k} of {k * 7 % 1000} words with token{k}" for k in range(8000))
CLASHING = (
    "bucket tail part n_lines n_removed n_shingles component_id kept score predicted held_out "
    "length start piece sequence_id fingerprint words runs lines run place _gone _leaks _cut_id "
    "_place _id quality text_key rep node band key set"
).split()

AWKWARD = [
    (1, "one two three four five six seven eight nine ten"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "one"),
    (6, "One two three four five six seven eight nine ten"),
    (7, "first line of this text here\nsecond line of it all here\nthird line is also here now"),
    (8, "something else on top of this\nsecond line of it all here\nthird line is also here now"),
    (8, "another text with the same number, longer than five words"),
    (9, "repeated row of several words in a text"),
    (9, "repeated row of several words in a text"),
    (10, LONG),
    (11, LONG + " tail"),
    (12, "é ü 漢字 　 wide blank   and 🙂 emoji \U0001f600 <|endoftext|> x"),
    (None, "a text without a number but with words enough"),
    (None, None),
    (13, "a" * 5000),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, equal ids, repeated rows, columns of clashing names."""
    docs = spark.createDataFrame(
        [(d, t, None if d == 4 else "en", None) for d, t in AWKWARD],
        "doc_id long, text string, lang string, source string",
    ).withColumn("n_chars", F.length("text").cast("long"))
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit("taken"))
    return docs.repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


def keyed(rows) -> list[tuple]:
    """Rows as tuples in an order that nulls do not upset."""
    return sorted((tuple(row) for row in rows), key=lambda row: tuple(map(str, row)))
