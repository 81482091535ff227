"""What several operators share: tables, scratch tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a table in the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name) + "/table"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def per_row(
    df: DataFrame, schema: str, columns: tuple[str, ...], make: Callable[[], Callable]
) -> DataFrame:
    """Map each row to any number of rows of ``schema`` in Arrow batches.

    ``make`` is called once per task and returns a function from the named
    columns' values to a list of tuples. Output batches are cut after 2,000 rows.
    """
    arrow_schema = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = make()
        for batch in batches:
            out: list[tuple] = []
            for values in zip(*(batch.column(name) for name in columns)):
                out.extend(rows_of(*(value.as_py() for value in values)))
                if len(out) >= 2000:
                    yield to_batch(out, arrow_schema)
                    out = []
            if out:
                yield to_batch(out, arrow_schema)

    return df.select(*columns).mapInArrow(run, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, schema)],
        schema=schema,
    )


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front so that no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
