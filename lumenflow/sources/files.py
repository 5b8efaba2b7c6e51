"""File readers: delimited text, Parquet and the month seed.

Spark splits files into ``spark.sql.files.maxPartitionBytes`` pieces, so
the fixed-size chunks of a one-process loader become parallel splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SEED_SCHEMA = "month_year string"   # never inferred: 2023-10 would become a timestamp


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                   schema: str | None = None) -> DataFrame:
    """Delimited text with a header.  Without ``schema`` the types are
    inferred over the whole input (one extra pass), not from a sample."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def read_by_extension(spark: SparkSession, path: str, sep: str = ",", schema: str | None = None) -> DataFrame:
    """``.csv`` is tested first, then ``.parquet``; anything else is refused."""
    if ".csv" in path:
        return read_delimited(spark, path, sep=sep, schema=schema)
    if ".parquet" in path:
        return spark.read.parquet(path)
    raise ValueError(f"only .csv or .parquet inputs are loaded, got {path!r}")


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The month seed, declared as text."""
    return read_delimited(spark, path, schema=SEED_SCHEMA)
