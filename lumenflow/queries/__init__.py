"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

One module per pipeline registers its queries with ``@query``.  Hashed
outputs leave out clock columns (``etl_date``) and carry explicit aliases
so their names equal the SQL oracle's.  Queries that write do so below the
session's shared folder (``spark.checkpoint.dir``), each run in a fresh
sub-folder, and return the written table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def wrap(fn: Query) -> Query:
        if name in _REGISTRY and _REGISTRY[name] is not fn:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = fn
        return fn
    return wrap


def all_queries() -> dict[str, Query]:
    from lumenflow.queries import address, cdc, functions, ingest, segmentation  # noqa: F401
    return dict(_REGISTRY)
