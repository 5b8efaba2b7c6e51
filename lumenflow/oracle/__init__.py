"""Independent DuckDB SQL for every registered query.

Each entry re-derives its inputs from the raw driver tables (views
``lineitem``, ``supplier``, ... are registered by the checker) and states
the rule in plain SQL, so a mistake in the Spark code cannot hide in a
shared helper.
"""

from __future__ import annotations


def all_sql() -> dict[str, str]:
    from lumenflow.oracle import pipelines, segmentation
    out = segmentation.segmentation_sql()
    out.update(pipelines.more_sql())
    return out
