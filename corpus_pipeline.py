"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it again as the next one's docs.
Every stage works on all that its predecessor kept; all but the last return the
columns of ``documents``.  Rows are judged as the operators' docstrings say for
nulls, empty texts, ties and repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenflow.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from lumenflow.llm.queries import table, tokenizer_path
from lumenflow.session import materialize

# not expressible in SQL (a fitted lexicon, weighted sampling, packing)
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not call toxic; it is learnt from the
    labelled documents among ``docs``, held-out ones apart."""
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), toxicity.crc_held_out)
    return toxicity.drop_toxic(docs, lexicon)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the row with the smallest doc_id."""
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the target proportions, as many tokens as there are; a row is
    repeated for each epoch that takes it."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(packing.token_pieces(docs, tokenizer_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
