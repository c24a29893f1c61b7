"""From raw documents to token files: the stages of a training-data run, each on all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a table; it is written to the shared folder as Parquet and read again as the next one's documents, so a lost
executor costs at most the tasks of one stage. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import decontaminate, mixing, near_dedup, toxicity
from pitwall.llm.queries import prepared, token_digest
from pitwall.sources.scratch import staged

#: Words of a shingle and bits two fingerprints may differ in.
SHINGLE, RADIUS = 4, 4
#: Consecutive benchmark words that make a document contaminated.
WINDOW = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels, doesn't reject, unchanged.

    Each row is judged by its text alone: null and empty texts have no features and stay, rows without an id and repeated rows are judged like any other, a long
    text is scored whole. A label without an id or value teaches nothing; without labels of both kinds all rows get one score. Further columns, whatever their
    names, stay. An empty table stays empty.
    """
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, unchanged: the one with the smallest id.

    Null, empty and wordless texts are near copies of each other. Of rows that share the smallest id, and of groups without any id, the least row stays; equal
    rows become one. Long texts are hashed whole. Further columns stay; an empty table stays empty.
    """
    prepared(spark)
    return near_dedup.one_per_component(docs, SHINGLE, RADIUS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item, unchanged.

    Null, empty and wordless texts hold none. Rows without an id, repeated rows and texts that share an id are each judged by their own text, whole. Items without
    words or without an id: the former make no window, the latter's windows count. Further columns, whatever their names, stay; without documents or items nothing goes.
    """
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"), WINDOW)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, in training order.

    A document without words, null and empty ones too, adds nothing to a mix and has no copy. A null source is a source of its own, the last. Ties are ordered by
    hashes of id and text, so reruns agree; repeated rows and rows without an id are documents each. Further columns stay; an empty table stays empty.
    """
    prepared(spark)
    return mixing.in_training_order(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold per document, read back from them.

    A null text counts as empty and is its end id alone. Documents are written in ascending order of id, without an id first, equal ids by text. No documents give
    no shard and no row. Only id and text are written.
    """
    prepared(spark)
    return token_digest(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_benchmark), ("mixing", mix_sources), ("token_files", write_tokens),
]

#: Boosted trees and byte-pair encoding can't be put into SQL; tests/llm/test_pipeline.py checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
