"""Materialisation of models and the seed lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# DRS state codes and their labels.
DRS_LABELS = {
    0: "OFF", 1: "OFF", 2: "OFF", 3: "UNKNOWN", 8: "DETECTED", 9: "UNKNOWN", 10: "ON", 11: "UNKNOWN", 12: "ON", 13: "UNKNOWN", 14: "ON",
    15: "UNKNOWN",
}
SEED_SCHEMA = "drs_state int, drs_label string"


def write_seed(spark: SparkSession, path: str) -> None:
    spark.createDataFrame(list(DRS_LABELS.items()), SEED_SCHEMA).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_seed(spark: SparkSession, path: str, schema: str = SEED_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def with_drs_label(df: DataFrame, seed: DataFrame) -> DataFrame:
    """Adds the label of the DRS state; the planner broadcasts the seed by its size."""
    return df.join(seed, df["drs"] == seed["drs_state"], "left").drop("drs_state")


def materialise(spark: SparkSession, df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """Keeps a model as a `view` or as a `table` at a path and returns it; incremental models use `merge`."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").parquet(path)
        spark.read.parquet(path).createOrReplaceTempView(name)
    else:
        raise ValueError(f"unknown materialisation {kind}")
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Writes a table into a fixed number of buckets by its keys, each sorted by them, under a name of the session's catalogue, and returns it.

    Tables with equal keys and buckets join, group and rank by these keys where they lie, with no exchange.  Rows are dealt out by bucket before they are
    written, one file each; a key that holds most rows makes its bucket large, so this is for tables whose keys are even, such as laps and cars.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
