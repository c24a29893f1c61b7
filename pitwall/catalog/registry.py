"""All registered queries with their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pitwall.catalog.oracle import BLOCKS, rounded, statement
from pitwall.session import configure
from pitwall.sources.bindings import Feeds, feeds_for


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Feeds], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded to six digits, dates as text, text arrays joined: the form both engines agree on."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # the shift decides exact ties of the sixth digit alike, whatever the order of summation;
            # adding zero turns -0.0 into 0.0
            c = F.round(c.cast("double") + F.lit(1e-9), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, build: Callable[[Feeds], DataFrame], sql: str | None = None) -> None:
    """`build` gets the feeds of one data folder; `sql` may use the blocks of `oracle`."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = Query(name, build, statement(sql) if sql else None)


def query(name: str, sql: str | None = None):
    def wrap(build):
        register(name, build, sql)
        return build

    return wrap


def block(name: str, doubles: str = "", dates: str = "", drop: str = "") -> str:
    assert name in BLOCKS, name
    return rounded(name, doubles, dates, drop)


def load_all() -> dict[str, Query]:
    from pitwall.catalog import aggregates, joins, models, movement, quality, scalars, streams, windows  # noqa: F401

    return QUERIES


def runnable(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(q.build(feeds_for(configure(spark), sf_dir)))

    return run
