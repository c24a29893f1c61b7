"""Ordered scans (neighbours, fills, ranks) that split a long group over many tasks.

A plain ordered window sends a whole group to one task.  Here each group is cut into buckets that follow the
order (a lap range, an hour, or a number of rows: `ranked`), the window runs per bucket, and only bucket boundaries or one summary row per
bucket are scanned per group.  Results are the same as the plain window for any bucketing.

`bucket` must not decrease along the order; the grouping keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pitwall.functions.times import micros
from pitwall.operators.rows import null_safe_join
from pitwall.sources.scratch import staged

_B = "_bucket"
HOUR = 3600
DAY = 24 * HOUR
#: The bucket column that `ranked` adds.
RANK = "_rank_bucket"
EDGES = "_edges"
#: Rows of a group for which a bucket is made, and buckets of a group at most.
ROWS = 100_000
MOST_EDGES = 1024


def time_bucket(at: Column, seconds: int = HOUR) -> Column:
    return F.floor(micros(at) / F.lit(seconds * 1_000_000)).cast("bigint")


def number_bucket(value: Column, width: float) -> Column:
    return F.floor(value / F.lit(width)).cast("bigint")


def _order_value(at: Column, kind: T.DataType) -> Column:
    return micros(at) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else at


def rank_edges(df: DataFrame, keys: Sequence[str], at: str, rows: int = ROWS) -> DataFrame:
    """Where to cut each large group along a column so that buckets hold about `rows` rows each: the keys and EDGES, rising values; smaller groups are left out.

    Groups are counted first, and only the rows of large ones go through a mergeable quantile sketch, so a small group costs one count and a hot one no more
    than its share of the scan.  The edges are written to the shared folder: whatever is computed again later, of the same rows or of others in their order,
    is cut at the same places.  A group of more than MOST_EDGES times `rows` rows gets larger buckets, all alike.
    """
    value = _order_value(F.col(at), df.schema[at].dataType)
    given = df.select(*keys, value.alias("_at")).filter(F.col("_at").isNotNull())
    counts = given.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows)
    large = staged(counts.select(*keys, F.least(F.ceil(F.col("_n") / rows), F.lit(MOST_EDGES)).cast("int").alias("_parts")), "large-groups")
    if large.isEmpty():
        return large.select(*keys, F.array().cast(T.ArrayType(given.schema["_at"].dataType)).alias(EDGES))
    held = given.join(large, list(keys)) if keys else given.withColumn("_parts", F.lit(large.first()["_parts"]))
    quantiles = F.percentile_approx("_at", [i / MOST_EDGES for i in range(1, MOST_EDGES)], 10 * MOST_EDGES)
    sketch = held.groupBy(*keys).agg(quantiles.alias("_q"), F.first("_parts").alias("_parts"))
    places = F.sequence(F.lit(1), F.col("_parts") - 1)
    picked = F.transform(places, lambda i: F.get(F.col("_q"), F.floor(i * MOST_EDGES / F.col("_parts")).cast("int") - 1))
    return staged(sketch.select(*keys, F.array_distinct(picked).alias(EDGES)), "rank-edges")


def ranked(df: DataFrame, keys: Sequence[str], at: str, edges: DataFrame | None = None, rows: int = ROWS) -> DataFrame:
    """The rows with their bucket in the column RANK: how many of their group's edges lie at or below their value, 0 for a group without edges and for NULL.

    Without `edges` they are taken from the rows themselves.  Pass F.col(RANK) as the bucket of the scans below; rows with equal values share a bucket.
    """
    edges = rank_edges(df, keys, at, rows) if edges is None else edges
    value = _order_value(F.col(at), df.schema[at].dataType)
    if keys:
        # one row per large group
        met = null_safe_join(df, edges, keys)
    else:
        found = edges.first()
        met = df.withColumn(EDGES, F.array(*map(F.lit, found[EDGES])) if found and found[EDGES] else F.array().cast(edges.schema[EDGES].dataType))
    halves = F.array(*[F.lit(1 << i) for i in range(MOST_EDGES.bit_length() - 1, -1, -1)])
    size = F.size(EDGES)
    below = F.aggregate(halves, F.lit(0), lambda p, s: F.when((p + s <= size) & (F.get(F.col(EDGES), p + s - 1) <= value), p + s).otherwise(p))
    return met.withColumn(RANK, F.coalesce(F.when(value.isNotNull() & (size > 0), below), F.lit(0))).drop(EDGES)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    prev: Mapping[str, Column] | None = None,
    next: Mapping[str, Column] | None = None,  # noqa: A002
) -> DataFrame:
    """Adds values of the previous and next row of the group (lag and lead by one).

    First window: inside each bucket.  Second window: the first and last row of every bucket meet in one
    small boundary group per key, all other rows stay in their bucket, so no group is ever scanned whole.
    """
    prev, next = dict(prev or {}), dict(next or {})  # noqa: A001
    asc = [F.col(c).asc() for c in order]
    out = df.withColumn(_B, bucket)
    packs = {"_p": prev, "_n": next}
    for pack, values in packs.items():
        cols = [v.alias(name) for name, v in values.items()] or [F.lit(True).alias("_")]
        out = out.withColumn(pack, F.struct(*cols))
    local = Window.partitionBy(*keys, _B).orderBy(*asc)
    out = out.select(
        "*", F.lag("_p").over(local).alias("_p1"), F.lead("_n").over(local).alias("_n1")
    )
    # both ends of a bucket go to the boundary group, each finds its missing neighbour there
    edge = F.col("_p1").isNull() | F.col("_n1").isNull()
    out = out.withColumn("_edge", edge).withColumn("_g", F.when(~F.col("_edge"), F.col(_B)))
    across = Window.partitionBy(*keys, "_edge", "_g").orderBy(*asc)
    out = out.select(
        "*", F.lag("_p").over(across).alias("_p2"), F.lead("_n").over(across).alias("_n2")
    )
    kept = [F.col(c) for c in df.columns]
    added = [F.coalesce("_p1", "_p2")[name].alias(name) for name in prev]
    added += [F.coalesce("_n1", "_n2")[name].alias(name) for name in next]
    return out.select(*kept, *added)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    bucket: Column,
    source: DataFrame | None = None,
) -> DataFrame:
    """Adds, per named value, the latest non-NULL value up to and including the current row.

    The value brought into a bucket is found in one of two ways.  With `source`, a scan that is cheap to read
    again, one summary row per bucket is aggregated from it and joined, and `df` is shuffled once.  Without, the
    first rows of the buckets hand the value on in a second window, and `df` is not computed twice.
    `source` needs at least one row for every bucket of `df`.
    """
    asc = [F.col(c).asc() for c in order]
    names = list(values)

    def prepared(d: DataFrame) -> DataFrame:
        return d.select("*", bucket.alias(_B), *[v.alias(f"_v_{n}") for n, v in values.items()])

    inside = Window.partitionBy(*keys, _B)
    so_far = inside.orderBy(*asc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = [F.last(f"_v_{n}", ignorenulls=True).over(so_far).alias(f"_l_{n}") for n in names]
    if source is None:
        joined = _carried_in_place(prepared(df), local, keys, names, inside, asc)
    else:
        at = F.struct(*[F.col(c) for c in order])
        last_of = [F.max_by(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_s_{n}") for n in names]
        summary = prepared(source).groupBy(*keys, _B).agg(*last_of)
        before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.select(*keys, _B, *[F.last(f"_s_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in names])
        joined = prepared(df).select("*", *local).join(carry, [*keys, _B], "left")
    return joined.select(
        *[F.col(c) for c in df.columns], *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in names]
    )


def _first_rows(rows: DataFrame, keys: Sequence[str]):
    """Frame over the first rows of all earlier buckets of the group; other rows stay with their bucket."""
    marked = rows.withColumn("_first", F.col("_r") == 1).withColumn("_g", F.when(~F.col("_first"), F.col(_B)))
    across = Window.partitionBy(*keys, "_first", "_g").orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    return marked, across


def _carried_in_place(rows: DataFrame, local, keys: Sequence[str], names: Sequence[str], inside, asc) -> DataFrame:
    whole = inside.orderBy(*asc).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "*", *local, F.row_number().over(inside.orderBy(*asc)).alias("_r"),
        *[F.last(f"_v_{n}", ignorenulls=True).over(whole).alias(f"_s_{n}") for n in names],
    )
    marked, across = _first_rows(rows, keys)
    handed = marked.select("*", *[F.last(f"_s_{n}", ignorenulls=True).over(across).alias(f"_h_{n}") for n in names])
    spread = [F.first(F.when(F.col("_first"), F.struct(F.col(f"_h_{n}").alias("v"))), ignorenulls=True).over(inside)["v"].alias(f"_c_{n}") for n in names]
    return handed.select("*", *spread)


def split_row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, out: str, source: DataFrame | None = None
) -> DataFrame:
    """Position of each row in its group: position in the bucket plus the rows of all earlier buckets.

    As in `carry_forward`, the sizes of earlier buckets come from a cheap second scan (`source`, the same rows)
    or are handed on by the first rows of the buckets.
    """
    inside = Window.partitionBy(*keys, _B)
    rows = df.withColumn(_B, bucket).select(
        "*", F.row_number().over(inside.orderBy(*order)).alias("_r"), F.count("*").over(inside).alias("_k")
    )
    if source is None:
        marked, across = _first_rows(rows, keys)
        summed = marked.withColumn("_o", F.sum("_k").over(across))
        shifted = summed.withColumn("_o", F.max(F.when(F.col("_first"), F.col("_o"))).over(inside))
    else:
        before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
        sizes = source.withColumn(_B, bucket).groupBy(*keys, _B).agg(F.count("*").alias("_n"))
        shifted = rows.join(sizes.select(*keys, _B, F.sum("_n").over(before).alias("_o")), [*keys, _B], "left")
    place = F.col("_r") + F.coalesce("_o", F.lit(0))
    return shifted.select(*[F.col(c) for c in df.columns], place.cast("bigint").alias(out))


def split_running_total(df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, number: str, before: str, total: str) -> DataFrame:
    """Adds the sum of a number over all earlier rows of the group, and over the whole group, in one pass: buckets are summed up in place and hand their sums on by
    their first rows."""
    inside = Window.partitionBy(*keys, _B)
    ordered = inside.orderBy(*order)
    rows = df.withColumn(_B, bucket).select(
        "*", F.row_number().over(ordered).alias("_r"), F.sum(number).over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias("_i"), F.sum(number).over(inside).alias("_k"))
    marked, across = _first_rows(rows, keys)
    whole = Window.partitionBy(*keys, "_first", "_g")
    summed = marked.select("*", F.sum("_k").over(across).alias("_o"), F.sum("_k").over(whole).alias("_t"))
    # all but a bucket's first row take over what that one was handed
    out = summed.select("*", F.max(F.when(F.col("_first"), F.struct(F.coalesce("_o", F.lit(0)).alias("o"), F.col("_t").alias("t")))).over(inside).alias("_h"))
    return out.select(*[F.col(c) for c in df.columns], (F.coalesce("_i", F.lit(0)) + F.col("_h.o")).alias(before), F.col("_h.t").alias(total))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], bucket: Column) -> DataFrame:
    """The named numbers replaced by their sums over the group up to and including the current row; NULL counts as zero."""
    inside = Window.partitionBy(*keys, _B)
    so_far = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = df.withColumn(_B, bucket)
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*keys, _B).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    sizes = sizes.select(*keys, _B, *[F.sum(f"_t_{v}").over(before).alias(f"_o_{v}") for v in values])
    here = cut.select(*[c for c in df.columns if c not in values], _B, *[F.sum(v).over(so_far).alias(f"_i_{v}") for v in values])
    joined = here.join(sizes, [*keys, _B], "left")
    return joined.select(*[(F.coalesce(f"_i_{c}", F.lit(0)) + F.coalesce(f"_o_{c}", F.lit(0))).alias(c) if c in values else F.col(c) for c in df.columns])


def split_dense_rank(df: DataFrame, keys: Sequence[str], value: str, bucket: Column, out: str, descending: bool = False) -> DataFrame:
    """dense_rank over one value: distinct values are counted first, so ties never meet in a window."""
    distinct = df.select(*keys, value).distinct()
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    ranked = split_row_number(distinct, keys, [order], bucket, out)
    renamed = ranked.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(value).alias("_rv"), out)
    cond = df[value].eqNullSafe(renamed["_rv"])
    for k in keys:
        cond = cond & (df[k] == renamed[f"_r_{k}"])
    return df.join(renamed, cond, "left").select(*df.columns, out)
