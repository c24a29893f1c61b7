"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pitwall.llm.columns import blank_words, free_name
from pitwall.sources.scratch import staged

#: Rows of one source that one prefix-sum bucket holds on average.
BUCKET_ROWS = 10_000


@dataclass(frozen=True)
class Schedule:
    """A source's weight over training time 0..1: linear between the knots (time, weight); the first knot is at 0, the last at 1."""

    knots: tuple[tuple[float, float], ...]

    def total(self) -> float:
        """The weight integrated over training."""
        return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]))

    def time_of(self, share: Column) -> Column:
        """The time by which a share 0..1 of the schedule's whole demand has come: the inverse of the integrated weight."""
        whole, done, out = self.total(), 0.0, None
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            area = (t1 - t0) * (w0 + w1) / 2
            rest, slope = share * whole - F.lit(done), (w1 - w0) / (t1 - t0)
            # rest = w0 x + slope x² / 2, in the form that stays stable for a flat piece
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
            step = F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (F.lit(w0) + root))
            at = F.least(F.lit(t0) + step, F.lit(t1))
            out = at if out is None else F.when(share * whole <= F.lit(done), out).otherwise(at)
            done += area
        return out


#: Source classes in order of rank, repeating: a large share that falls over time, an even one, and a small one that rises. Totals are 5, 2 and 1.
CURRICULUM = (Schedule(((0.0, 7.0), (0.5, 5.0), (1.0, 3.0))), Schedule(((0.0, 2.0), (1.0, 2.0))), Schedule(((0.0, 0.5), (1.0, 1.5))))


def targets(sizes: DataFrame, schedules: tuple[Schedule, ...] = CURRICULUM, budget: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """Adds class (index of the schedule) and target (words) to one row per source: source, source_size.

    Sources by code point, null last, take the schedules in turn; a schedule's integral is its weight. All sources share `budget` (a fraction) of
    all words by weight; none gets more than `cap` times its size, and what it can't take is shared by weight among the rest. The fixed point is
    found by one sort: sources that reach their cap first come first. Integral weights keep every sum exact.
    """
    weights = [round(s.total(), 9) for s in schedules]
    whole = all(w == int(w) for w in weights)
    weight = F.element_at(F.array(*(F.lit(int(w) if whole else w) for w in weights)), F.col("class") + 1)
    # one row per source; the window is over sources, not documents
    ranked = sizes.withColumn("class", ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(schedules)).cast("int")).withColumn("w", weight)
    fills_first = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    up_to = fills_first.rowsBetween(Window.unboundedPreceding, -1)
    room = ranked.withColumn("left_n", budget[0] * F.sum("source_size").over(everything) - budget[1] * cap * F.coalesce(F.sum("source_size").over(up_to), F.lit(0)))
    room = room.withColumn("left_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(up_to), F.lit(0)))
    # full: the level that would be left for this source and all later ones exceeds its cap
    room = room.withColumn("full", F.col("left_n") * F.col("w") > F.col("left_w") * budget[1] * cap * F.col("source_size"))
    open_n = F.max(F.when(~F.col("full"), F.struct(F.col("left_w"), F.col("left_n")))).over(everything)
    level = F.col("w") * open_n["left_n"] / (budget[1] * open_n["left_w"])
    return room.select("source", "source_size", "class", F.when(F.col("full"), F.col("source_size") * cap).otherwise(level).cast("double").alias("target"))


def _lined(docs: DataFrame, schedules: tuple[Schedule, ...], budget: tuple[int, int], cap: int, doc_id: str, text: str, source: str) -> DataFrame:
    """Per row of `docs`: row (a number of its own), doc_id, source, size, source_size, class, target, t (a hash of the text), and begin, the words of the source's
    line before it."""
    rows = staged(docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), blank_words(F.col(f"`{text}`")).alias("size"),
        F.conv(F.substring(F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long").alias("h"),
        F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("t"),
    ), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    shares = targets(sources.select("source", "source_size"), schedules, budget, cap)
    width = (F.floor(F.lit(1 << 60) / F.ceil(F.col("n") / BUCKET_ROWS)) + 1).cast("long")
    sources = staged(shares.join(sources.select(F.col("source").alias("s"), width.alias("width")), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumnRenamed("source", "s"), "sources")
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("bucket", F.floor(F.col("h") / F.col("width")).cast("long"))
    words = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = words.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "t", "size").rowsBetween(Window.unboundedPreceding, -1)
    lined = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    lined = lined.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return lined.select("row", "doc_id", "source", "size", "source_size", "class", "target", "t", (F.col("before") + F.col("within")).alias("begin"))


def _positions(schedules: tuple[Schedule, ...], cap: int) -> Column:
    """The training positions of a row's copies, in order: its copy in pass c of the line is taken when its middle word lies before the target."""
    found = []
    for c in range(cap):
        at = F.col("begin") + F.col("source_size") * c
        share = F.least(F.try_divide(at, F.col("target")), F.lit(1.0))
        time = F.coalesce(*(F.when(F.col("class") == i, s.time_of(share)) for i, s in enumerate(schedules)))
        found.append(F.when((F.col("size") > 0) & (at + F.col("size") / 2 <= F.col("target")), time))
    return F.array_compact(F.array(*found))


def mixed(docs: DataFrame, schedules: tuple[Schedule, ...] = CURRICULUM, budget: tuple[int, int] = (3, 2), cap: int = 2,
          doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of `docs`: doc_id, source, size (words), source_size, target, copies, taken (words), position.

    Documents of a source are lined up by a hash of their id (ties by a hash of the text; rows alike in both are interchangeable). The line is
    repeated `cap` times, and the copies before the target are taken, so every source ends within half a document of its target. `position`, between
    0 and 1, is the training time of the first copy: the share of the source's demand met before it, put through the inverse of the source's
    integrated schedule; null without a copy. Documents without words get no copy.

    Texts aren't moved: only ids, sizes and hashes are grouped. Cumulative words are prefix sums over buckets of a source (a hash range each, so a
    source with a third of all rows is many buckets) and then over the rows of a bucket. A null source is a source; a null text has no words, and a
    null id is hashed as an empty one.
    """
    rows = _lined(docs, schedules, budget, cap, doc_id, text, source).withColumn("positions", _positions(schedules, cap))
    copies = F.size("positions")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"), F.get("positions", F.lit(0)).alias("position"))


def _ordered(docs: DataFrame, schedules: tuple[Schedule, ...], budget: tuple[int, int], cap: int, doc_id: str, text: str, source: str) -> tuple[DataFrame, DataFrame, str, str]:
    """The plan (row, doc_id, source, size, source_size, target, t, positions) and the mix: rows of `docs`, one per copy, range-sorted by position, and the names of
    two more columns of it, the plan's row and the position."""
    rows = _lined(docs, schedules, budget, cap, doc_id, text, source)
    plan = staged(rows.select("row", "doc_id", "source", "size", "source_size", "target", "t", _positions(schedules, cap).alias("positions")), "positions")
    at, of = free_name(docs, "position"), free_name(docs, "plan_row")
    taken = plan.select(*(F.col(c).alias(f"plan_{c}") for c in ("row", "doc_id", "source", "t", "positions")))
    several = taken.groupBy("plan_doc_id").count().filter("count > 1 or plan_doc_id is null")
    if several.isEmpty():
        met = docs.alias("d").join(taken.filter(F.size("plan_positions") > 0).alias("p"), F.col(f"d.`{doc_id}`") == F.col("p.plan_doc_id"))
    else:
        number = free_name(docs, "number")
        alike = Window.partitionBy("plan_doc_id", "plan_source", "plan_t")
        taken = taken.filter(F.size("plan_positions") > 0).withColumn("plan_number", F.row_number().over(alike.orderBy("plan_positions")))
        t = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"))
        rest = [F.col(f"`{c}`") for c, kind in docs.dtypes if c not in (doc_id, text, source) and not kind.startswith("map")]
        numbered = docs.withColumn(number, F.row_number().over(Window.partitionBy(F.col(f"`{doc_id}`"), F.col(f"`{source}`"), t).orderBy(*rest or [F.lit(0)])))
        met = numbered.alias("d").join(taken.alias("p"), F.col(f"d.`{doc_id}`").eqNullSafe(F.col("p.plan_doc_id")) & F.col(f"d.`{source}`").eqNullSafe(F.col("p.plan_source"))
                                       & (F.md5(F.coalesce(F.col(f"d.`{text}`"), F.lit("")).cast("binary")) == F.col("p.plan_t")) & (F.col(f"d.`{number}`") == F.col("p.plan_number")))
    copies = met.select(*(F.col(f"d.`{c}`") for c in docs.columns), F.col("p.plan_row").alias(of), F.explode("p.plan_positions").alias(at))
    return plan, copies.repartitionByRange(at).sortWithinPartitions(at), of, at


def in_training_order(docs: DataFrame, schedules: tuple[Schedule, ...] = CURRICULUM, budget: tuple[int, int] = (3, 2), cap: int = 2,
                      doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it takes it, range-sorted by training position; the columns are unchanged.

    Texts move twice, to meet their positions and to be sorted. Rows meet by id; where ids repeat or are null, also by text hash, source and number
    within those.
    """
    _, mix, of, at = _ordered(docs, schedules, budget, cap, doc_id, text, source)
    return mix.drop(of, at)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, and position rounded to nine digits; the last three are read off the mix in training order, whose texts are
    counted as they stand there."""
    plan, mix, of, at = _ordered(docs, CURRICULUM, (3, 2), 2, "doc_id", "text", "source")
    copies = staged(mix.select(F.col(of).alias("of"), blank_words(F.col("text")).alias("words"), F.col(at).alias("at")), "mix")
    took = copies.groupBy("of").agg(F.sum("words").cast("long").alias("taken"), F.count("*").cast("int").alias("copies"), F.min("at").alias("position"))
    met = plan.join(took, plan["row"] == took["of"], "left")
    return met.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), F.coalesce("copies", F.lit(0)).alias("copies"),
                      F.round("position", 9).alias("position"))


#: The same mix in DuckDB.
ORACLE = """
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS t, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][class + 1] AS weight FROM s),
r AS (SELECT *, 3 * sum(source_size) OVER ()::BIGINT - 4 * coalesce(sum(source_size) OVER before, 0)::BIGINT AS left_n,
             sum(weight) OVER ()::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT AS left_w
      FROM w WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, left_n * weight > left_w * 4 * source_size AS filled FROM r),
o AS (SELECT left_n, left_w FROM f WHERE NOT filled ORDER BY left_w DESC LIMIT 1),
g AS (SELECT f.source, f.source_size, class, CASE WHEN filled THEN (2 * source_size)::DOUBLE ELSE (weight * o.left_n)::DOUBLE / (2 * o.left_w)::DOUBLE END AS target FROM f LEFT JOIN o ON true),
l AS (SELECT doc_id, size, source_size, class, target,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, t, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT *, (size > 0 AND b + size / 2 <= target)::INTEGER AS c0, (size > 0 AND b + source_size + size / 2 <= target)::INTEGER AS c1 FROM l),
p AS (SELECT *, least(b / nullif(target, 0), 1.0) AS x FROM c),
q AS (SELECT *, CASE class
        WHEN 0 THEN CASE WHEN x * 5.0 <= 3.0 THEN 2 * (x * 5.0) / (7.0 + sqrt(greatest(49.0 - 8.0 * (x * 5.0), 0)))
                         ELSE 0.5 + 2 * (x * 5.0 - 3.0) / (5.0 + sqrt(greatest(25.0 - 8.0 * (x * 5.0 - 3.0), 0))) END
        WHEN 1 THEN 2 * (x * 2.0) / (2.0 + sqrt(4.0::DOUBLE)) ELSE 2 * x / (0.5 + sqrt(0.25 + 2.0 * x)) END AS time FROM p)
SELECT doc_id, size, source_size, target, size * (c0 + c1) AS taken, c0 + c1 AS copies, CASE WHEN c0 + c1 > 0 THEN round(least(time, 1.0), 9) END AS position FROM q
"""
