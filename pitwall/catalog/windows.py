"""Queries for window functions (W) and sorts (L)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from pitwall import functions as fx
from pitwall.catalog.registry import query, register
from pitwall.catalog.scalars import r
from pitwall.operators.ordered import RANK, carry_forward, neighbours, number_bucket, rank_edges, ranked, split_dense_rank, split_row_number
from pitwall.operators.reshape import merge_feeds
from pitwall.operators.rows import earliest, latest, qualify, qualify_first, with_group_values
from pitwall.plans import production as p

LINE = ["l_orderkey", "l_linenumber"]
LINE_COLS = [*LINE, "l_partkey", "l_suppkey", "l_shipdate"]
def ties():
    return [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]



register(
    "w01_dedupe_latest",
    lambda t: qualify_first(t.table("lineitem"), LINE, [F.col("l_shipdate").desc(), *ties()]).select(*LINE_COLS),
    f"""SELECT {', '.join(LINE_COLS)} FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def half_col():
    return F.when(F.col("l_quantity") > 25, F.col("l_shipdate"))


register(
    "w02_dedupe_nulls_last",
    lambda t: qualify_first(t.table("lineitem"), ["l_suppkey", "l_linenumber"], [half_col().desc_nulls_last(), F.col("l_tax").asc_nulls_last(), F.col("l_orderkey"), *ties()]).select(*LINE_COLS),
    f"""SELECT {', '.join(LINE_COLS)} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_linenumber
        ORDER BY CASE WHEN l_quantity > 25 THEN l_shipdate END DESC NULLS LAST, l_tax NULLS LAST, l_orderkey, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
register(
    "w03_latest_per_key", lambda t: latest(t.table("events"), ["user_id"], "ts", [F.col("event_id")]).select("user_id", "event_id", "ts", "event_type"),
    "SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1",
)
register(
    "w04_first_per_key", lambda t: earliest(t.table("events"), ["user_id", "event_type"], "ts", [F.col("event_id")]).select("user_id", "event_type", "event_id", "ts"),
    "SELECT user_id, event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
)
def bal_col():
    return F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))


register(
    "w05_row_number_nulls_last",
    lambda t: split_row_number(
        t.table("customer").select("c_custkey", "c_nationkey", bal_col().alias("bal")), ["c_nationkey"], [F.col("bal").asc_nulls_last(), F.col("c_custkey")],
        F.coalesce(number_bucket(F.col("bal"), 500), F.lit(2**40)), "place",
    ),
    f"""SELECT c_custkey, c_nationkey, {r('CASE WHEN c_acctbal > 0 THEN c_acctbal END', 'bal')},
        row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal > 0 THEN c_acctbal END NULLS LAST, c_custkey) AS place FROM customer""",
)
register(
    "w06_best_per_group",
    lambda t: qualify_first(t.table("lineitem"), ["l_suppkey", "l_returnflag"], [F.col("l_extendedprice").desc(), F.col("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")]).select(
        "l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice"),
    f"""SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, {r('l_extendedprice', 'l_extendedprice')} FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_extendedprice DESC, l_quantity, l_orderkey, l_linenumber, l_partkey) = 1""",
)
register(
    "w07_dense_rank",
    lambda t: split_dense_rank(
        t.table("customer").select("c_custkey", "c_nationkey", F.floor("c_acctbal").cast("bigint").alias("bal")), ["c_nationkey"], "bal", number_bucket(F.col("bal"), 500), "place"),
    """SELECT c_custkey, c_nationkey, CAST(floor(c_acctbal) AS BIGINT) AS bal, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY floor(c_acctbal)) AS place FROM customer""",
)


@query(
    "w08_lag_delta",
    f"""SELECT event_id, user_id, {r('lag(value) OVER w', 'previous')}, {r('value - lag(value) OVER w', 'delta')} FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def _(t):
    events = ranked(t.table("events"), ["user_id"], "ts")
    out = neighbours(events, ["user_id"], ["ts", "event_id"], F.col(RANK), prev={"previous": F.col("value")})
    return out.select("event_id", "user_id", "previous", (F.col("value") - F.col("previous")).alias("delta"))


register(
    "w09_lead",
    lambda t: neighbours(
        ranked(t.table("events"), ["user_id", "event_type"], "ts"), ["user_id", "event_type"], ["ts", "event_id"], F.col(RANK), next={"next_ts": F.col("ts"), "next_value": F.col("value")}
    ).select("event_id", "user_id", "next_ts", "next_value"),
    f"""SELECT event_id, user_id, lead(ts) OVER w AS next_ts, {r('lead(value) OVER w', 'next_value')} FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)""",
)


@query(
    "w10_group_average",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {r('l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey)', 'delta')} FROM lineitem",
)
def _(t):
    out = with_group_values(t.table("lineitem"), ["l_suppkey"], mean=F.avg("l_quantity"))
    return out.select(*LINE, "l_partkey", (F.col("l_quantity") - F.col("mean")).alias("delta"))


def clean_col():
    return F.when((F.col("l_tax") > 0.01) & (F.col("l_returnflag") != "R"), F.col("l_quantity"))




@query(
    "w11_conditional_averages",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {r('avg(clean) OVER (PARTITION BY l_suppkey)', 'own')}, {r('avg(clean) OVER (PARTITION BY l_linenumber, l_linestatus)', 'field')}
        FROM (SELECT *, CASE WHEN l_tax > 0.01 AND l_returnflag <> 'R' THEN l_quantity END AS clean FROM lineitem)""",
)
def _(t):
    out = with_group_values(t.table("lineitem"), ["l_suppkey"], own=F.avg(clean_col()))
    out = with_group_values(out, ["l_linenumber", "l_linestatus"], field=F.avg(clean_col()))
    return out.select(*LINE, "l_partkey", "own", "field")


@query(
    "w12_group_baseline",
    f"""SELECT l_suppkey, l_linenumber, {r('mean', 'mean')}, {r('min(mean) OVER (PARTITION BY l_linenumber)', 'best')}, {r('mean - min(mean) OVER (PARTITION BY l_linenumber)', 'delta')}
        FROM (SELECT l_suppkey, l_linenumber, avg(l_quantity) AS mean FROM lineitem GROUP BY ALL)""",
)
def _(t):
    means = t.table("lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.avg("l_quantity").alias("mean"))
    return with_group_values(means, ["l_linenumber"], best=F.min("mean")).withColumn("delta", F.col("mean") - F.col("best"))


def gappy_col():
    return F.when(F.col("k") % 3 == 0, F.col("value"))


_FILL_SQL = f"""SELECT event_id, user_id, {r('last_value(CASE WHEN k % 3 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)', 'filled')} FROM e_all"""


def _filled(t):
    edges = rank_edges(t.events(), ["user_id"], "ts")
    rows, again = (ranked(t.events(), ["user_id"], "ts", edges) for _ in range(2))
    out = carry_forward(rows, ["user_id"], ["ts"], {"filled": gappy_col()}, F.col(RANK), source=again)
    return out.select("event_id", "user_id", "filled")


register("w13_fill_forward", _filled, _FILL_SQL)
# first value over the descending order with the following frame looks at the same rows
register(
    "w14_fill_descending", _filled,
    f"""SELECT event_id, user_id, {r('first_value(CASE WHEN k % 3 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)', 'filled')} FROM e_all""",
)


@query(
    "w15_fill_chain",
    """SELECT session_key, driver_number, lap_number, CASE WHEN lap_number = 1 THEN st_speed ELSE coalesce(
         last_value(i1_speed IGNORE NULLS) OVER (PARTITION BY session_key, driver_number ORDER BY lap_number ROWS UNBOUNDED PRECEDING), st_speed) END AS speed FROM b_laps""",
)
def _(t):
    out = carry_forward(t["laps"], p.CAR, ["lap_number"], {"seen": F.col("i1_speed")}, number_bucket(F.col("lap_number"), 1024))
    speed = F.when(F.col("lap_number") == 1, F.col("st_speed")).otherwise(F.coalesce("seen", "st_speed"))
    return out.select(*p.LAP, speed.alias("speed"))


@query(
    "w16_nearest_ranks",
    """SELECT session_key, driver_number, lap_number, max(position) FILTER (start_position_rank = 1) AS at_start, max(position) FILTER (end_position_rank = 1) AS at_end
       FROM p_lap_positions GROUP BY ALL""",
)
def _(t):
    near = {f"at_{side}": F.min_by("position", F.struct(f"{side}_time_diff", "date")) for side in ("start", "end")}
    return p._positions_in_laps(t).groupBy(*p.LAP).agg(*[c.alias(n) for n, c in near.items()])


register(
    "w17_latest_per_minute",
    lambda t: latest(t.table("events").withColumn("minute", fx.trunc_to("minute", F.col("ts"))), ["event_type", "minute"], "ts", [F.col("event_id")]).select("event_type", "minute", "event_id", "ts"),
    "SELECT event_type, date_trunc('minute', ts) AS minute, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts) ORDER BY ts DESC, event_id) = 1",
)
register(
    "w18_global_neighbours",
    lambda t: neighbours(
        ranked(t.events().filter(F.col("k") > 50), [], "ts"), [], ["ts", "event_id"], F.col(RANK), prev={"prev_reading": F.col("ts")}, next={"next_reading": F.col("ts")}
    ).select("event_id", "prev_reading", "next_reading"),
    "SELECT event_id, lag(ts) OVER (ORDER BY ts, event_id) AS prev_reading, lead(ts) OVER (ORDER BY ts, event_id) AS next_reading FROM e_all WHERE k > 50",
)
register(
    "w19_qualify",
    lambda t: qualify(t.table("customer"), F.rank().over(Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc())), lambda c: c <= 3).select("c_custkey", "c_nationkey"),
    "SELECT c_custkey, c_nationkey FROM customer QUALIFY rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) <= 3",
)

# --- sorts and top-k ---------------------------------------------------------------------------------------

register(
    "l01_order_by", lambda t: t.table("customer").select("c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_mktsegment", F.col("c_acctbal").desc_nulls_last(), "c_custkey"),
    f"SELECT c_custkey, c_mktsegment, {r('c_acctbal', 'c_acctbal')} FROM customer ORDER BY c_mktsegment, c_acctbal DESC NULLS LAST, c_custkey",
)
register(
    "l02_newest", lambda t: t.table("events").orderBy(F.col("ts").desc(), "event_id").limit(20).select("event_id", "ts", "user_id"),
    "SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id LIMIT 20",
)


@query(
    "l03_merge_feeds",
    """SELECT ts, feed, feed_rank, driver_number FROM (SELECT date AS ts, 'car_data' AS feed, 0 AS feed_rank, driver_number FROM b_car UNION ALL
       SELECT date, 'position', 1, driver_number FROM b_position UNION ALL SELECT date, 'location', 2, driver_number FROM b_location) ORDER BY ts, feed_rank""",
)
def _(t):
    feeds = {n: t[n].select(F.col("date").alias("ts"), "driver_number") for n in ("car_data", "position", "location")}
    return merge_feeds(feeds, "ts")


register("l04_sorted_keys", lambda t: t.table("events").select("user_id").distinct().orderBy("user_id"), "SELECT DISTINCT user_id FROM events ORDER BY 1")
