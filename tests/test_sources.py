"""Landing, merge and materialisation on files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitwall.schemas import SCHEMAS
from pitwall.operators import checks
from pitwall.operators.rows import with_group_values
from pitwall.sources import landing, merge
from pitwall.sources.scratch import path_exists, remove_path, scratch_path, staged

NOW = dt.datetime(2024, 6, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_json_arrays_and_tokens(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([
        {"session_key": 1, "driver_number": "4", "date": "2024-01-01T00:00:00.5+00:00", "gap_to_leader": "None", "interval": 1.5},
        {"session_key": 2, "date": "", "gap_to_leader": "+1 LAP", "extra": 1},
    ]))
    got = rows(landing.read_json_landing(spark, str(tmp_path), "intervals"))
    assert got == [(None, 1, 4, dt.datetime(2024, 1, 1, 0, 0, 0, 500000), None, "1.5"), (None, 2, None, None, "+1 LAP", None)]


def test_conform_strict_raises(spark):
    df = spark.createDataFrame([("fast",)], "speed string")
    assert landing.conform(df, SCHEMAS["car_data"]).select("speed").first()[0] is None
    with pytest.raises(Exception):
        landing.conform(df, SCHEMAS["car_data"], strict=True).select("speed").collect()


def test_landing_prunes_sessions(spark):
    root = scratch_path(spark, "land")
    df = spark.createDataFrame([(s, 1, NOW, 1, 5) for s in (1, 2, 3)], SCHEMAS["position"])
    landing.write_landing(df, root, "position")
    got = landing.read_landing(spark, root, "position", [2])
    assert got.count() == 1 and got.schema.names == SCHEMAS["position"].names
    filters = next(line for line in got._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line)
    assert "session_key" in filters.split("PartitionFilters: [")[1].split("]")[0]


def test_merge_rows(spark):
    schema = "k int, v string, created_at timestamp_ntz, updated_at timestamp_ntz"
    old = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([(1, "a", old, old), (2, "b", old, old), (None, "n", old, old)], schema)
    batch = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k int, v string")
    got = rows(merge.merge_rows(target, batch, ["k"], NOW))
    # a NULL key matches nothing, so both rows stay
    want = [(1, "a", old, old), (2, "B", old, NOW), (3, "c", NOW, NOW), (None, "n", old, old), (None, "m", NOW, NOW)]
    assert got == sorted(want, key=repr)
    empty = batch.filter("false")
    assert rows(merge.merge_rows(target, empty, ["k"], NOW)) == rows(target)
    assert rows(merge.merge_rows(target.filter("false"), batch.filter("k = 3"), ["k"], NOW)) == [(3, "c", NOW, NOW)]


def test_upsert_is_idempotent_and_touches_only_its_partitions(spark):
    path = scratch_path(spark, "up")
    base = spark.createDataFrame([(i, i * 10, i % 2) for i in range(6)], "k int, v int, p int")
    merge.upsert(spark, path, base, ["k"], "p")
    untouched = {f for f in spark.read.parquet(path).filter("p = 1").inputFiles() if "p=1" in f}
    batch = base.filter("k in (0, 2)").withColumn("v", F.lit(7)).unionByName(spark.createDataFrame([(8, 80, 0)], base.schema))
    for _ in range(2):
        merge.upsert(spark, path, batch, ["k"], "p")
    assert rows(spark.read.parquet(path).select("k", "v")) == [(0, 7), (1, 10), (2, 7), (3, 30), (4, 40), (5, 50), (8, 80)]
    assert untouched <= set(spark.read.parquet(path).inputFiles())


def test_upsert_keeps_one_row_of_repeated_keys(spark):
    path = scratch_path(spark, "dup")
    batch = spark.createDataFrame([(1, 5, 0), (1, 6, 0)], "k int, v int, p int")
    merge.upsert(spark, path, batch, ["k"], "p", order=[F.col("v").desc()])
    assert rows(spark.read.parquet(path).select("k", "v")) == [(1, 6)]


def test_incremental_look_back(spark):
    path, day = scratch_path(spark, "inc"), dt.datetime(2024, 1, 10)
    schema = "k int, at timestamp_ntz, v int, day date"

    def source(items):
        df = spark.createDataFrame([(k, t, v, t.date()) for k, t, v in items], schema)
        return lambda after: df if after is None else df.filter(F.col("at") >= F.lit(after))

    first = [(1, day, 1), (2, day - dt.timedelta(days=5), 1)]
    merge.incremental_load(spark, path, source(first), ["k"], "at", "day")
    inside, outside = (3, day - dt.timedelta(days=2), 1), (4, day - dt.timedelta(days=4), 1)
    merge.incremental_load(spark, path, source([*first, inside, outside]), ["k"], "at", "day")
    assert rows(spark.read.parquet(path).select("k")) == [(1,), (2,), (3,)]
    # a row older than the look-back arrives with a full rebuild only
    assert merge.lookback_bound(spark, path, "at") == day - dt.timedelta(days=3)


def test_session_selection(spark):
    s = spark.createDataFrame(
        [(1, day(1), day(2)), (1, day(1), day(2)), (2, day(1), day(5)), (3, day(1), None), (4, None, day(3))], "k int, a timestamp_ntz, b timestamp_ntz"
    )
    # an end on the lower bound counts, one on the upper bound does not
    assert [r["k"] for r in landing.discover_sessions(s, "k", "a", "b", day(2), day(5)).collect()] == [1]
    assert rows(landing.absent_only(s.select("k"), s.filter("k < 3"), ["k"])) == [(3,), (4,)]
    calendar = landing.session_calendar(s, "a", ["k"])
    assert rows(landing.sessions_on(calendar, day(1).date()).select("k")) == [(1,), (2,), (3,)]
    assert landing.sessions_on(calendar, day(9).date()).count() == 0


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, n)


def test_names_and_audit(spark):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "k int, gap double")
    assert rows(landing.standard_names(df, ["gap"])) == [(1, "2.5"), (2, "None")]
    out = landing.with_audit(df.withColumn("created_at", F.when(F.col("k") == 1, F.lit(day(1)).cast("timestamp_ntz"))), NOW)
    assert rows(out.select("k", "created_at", "processed_date")) == [(1, day(1), NOW.date()), (2, NOW, NOW.date())]


def test_scratch_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")


def _merge(spark, path, data, **how):
    merge.upsert(spark, path, spark.createDataFrame(data, "k int, v string, p string"), ["k"], "p", **how)
    return rows(spark.read.parquet(path).select("k", "v", "p"))


def test_upsert_keeps_rows_without_a_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    _merge(spark, path, [(1, "a", None), (2, "b", "x")])
    assert _merge(spark, path, [(3, "c", None)]) == [(1, "a", None), (2, "b", "x"), (3, "c", None)]
    assert _merge(spark, path, [(1, "d", None), (2, "e", "x")]) == [(1, "d", None), (2, "e", "x"), (3, "c", None)]


def test_upsert_moves_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    _merge(spark, path, [(1, "a", "x"), (2, "b", "y"), (3, "c", None)])
    assert _merge(spark, path, [(1, "a2", "y"), (3, "c2", "z")]) == [(1, "a2", "y"), (2, "b", "y"), (3, "c2", "z")]
    # a run that was lost between the new partition and the removal of the old one left the row twice
    spark.createDataFrame([(1, "a")], "k int, v string").write.mode("append").parquet(f"{path}/p=x")
    assert _merge(spark, path, [(1, "a2", "y")]) == [(1, "a2", "y"), (2, "b", "y"), (3, "c2", "z")]


def test_upsert_refuses_repeated_and_missing_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    _merge(spark, path, [(1, "a", "x")])
    with pytest.raises(ValueError):
        _merge(spark, path, [(2, "b", "x"), (2, "c", "x")])
    assert _merge(spark, path, [(2, "b", "x"), (2, "c", "x"), (None, "n", "x"), (None, "n", "x")], order=[F.col("v")]) == [(1, "a", "x"), (2, "b", "x"), (None, "n", "x"), (None, "n", "x")]
    with pytest.raises(ValueError):
        merge.upsert(spark, path, spark.createDataFrame([("z", "x")], "v string, p string"), ["k"], "p")
    with pytest.raises(ValueError):
        merge.merge_feed(spark, str(tmp_path / "f"), spark.createDataFrame([(1, 2)], "session_key bigint, driver_number bigint"), "laps")


def test_merge_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    _merge(spark, path, [(i, "a", f"p{i % 5}") for i in range(20)])
    target = spark.read.parquet(path).filter(merge.in_partitions("p", ["p1", None]))
    plan = target._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "p1" in filters and "isnull" in filters
    before = {r[0] for r in spark.read.parquet(path).filter("p = 'p2'").select("_metadata.file_path").distinct().collect()}
    _merge(spark, path, [(1, "b", "p1")])
    assert {r[0] for r in spark.read.parquet(path).filter("p = 'p2'").select("_metadata.file_path").distinct().collect()} == before


def test_full_rebuilds_replace_the_table(spark, tmp_path):
    path = str(tmp_path / "c")
    days = spark.createDataFrame([(1, 1), (2, 2)], "event_date int, k int")
    landing.write_clustered(days, path, ["event_date", "k"])
    landing.write_clustered(days.filter("event_date = 1"), path, ["event_date", "k"])
    assert rows(spark.read.parquet(path).select("event_date", "k")) == [(1, 1)]
    df, path = spark.createDataFrame([(5,), (50,)], "v int"), str(tmp_path / "f")
    rules = [checks.Rule("high", F.col("v") > 10), checks.Rule("low", F.col("v") < 10, severity="warn")]
    checks.store_failures(df, rules, path)
    checks.store_failures(df.filter("v < 10"), rules, path)
    assert rows(spark.read.parquet(path)) == [(5, "low")]


def test_group_values_of_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "k int, v double")
    assert rows(with_group_values(df, ["k"], mean=F.avg("v"))) == [(1, 5.0, 5.0), (None, 1.0, 2.0), (None, 3.0, 2.0)]


def test_staged_tables(spark):
    df = staged(spark.range(5).selectExpr("id", "id * 2 AS twice"), "t")
    assert rows(df) == [(i, 2 * i) for i in range(5)]
    path = scratch_path(spark, "gone")
    assert spark.sparkContext.applicationId in path
    spark.range(1).write.parquet(path)
    remove_path(spark, path)
    assert not path_exists(spark, path)
