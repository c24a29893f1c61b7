"""Column functions on hand-made values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pitwall import functions as fx


def values(spark, texts, *cols, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, c {kind}")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


GAPS = ["12.345", "+12.3", "-0.5", "1:23.4", "-1:30", "+1 LAP", "+2 LAPS", "1L", "None", "null", "nan", "", " ", None]


def test_interval_seconds(spark):
    got = [v[0] for v in values(spark, GAPS, fx.interval_seconds(F.col("c")))]
    assert got == [12.345, 12.3, -0.5, pytest.approx(83.4), -30.0] + [None] * 9


def test_gap_seconds_and_lapped(spark):
    got = values(spark, GAPS, fx.gap_seconds(F.col("c")), fx.is_lapped_gap(F.col("c")))
    assert [g[0] for g in got[:5]] == [12.345, 12.3, -0.5, None, None]
    # the lapped test looks at the whole text, so the plural form is not one
    assert [g[1] for g in got] == [False] * 5 + [True] + [False] * 8
    assert math.isnan(got[10][0]) and got[5][0] is None and got[6][0] is None


def test_numeric_gap(spark):
    assert [v[0] for v in values(spark, ["3.5", "+1 LAP", "x", None], fx.numeric_gap(F.col("c")))] == [3.5, None, None, None]


def test_text(spark):
    texts = [" a ", "", "  ", "None", "null", None]
    assert [v[0] for v in values(spark, texts, fx.clean_text(F.col("c")))] == ["a", None, None, "None", "null", None]
    assert [v[0] for v in values(spark, texts, fx.clean_token_text(F.col("c")))] == ["a", None, None, None, None, None]
    colours = values(spark, ["ab12ff", "#ab12ff", "a#b", "", None], fx.hex_colour(F.col("c")), fx.hex_colour_stripped(F.col("c")))
    assert colours == [("#AB12FF", "#AB12FF"), ("#AB12FF", "#AB12FF"), ("#A#B", "#AB"), (None, None), (None, None)]
    assert [v[0] for v in values(spark, ["x", None], fx.strict_concat_ws("-", F.lit(1), F.col("c")))] == ["1-x", None]
    assert [v[0] for v in values(spark, ["7", "", "x", None], fx.int_or_default(F.col("c")))] == [7, 0, 0, 0]


def test_times(spark):
    at = dt.datetime(2024, 5, 1, 10, 0, 0, 900_000)
    later = dt.datetime(2024, 5, 1, 10, 0, 1, 100_000)
    row = spark.createDataFrame([(at, later)], "a timestamp_ntz, b timestamp_ntz").select(
        fx.seconds_between(F.col("a"), F.col("b")), fx.millis_between(F.col("a"), F.col("b")), fx.add_seconds(F.col("a"), F.lit(81.6)),
        fx.add_millis(F.col("a"), F.lit(1500.4)), fx.trunc_to("second", F.col("a")), fx.slice_start(F.lit(dt.datetime(2024, 5, 1, 10, 7, 3)).cast("timestamp_ntz"), 5),
    ).first()
    assert tuple(row) == (
        1, 200, at + dt.timedelta(seconds=82), at + dt.timedelta(milliseconds=1500), at.replace(microsecond=0), dt.datetime(2024, 5, 1, 10, 5)
    )
    parsed = values(spark, ["2024-05-01T10:00:00.123456+02:00", "2024-05-01 10:00:00Z", "soon", None], fx.utc(F.col("c")), fx.utc_or_epoch(F.col("c")))
    assert parsed[0] == (dt.datetime(2024, 5, 1, 8, 0, 0, 123456), dt.datetime(2024, 5, 1, 8, 0, 0, 123000))
    assert parsed[1][0] == dt.datetime(2024, 5, 1, 10)
    assert parsed[2] == parsed[3] == (None, dt.datetime(1970, 1, 1))


def test_surrogate_key_tells_null_from_text(spark):
    got = [v[0] for v in values(spark, ["", None, "1"], fx.surrogate_key(F.col("c"), F.lit(2)))]
    assert len(set(got)) == 3


def test_flags(spark):
    got = values(spark, [None, 24, 25, 35, 45, 70], fx.track_band(F.col("c")), fx.humidity_band(F.col("c")), kind="int")
    assert [g[0] for g in got] == ["UNKNOWN", "TRACK_COLD", "TRACK_MODERATE", "TRACK_HOT", "TRACK_VERY_HOT", "TRACK_VERY_HOT"]
    assert [g[1] for g in got] == ["UNKNOWN", "HUMIDITY_LOW", "HUMIDITY_LOW", "HUMIDITY_LOW", "HUMIDITY_MEDIUM", "HUMIDITY_HIGH"]
    assert [v[0] for v in values(spark, [1, 10, 11, None], fx.points_for(F.col("c")), kind="int")] == [25, 1, 0, 0]
    assert [v[0] for v in values(spark, [None, 39, 40, 300, 301], fx.within(F.col("c"), (40, 300)), kind="int")] == [False, False, True, True, False]
    ages = values(spark, [None, 3], fx.tyre_age(F.lit(7), F.lit(5), F.col("c")), kind="int")
    assert ages == [(3,), (5,)]
