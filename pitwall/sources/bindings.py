"""Race-shaped raw feeds derived from the supplied star-schema and event tables.

Every expression has an exact twin in the comparison SQL (`catalog.oracle`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitwall.operators.ordered import DAY, split_row_number, time_bucket

GAP_TEXT = {0: "+1 LAP", 1: "None", 2: "1:23.4", 3: "+2 LAPS", 4: ""}
COMPOUND_BY_REMAINDER = ("SOFT", "MEDIUM", "HARD", None, "WET")
SESSION_TYPES = ["Race", "Qualifying", "Sprint", "Practice", "Sprint Qualifying"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Feeds:
    """The raw feeds, built lazily: `feeds["laps"]`."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._cache: dict[str, DataFrame] = {}
        # plans built once per folder, see `plans.memo`
        self.plans: dict = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = getattr(self, f"_{name}")()
        return self._cache[name]

    def events(self, event_type: str | None = None) -> DataFrame:
        e = self.table("events")
        if event_type:
            e = e.filter(F.col("event_type") == event_type)
        return e.select(
            "event_id", "ts", "user_id", "event_type", "value", "props",
            F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
            (F.floor((F.dayofmonth("ts") - 1) / 10) + 1).cast("bigint").alias("session_key"),
            F.col("user_id").alias("driver_number"),
            (F.floor((F.dayofmonth("ts") - 1) / 10) + 1).cast("bigint").alias("meeting_key"),
        )

    def _car_data(self) -> DataFrame:
        k = F.col("k")
        return self.events("view").select(
            "session_key", "meeting_key", "driver_number", F.col("ts").alias("date"), (k * 150).alias("rpm"), (k * 3).alias("speed"),
            k.alias("throttle"), F.when(k % 4 == 0, 100).otherwise(0).alias("brake"), (k % 9).alias("n_gear"), (k % 16).alias("drs"),
        )

    def _position(self) -> DataFrame:
        return self.events("signup").select(
            "session_key", "driver_number", F.col("ts").alias("date"), "meeting_key", (F.col("k") % 20 + 1).alias("position")
        )

    def _intervals(self) -> DataFrame:
        def gap(k: Column) -> Column:
            expr = None
            for digit, text in GAP_TEXT.items():
                expr = F.when(k % 10 == digit, text) if expr is None else expr.when(k % 10 == digit, text)
            return expr.otherwise(F.col("value").cast("string"))

        k = F.col("k")
        return self.events("purchase").select(
            "meeting_key", "session_key", "driver_number", F.col("ts").alias("date"),
            gap(k).alias("gap_to_leader"), gap(k + 5).alias("interval"),
        )

    def _pit(self) -> DataFrame:
        k, v = F.col("k"), F.col("value")
        return self.events("error").select(
            "session_key", "meeting_key", "driver_number", F.col("ts").alias("date"), (k % 5 + 1).alias("lap_number"),
            v.alias("pit_duration"), v.alias("lane_duration"), F.when(k % 6 != 0, v / 4).alias("stop_duration"),
        )

    def _weather(self) -> DataFrame:
        k, v = F.col("k"), F.col("value")
        e = self.events().filter(F.col("user_id") % 3 == 0)
        return e.select(
            "meeting_key", "session_key", F.col("ts").alias("date"), (v / 20 + 10).alias("air_temperature"),
            (v / 10 + 15).alias("track_temperature"), (k + 1000).cast("double").alias("pressure"), k.cast("double").alias("humidity"),
            (k % 5 == 0).alias("rainfall"), (k / 10).alias("wind_speed"), (k * 3).alias("wind_direction"),
        )

    def _laps(self) -> DataFrame:
        clicks = self.events("click")
        numbered = split_row_number(
            clicks, ["session_key", "driver_number"], [F.col("ts")], time_bucket(F.col("ts"), DAY), "lap_number", source=clicks
        )
        k, lap = F.col("k"), F.col("value") + 40
        codes = F.lit(None).cast("array<int>")
        return numbered.select(
            "meeting_key", "session_key", "driver_number", F.col("ts").alias("date_start"), lap.alias("lap_duration"),
            F.col("lap_number").cast("int").alias("lap_number"), (k % 10 == 0).alias("is_pit_out_lap"),
            (lap * 0.30).alias("duration_sector_1"), (lap * 0.35).alias("duration_sector_2"), (lap * 0.35).alias("duration_sector_3"),
            F.when(k % 9 != 0, k + 200).alias("i1_speed"), (k + 210).alias("i2_speed"),
            codes.alias("segments_sector_1"), codes.alias("segments_sector_2"), codes.alias("segments_sector_3"),
            F.when(k % 7 != 0, k + 220).alias("st_speed"),
        )

    def _stints(self) -> DataFrame:
        number = (F.floor((F.col("lap_number") - 1) / 2) + 1).cast("int").alias("stint_number")
        spans = self["laps"].groupBy("meeting_key", "session_key", "driver_number", number).agg(
            F.min("lap_number").alias("lap_start"), F.max("lap_number").alias("lap_end")
        )
        rest, compound = (F.col("driver_number") + F.col("stint_number")) % 5, F.lit(None).cast("string")
        for i, name in enumerate(COMPOUND_BY_REMAINDER):
            compound = F.when(rest == i, name).otherwise(compound)
        return spans.select(
            "meeting_key", "session_key", "driver_number", "stint_number", "lap_start", "lap_end", compound.alias("compound"),
            F.when(F.col("driver_number") % 7 != 0, F.col("driver_number") % 4).cast("int").alias("tyre_age_at_start"),
        )

    def _sessions(self) -> DataFrame:
        r, key = self.table("region"), F.col("r_regionkey")
        kind = F.element_at(F.array(*map(F.lit, SESSION_TYPES)), key.cast("int") + 1)
        start = F.timestamp_add("DAY", key * 10, F.lit("2024-01-01").cast("timestamp_ntz"))
        return r.select(
            (key + 1).cast("bigint").alias("session_key"), (key + 1).cast("bigint").alias("meeting_key"), F.col("r_name").alias("country_name"),
            kind.alias("session_name"), kind.alias("session_type"), F.lit(2024).alias("year"), key.cast("bigint").alias("circuit_key"),
            F.col("r_name").alias("circuit_short_name"), F.substring("r_name", 1, 3).alias("country_code"), start.alias("date_start"),
            F.timestamp_add("DAY", F.lit(10), start).alias("date_end"), F.lit("00:00:00").alias("gmt_offset"),
            F.when(key == 1, F.lit(False)).alias("is_cancelled"), F.concat(F.lit(" "), F.col("r_name")).alias("location"),
        )

    def _meetings(self) -> DataFrame:
        key, name = F.col("r_regionkey"), F.col("r_name")
        start = F.timestamp_add("DAY", key * 10, F.lit("2024-01-01").cast("timestamp_ntz"))
        return self.table("region").select(
            (key + 1).cast("bigint").alias("meeting_key"), name.alias("meeting_name"), F.concat(name, F.lit(" Grand Prix")).alias("meeting_official_name"),
            name.alias("country_name"), key.cast("bigint").alias("circuit_key"), F.lit("None").alias("circuit_image"),
            F.lit("").alias("circuit_info_url"), name.alias("circuit_short_name"), F.lit("Permanent").alias("circuit_type"),
            F.lower(F.substring(name, 1, 3)).alias("circuit_code"), F.lit("null").alias("circuit_flag"), F.lit(2024).alias("year"),
            start.alias("date_start"), F.timestamp_add("DAY", F.lit(10), start).alias("date_end"), F.lit("00:00:00").alias("gmt_offset"),
            F.lit(None).cast("boolean").alias("is_cancelled"), name.alias("location"),
        )

    def _drivers(self) -> DataFrame:
        racing = self.events("click").select(F.col("user_id").alias("c_custkey")).distinct()
        c = self.table("customer").join(racing, "c_custkey", "left_semi")
        n = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        # one entry per region
        keys = self["sessions"].agg(F.collect_list("session_key")).scalar()
        c = c.join(n, "c_nationkey", "left").withColumn("session_key", F.explode(keys))
        return c.select(
            F.col("session_key").alias("meeting_key"), F.col("c_custkey").alias("driver_number"), F.col("c_name").alias("broadcast_name"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"), F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("c_name").alias("full_name"), F.upper(F.substring("c_mktsegment", 1, 3)).alias("name_acronym"),
            F.lit("None").alias("headshot_url"), F.col("n_name").alias("team_name"),
            F.lpad(F.col("c_nationkey").cast("string"), 6, "0").alias("team_colour"), F.lower(F.substring("n_name", 1, 3)).alias("country_code"),
            F.col("session_key").cast("bigint").alias("session_key"),
        )

    def _location(self) -> DataFrame:
        k = F.col("k")
        return self.events("error").select(
            "meeting_key", "session_key", "driver_number", F.col("ts").alias("date"), k.alias("x"), (k * 2).alias("y"), (k - 50).alias("z")
        )


_OPEN: dict[tuple[str, str], Feeds] = {}


def feeds_for(spark: SparkSession, sf_dir: str) -> Feeds:
    """The feeds of a folder, opened once per application; they hold lazy plans only."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN or _OPEN[key].spark is not spark:
        _OPEN[key] = Feeds(spark, sf_dir)
    return _OPEN[key]
