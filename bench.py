"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated names) change what is run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pitwall.catalog.registry import load_all, runnable
from pitwall.session import local_session

HEADLINE = [
    "m15_lap_positions", "m19_stint_weather", "m20_car_telemetry", "m21_race_history", "m22_leaderboard", "m23_race_summary", "d12_lap_gaps", "d16_lap_telemetry", "d17_lap_weather",
    "d21_lap_gap_evolution", "d22_pit_out_impact", "d23_sector_pace", "d24_sector_position_impact", "d25_telemetry_laps", "d28_team_tyre_strategy",
    "d29_tyre_degradation", "d30_tyre_weather_impact", "x19_telemetry_minutes", "x20_driver_session_summary", "x22_position_minutes", "x23_race_leaderboard",
    "x25_weather_slices", "x26_session_summary", "w01_dedupe_latest", "w08_lag_delta", "w13_fill_forward", "a07_median", "j10_session_range", "j11_asof", "u02_wide_to_long",
    "s08_upsert", "st11_telemetry_windows",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    runnable(load_all()[name])(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    cold, warm = {}, {}
    for name in names:
        times = [run(spark, name, sf_dir) for _ in range(1 + repeats)]
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:] or times), 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm, "cold": cold, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf
    }))


if __name__ == "__main__":
    main()
