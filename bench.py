"""Time the headline queries on local Spark and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads, BENCH_QUERIES a comma-separated choice.
Each query runs to a no-op sink, so all its rows and columns are computed but none are kept.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from testbed import workspace
from testbed.queries import QUERIES

HEADLINE = [
    "n1_norm_text", "n3_content_id", "c12_clean_tracks", "c13_players", "c22_album_records",
    "g1_albums", "g3_artists", "g4_works", "g5_album_artist", "g6_album_work", "g8_tracks",
    "l1a_album_nodes", "l2b_plays_in", "l2c_contains",
    "q2_suggest_works", "q4_artist_sessions", "q4_bulk", "q5_bulk", "q6_collab_albums", "q6_bulk",
    "q7_bulk", "q8_work_appearances", "q8_bulk", "q9_led_sessions_of",
    "s2_json_stream", "s6_incremental", "s9_bronze_scan",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    # Inputs made from the given tables are not part of the measured work.
    workspace.catalogue(spark, sf_dir)
    workspace.landing(spark, sf_dir)
    timed("build_gold", lambda: workspace.gold_tables(spark, sf_dir))
    timed("build_graph", lambda: workspace.graph(spark, sf_dir))
    timed("build_bronze", lambda: workspace.ingested(spark, sf_dir))
    for name in names:
        def run(q=QUERIES[name]):
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()

        timed(name, run)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
