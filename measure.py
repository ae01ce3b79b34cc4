"""Seconds, shuffled and spilled bytes of every registered query, as a Markdown table.

measure.py [sf_dir]; numbers come from Spark's event log.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

from pyspark.sql import SparkSession

from testbed import workspace
from testbed.queries import QUERIES


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = os.environ.get("BENCH_CPUS", "8")
    log = tempfile.mkdtemp(prefix="run-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("measure")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{log}")
        .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    workspace.catalogue(spark, sf_dir)
    workspace.graph(spark, sf_dir)
    workspace.ingested(spark, sf_dir)
    seconds = {}
    for name, query in QUERIES.items():
        spark.sparkContext.setLocalProperty("measured.query", name)
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = time.perf_counter() - start
    spark.stop()

    query_of_stage, shuffled, spilled = {}, defaultdict(int), defaultdict(int)
    with open(glob.glob(f"{log}/*")[0], encoding="utf-8") as f:
        for event in map(json.loads, f):
            if event["Event"] == "SparkListenerJobStart":
                name = (event.get("Properties") or {}).get("measured.query")
                query_of_stage.update(dict.fromkeys(event["Stage IDs"], name))
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                name, m = query_of_stage.get(event["Stage ID"]), event["Task Metrics"]
                shuffled[name] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                spilled[name] += m["Disk Bytes Spilled"]
    print("| query | seconds | shuffled MB | spilled MB |\n| --- | --- | --- | --- |")
    for name, s in seconds.items():
        print(f"| {name} | {s:.2f} | {shuffled[name] / 1e6:.1f} | {spilled[name] / 1e6:.1f} |")
    print(f"| total | {sum(seconds.values()):.1f} | | |")


if __name__ == "__main__":
    main()
