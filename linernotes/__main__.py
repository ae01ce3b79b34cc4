"""Command line: ``python -m linernotes refresh settings.json`` or ``curate settings.json``.

The settings file is a JSON object. ``session`` holds Spark settings for both commands.
refresh: ``bronze`` and ``gold`` (see ``linernotes.config``), ``graph`` (folder of the new graph
version), optionally ``previous_graph`` and ``load_map`` (``nodes`` and ``edges``, see
``linernotes.operators.graph.load_map``).
curate: ``catalogue`` (folder with the tables search, masters, releases, artist_details),
``landing`` (folder for the album records), optionally ``stored`` (folder of JSON records already
landed) and ``curation`` settings.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from linernotes.config import BronzeConfig, CurationConfig, GoldConfig
from linernotes.operators.curation import Catalogue, curate
from linernotes.operators.graph import EDGES, NODES, load_map
from linernotes.plans.refresh import read_graph, refresh
from linernotes.session import build_session
from linernotes.sources.landing import write_albums


def run_refresh(spark: SparkSession, settings: dict) -> None:
    previous = settings.get("previous_graph")
    specs = load_map(settings["load_map"]) if "load_map" in settings else (NODES, EDGES)
    graph, counts = refresh(
        spark,
        BronzeConfig(**settings["bronze"]),
        GoldConfig(**settings["gold"]),
        settings["graph"],
        read_graph(spark, previous, *specs) if previous else None,
        *specs,
    )
    counts.show(truncate=False)
    for name, reason in graph.skipped.items():
        print(f"skipped {name}: {reason}")


def run_curate(spark: SparkSession, settings: dict) -> None:
    folder = settings["catalogue"].rstrip("/")
    tables = ("search", "masters", "releases", "artist_details")
    catalogue = Catalogue(*[spark.read.parquet(f"{folder}/{t}") for t in tables])
    stored = settings.get("stored")
    known = spark.read.schema("id LONG").json(stored) if stored else None
    albums = curate(catalogue, CurationConfig(**settings.get("curation", {})), known)
    write_albums(albums, settings["landing"])


COMMANDS = {"refresh": run_refresh, "curate": run_curate}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="linernotes", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("settings")
    args = parser.parse_args(argv)
    with open(args.settings, encoding="utf-8") as f:
        settings = json.load(f)
    COMMANDS[args.command](build_session(settings.get("session", {})), settings)


if __name__ == "__main__":
    main()
