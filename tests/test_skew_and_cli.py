"""One key on a third of all rows, and the command line."""

import hashlib
import json

from pyspark.sql import functions as F

from linernotes.__main__ import main
from linernotes.operators import gold as g, graph as gr, sessions as se
from linernotes.plans.refresh import read_graph, write_graph
from linernotes.sources import tables as tb
from tests.test_curation import CFG, DETAILS, MASTERS, RELEASES, SEARCH, U, search_row


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def skewed(spark, n=3000):
    """A star on every album, and one album delivered n times with ever new names."""
    star = F.lit("Star Player")
    own = F.concat(F.lit("Player "), (F.col("i") % 50).cast("string"))
    rows = spark.range(n).withColumnRenamed("id", "i")
    albums = rows.select(F.col("i").alias("id"), F.array(star, own).alias("musicians"))
    hot = rows.select(F.lit(0).cast("long").alias("id"),
                      F.array(star, F.concat(F.lit("Guest "), F.col("i").cast("string"))).alias("musicians"))
    return albums.unionByName(hot).selectExpr(
        "id", "musicians", "array('Star Player') AS leaders", "array('Tune') AS tracklist",
        "'E' AS artists", "'T' AS title", "'1960' AS year", "'L' AS label", "array('S') AS style",
        "'c' AS cover_url")


def test_hot_artist_and_album_stay_whole(spark, tmp_path):
    n = 3000
    graph = gr.load(g.all_tables(skewed(spark, n)))
    write_graph(graph, str(tmp_path / "graph"))
    graph = read_graph(spark, str(tmp_path / "graph"))
    assert graph.plays_in.count() == n + n + n
    star = sha("star player")
    assert se.artist_sessions(graph, star).count() == n
    card = se.album_detail(graph, 0).first().album
    assert len(card.participants) == n + 2
    assert se.collab_albums(graph, [star, sha("player 7")]).count() == n / 50
    requests = spark.createDataFrame(
        [(i, a) for i in range(50) for a in (star, sha(f"player {i}"))], "request_id INT, artist_id STRING")
    per_request = se.shared_albums(graph, requests).groupBy("request_id").count()
    assert {r["count"] for r in per_request.collect()} == {n / 50} and per_request.count() == 50


def test_rows_of_a_hot_key_are_written_by_several_tasks(spark, tmp_path):
    edges = spark.range(60000).select(F.lit("star").alias("artist_id"), F.col("id").alias("album_id"))
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tb.write_sorted(edges, str(tmp_path / "edges"), "artist_id", "album_id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)
    files = spark.read.parquet(str(tmp_path / "edges")).groupBy(F.col("_metadata.file_name")).count()
    sizes = [r["count"] for r in files.collect()]
    assert len(sizes) > 1 and sum(sizes) == 60000 and max(sizes) < 45000


def test_command_line(spark, tmp_path):
    make = spark.createDataFrame
    folder = str(tmp_path / "catalogue")
    make([search_row()], SEARCH).write.parquet(f"{folder}/search")
    make([(f"{U}/masters/1", 1, 1960, "M", None, f"{U}/releases/1", None)], MASTERS).write.parquet(
        f"{folder}/masters")
    make([(f"{U}/releases/1", "Album", 1, None, [], [("T",)], [("Al", "Piano")], [("Al", None, None)])],
         RELEASES).write.parquet(f"{folder}/releases")
    make([], DETAILS).write.parquet(f"{folder}/artist_details")
    curation = {"first_year": CFG.first_year, "last_year": CFG.last_year, "styles": CFG.styles,
                "labels": CFG.labels, "url_base": U}
    settings = tmp_path / "settings.json"
    settings.write_text(json.dumps({
        "catalogue": folder, "landing": str(tmp_path / "landing" / "run1"), "curation": curation,
        "bronze": {"landing": str(tmp_path / "landing"), "bronze": str(tmp_path / "bronze"),
                   "checkpoint": str(tmp_path / "checkpoint"), "database": "bronze_cli"},
        "gold": {"path": str(tmp_path / "gold"), "database": "gold_cli"},
        "graph": str(tmp_path / "graph"),
    }))
    main(["curate", str(settings)])
    main(["refresh", str(settings)])
    card = se.album_detail(read_graph(spark, str(tmp_path / "graph")), 1).first().album
    assert (card.title, card.tracks, card.leaders, card.label) == ("Album", ["T"], ["Al"], "Star Records")
