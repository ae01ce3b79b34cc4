import pytest
from pyspark.sql import functions as F

from linernotes.operators import gold as g, graph as gr
from linernotes.plans import graph_versions as gv
from tests.conftest import ALBUM_DDL


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def same(got, want):
    assert set(got.nodes) == set(want.nodes) and set(got.edges) == set(want.edges)
    for name in (*want.nodes, *want.edges):
        assert rows_of(getattr(got, name)) == rows_of(getattr(want, name)), name


def albums(spark, ids, **changed):
    """Albums with a label, two players and a track each, a player on all of them."""
    rows = [(f"E{i}", changed.get("title", f"T{i}"), i, "1960", f"L{i % 7}", [f"Song {i % 50}"], ["Hot Player", f"P{i % 90}"], [f"P{i % 90}"], ["Bop"], None) for i in ids]
    return spark.createDataFrame(rows, ALBUM_DDL)


def full(spark, *loads):
    graph = None
    for bronze in loads:
        graph = gr.load(g.all_tables(bronze), graph)
    return graph


def test_a_small_load_rewrites_few_buckets(spark, tmp_path):
    base = str(tmp_path / "graph")
    first, second = albums(spark, range(200)), albums(spark, [*range(200, 203), 5], title="New title")
    _, counts = gv.load(spark, base, g.all_tables(first), buckets=48)
    assert counts["albums"] > 40
    graph, counts = gv.load(spark, base, g.all_tables(second))
    assert counts["albums"] <= 4 and counts["plays_in"] <= 4 and counts["contains"] <= 4 and counts["artists"] <= 5
    same(graph, full(spark, first, second))
    assert graph.albums.where("title = 'New title'").count() == 4
    # No file of an untouched bucket was written for the second version.
    written = {f.split("bucket=")[1].split("/")[0] for f in spark.read.parquet(f"{base}/plays_in/version=1").inputFiles()}
    assert len(written) == counts["plays_in"]


def test_earlier_versions_stay(spark, tmp_path):
    base = str(tmp_path / "graph")
    first, second = albums(spark, range(30)), albums(spark, range(20, 40), title="Again")
    gv.load(spark, base, g.all_tables(first), buckets=8)
    gv.load(spark, base, g.all_tables(second))
    same(gv.read(spark, base, 0), full(spark, first))
    same(gv.read(spark, base), full(spark, first, second))
    assert gv.versions(spark, base) == [0, 1]
    with pytest.raises(ValueError, match="no version 7"):
        gv.read(spark, base, 7)


def test_a_load_that_ends_early_changes_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "graph")
    first, second = albums(spark, range(30)), albums(spark, range(25, 45))
    gv.load(spark, base, g.all_tables(first), buckets=8)

    def broken(self, written):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(gv.Manifest, "next", broken)
        with pytest.raises(OSError, match="lost"):
            gv.load(spark, base, g.all_tables(second))
    same(gv.read(spark, base), full(spark, first))
    graph, _ = gv.load(spark, base, g.all_tables(second))
    same(graph, full(spark, first, second))


def test_edges_need_both_ends(spark, tmp_path):
    """Ends may come from an earlier load; a link to a node that never came is left out."""
    base = str(tmp_path / "graph")
    gold = g.all_tables(albums(spark, range(10)))
    gv.load(spark, base, {"albums": gold["albums"]}, buckets=4)
    links = gold["album_artist"]
    graph, _ = gv.load(spark, base, {"artists": gold["artists"].where("name <> 'Hot Player'"), "album_artist": links})
    want = links.join(gold["artists"].where("name <> 'Hot Player'"), "artist_id", "left_semi").select("artist_id", "album_id").distinct()
    assert rows_of(graph.plays_in) == rows_of(want) and want.count() > 0
    assert "contains" not in graph.edges


def test_empty_loads(spark, tmp_path, bronze):
    base = str(tmp_path / "graph")
    graph, counts = gv.load(spark, base, {})
    assert not counts and not graph.nodes
    none = g.all_tables(bronze.where(F.lit(False)))
    graph, counts = gv.load(spark, base, none)
    assert not graph.edges and not counts
    graph, _ = gv.load(spark, base, g.all_tables(bronze))
    same(graph, full(spark, bronze))
