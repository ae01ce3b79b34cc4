import hashlib

import pytest
from pyspark.sql import functions as F

from linernotes.operators import gold as g, graph as gr, report


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_albums(bronze):
    got = {r.album_id: r for r in g.albums(bronze).collect()}
    assert (got[1].ensemble, got[1].title, got[1].year) == ("Ana Sánchez Trio", "Blue Hour", 1961)
    assert (got[2].year, got[3].year, got[4].year) == (1965, None, None)
    assert got[2].label == "northern star"


def test_albums_keep_first_ingested(spark):
    df = spark.createDataFrame(
        [(1, "late", "2020-01-02", "a"), (1, "early", "2020-01-01", "b"), (None, "x", "2020-01-01", "c")],
        "id LONG, title STRING, _ingested_at STRING, _ingested_filename STRING",
    ).selectExpr("*", "'' AS artists", "'1960' AS year", "'' AS label", "array('') AS style",
                 "'' AS cover_url")
    assert rows(g.albums(df), "album_id", "title") == [(1, "early")]


def test_labels_keep_spellings_under_one_id(bronze):
    assert rows(g.labels(bronze), "name", "label_id") == [
        ("Northern Star", sha("northern star")), ("Verve", sha("verve")),
        ("northern star", sha("northern star"))]


def test_artists_show_most_used_spelling(bronze):
    assert rows(g.artists(bronze), "name", "artist_id") == [
        ("Ana Sánchez", sha("ana sanchez")), ("Bo Lind", sha("bo lind")),
        ("Cy Young", sha("cy young"))]


def test_works_and_links(bronze):
    works = rows(g.works(bronze), "work_title", "work_id")
    assert works == [("Harbour", sha("harbour")), ("Late Train", sha("late train")),
                     ("Sea Song", sha("sea song"))]
    assert rows(g.album_work(bronze), "album_id", "work_id") == sorted(
        [(1, sha("late train")), (1, sha("sea song")), (2, sha("sea song")), (2, sha("harbour"))])
    assert g.album_work(bronze).join(g.works(bronze), "work_id", "left_anti").isEmpty()


def test_album_artist_roles(bronze):
    got = rows(g.album_artist(bronze), "album_id", "role", "artist_id")
    assert (1, "leader", sha("ana sanchez")) in got and (1, "musician", sha("ana sanchez")) in got
    assert len(got) == 1 + 2 + 1 + 3 + 1


def test_album_label(bronze):
    assert rows(g.album_label(bronze), "album_id", "label_id") == [
        (1, sha("northern star")), (2, sha("northern star")), (4, sha("verve"))]


def test_tracks(bronze):
    got = [r for r in g.tracks(bronze).collect() if r.album_id == 1]
    assert {r.name for r in got} == {"Late Train", "Sea Song"}
    assert {r.track_id for r in got} == {sha("1#late train"), sha("1#sea song")}


def test_split_corrupt(spark):
    df = spark.createDataFrame([(1, None), (None, "{bad"), (None, None)], "id LONG, _corrupt STRING")
    good, bad = g.split_corrupt(df)
    assert rows(good, "id") == [(1,)] and good.columns == ["id"] and bad.count() == 2


def test_upsert_replaces_properties_and_clears_nulls(spark):
    schema = "k LONG, a STRING, b STRING"
    old = spark.createDataFrame([(1, "x", "y"), (2, "x", "y")], schema)
    new = spark.createDataFrame([(1, "z", None), (3, "n", "n"), (3, "m", "n"), (None, "q", "q")], schema)
    once = gr.upsert_nodes(new, "k", ("a", "b"), old)
    want = [(1, "z", None), (2, "x", "y"), (3, "m", "n")]
    assert rows(once, "k", "a", "b") == want
    assert rows(gr.upsert_nodes(new, "k", ("a", "b"), once), "k", "a", "b") == want


def test_edges_need_both_ends_and_keep_old_ones(spark, bronze):
    gold = g.all_tables(bronze)
    loaded = gr.load(gold)
    only = {**gold, "artists": gold["artists"].where(F.col("name") != "Cy Young")}
    partial = gr.load(only)
    assert partial.plays_in.count() == loaded.plays_in.count() - 2
    again = gr.load(gold, existing=partial)
    assert rows(again.plays_in, "artist_id", "album_id") == rows(loaded.plays_in, "artist_id", "album_id")
    small = gr.load({n: df.limit(0) for n, df in gold.items()}, existing=again)
    assert rows(small.plays_in, "artist_id", "album_id") == rows(again.plays_in, "artist_id", "album_id")
    assert set(small.skipped.values()) == {"no rows"}


def test_leaders_also_play(graph):
    assert graph.leads.join(graph.plays_in, ["artist_id", "album_id"], "left_anti").isEmpty()
    assert graph.leads.columns == ["artist_id", "album_id"]


def test_load_skips_missing_tables_and_columns(bronze):
    gold = g.all_tables(bronze)
    gold["works"] = gold["works"].drop("work_title")
    del gold["album_label"]
    loaded = gr.load(gold)
    assert loaded.skipped == {
        "works": "missing columns ['work_title']", "contains": "no node table for an end",
        "released_by": "no such table"}
    with pytest.raises(AttributeError):
        loaded.works


def test_load_map_from_settings(bronze):
    nodes, edges = gr.load_map({
        "nodes": [{"name": "albums", "table": "albums", "key": "album_id", "props": ["title"]},
                  {"name": "songs", "table": "works", "key": "work_id", "props": ["work_title"]}],
        "edges": [{"name": "has", "table": "album_work", "source": ["album_id", "albums"],
                   "target": ["work_id", "songs"]}],
    })
    loaded = gr.load(g.all_tables(bronze), nodes=nodes, edges=edges)
    assert loaded.albums.columns == ["album_id", "title"] and loaded.songs.count() == 3
    assert loaded.has.count() == 4 and loaded.skipped == {}


def test_entries_for_one_name_add_up(spark):
    a = spark.createDataFrame([(1, "x")], "k LONG, p STRING")
    b = spark.createDataFrame([(2, "y")], "k LONG, p STRING")
    specs = [gr.NodeSpec("n", t, "k", ("p",)) for t in ("a", "b")]
    assert rows(gr.load({"a": a, "b": b}, nodes=specs, edges=[]).n, "k", "p") == [(1, "x"), (2, "y")]


def test_unlisted_properties_stay(spark):
    old = spark.createDataFrame([(1, "x", "y"), (2, "p", "q")], "k LONG, a STRING, b STRING")
    new = spark.createDataFrame([(1, "z"), (3, "n")], "k LONG, a STRING")
    got = gr.upsert_nodes(new, "k", ("a",), old)
    assert sorted(map(str, rows(got, "k", "a", "b"))) == sorted(map(str, [(1, "z", "y"), (2, "p", "q"), (3, "n", None)]))


def test_key_violations(spark, graph, bronze):
    assert gr.key_violations(graph.nodes).isEmpty()
    bad = {"labels": g.labels(bronze),
           "albums": spark.createDataFrame([(None,), (1,)], "album_id LONG")}
    assert rows(gr.key_violations(bad), "node", "key", "rows") == sorted(
        [("albums", None, 1), ("labels", sha("northern star"), 2)], key=str)


def test_row_counts(bronze):
    got = rows(report.row_counts({"bronze": bronze, "labels": g.labels(bronze)}), "table_name", "rows")
    assert got == [("bronze", 4), ("labels", 3)]
    assert report.preview(bronze, 2).count() == 2


def test_without_nulls(bronze):
    got = {r.id: r.record for r in report.without_nulls(bronze.select("id", "year", "title"), "id").collect()}
    assert got[4] == '{"id":4,"title":"Empty"}'


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ends_are_looked_up_without_a_broadcast_of_nodes(spark, monkeypatch):
    """Album ids in sequence are next to nothing in a file: Spark would send all nodes to the driver."""
    links, nodes = spark.range(3).select(F.col("id").alias("album_id")), spark.range(4).select(F.col("id").alias("album_id"))
    assert gr.all_present(links, "album_id", nodes) and not gr.all_present(nodes, "album_id", links)
    plans = []
    monkeypatch.setattr(type(links), "isEmpty", lambda df: plans.append(plan_of(df)) or True)
    gr.all_present(links, "album_id", nodes)
    assert "BroadcastHashJoin" not in plans[0]
    assert 0 < plans[0].index("SortMergeJoin [album_id") < plans[0].index("HashAggregate(keys=[album_id")


def test_links_meet_many_nodes_without_a_broadcast(spark, monkeypatch):
    gold = {
        "albums": spark.range(3).selectExpr("id AS album_id", "'t' AS title"),
        "labels": spark.range(2).selectExpr("cast(id AS string) AS label_id", "'n' AS name"),
    }
    nodes = [gr.NodeSpec("albums", "albums", "album_id", ("title",)), gr.NodeSpec("labels", "labels", "label_id", ("name",))]
    edges = [gr.EdgeSpec("released_by", "album_label", ("album_id", "albums"), ("label_id", "labels"))]
    for last, kept in ((3, [(0, "0"), (1, "1"), (2, "0")]), (5, [(0, "0"), (1, "1"), (2, "0")])):
        gold["album_label"] = spark.range(last).selectExpr("id AS album_id", "cast(id % 2 AS string) AS label_id")
        monkeypatch.setattr(gr, "FEW_NODES", 500_000)
        few = gr.load(gold, None, nodes, edges).released_by
        assert "BroadcastHashJoin [album_id" in plan_of(few)
        monkeypatch.setattr(gr, "FEW_NODES", 2)
        many = gr.load(gold, None, nodes, edges).released_by
        assert "BroadcastHashJoin [album_id" not in plan_of(many) and "BroadcastHashJoin [label_id" in plan_of(many)
        assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) == kept
