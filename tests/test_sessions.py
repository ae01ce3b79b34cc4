import hashlib

import pytest
from pyspark.sql import functions as F

from linernotes.operators import sessions as se, suggest
from linernotes.operators.graph import Graph


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


ANA, BO, CY = sha("ana sanchez"), sha("bo lind"), sha("cy young")


def test_artist_sessions(graph):
    got = se.artist_sessions(graph, ANA).collect()
    assert [r.album_id for r in got] == [1, 2]
    assert got[0].asDict() == dict(
        artist="Ana Sánchez", album_id=1, ensemble="Ana Sánchez Trio", title="Blue Hour",
        tracks=["Late Train", "Sea Song"], leaders=["Ana Sánchez"],
        participants=["Ana Sánchez", "Bo Lind"], year=1961, label="Northern Star", cover="http://c/1")
    assert se.artist_sessions(graph, "nobody").isEmpty()


def test_null_years_come_last_and_fail_bounds(graph):
    assert [r.album_id for r in se.artist_sessions(graph, CY).collect()] == [2, 3]
    assert [r.album_id for r in se.artist_sessions(graph, CY, year_max=2000).collect()] == [2]
    assert [r.album_id for r in se.artist_sessions(graph, CY, limit=1).collect()] == [2]


def test_year_bounds_are_checked(graph):
    for bad in (1899, 2101):
        with pytest.raises(ValueError):
            se.artist_sessions(graph, CY, year_min=bad)
    assert se.in_years(graph.albums, 1961, 1965).count() == 2


def test_album_without_edges_has_empty_lists(graph):
    card = se.album_detail(graph, 3).first().album
    assert (card.tracks, card.leaders, card.label) == ([], [], None)
    alone = se.album_detail(graph, 4).first().album
    assert (alone.participants, alone.label) == ([], "Verve")
    assert se.album_detail(graph, 99).isEmpty()


def test_leader_sessions(graph):
    got = se.leader_sessions(graph, BO).collect()
    assert [(r.title, r.artist) for r in got] == [("Harbour", "Bo Lind")]
    assert "album_id" not in got[0].asDict()


def test_collab_needs_all_and_two(graph):
    assert [r.album_id for r in se.collab_albums(graph, [ANA, BO, ANA]).collect()] == [1, 2]
    assert [r.album_id for r in se.collab_albums(graph, [ANA, BO, CY]).collect()] == [2]
    assert se.collab_albums(graph, [ANA, "nobody"]).isEmpty()
    assert "tracks" not in se.collab_albums(graph, [ANA, BO]).columns
    with pytest.raises(ValueError):
        se.collab_albums(graph, [ANA, ANA])


def test_bulk_forms_agree_with_single_ones(spark, graph):
    bulk = se.artist_sessions(graph, graph.artists, with_lists=True)
    for who in (ANA, BO, CY):
        one = sorted(map(repr, se.artist_sessions(graph, who).collect()))
        assert sorted(map(repr, bulk.where(F.col("artist_id") == who).drop("artist_id").collect())) == one
    bare = se.artist_sessions(graph, graph.artists)
    assert sorted(map(repr, bare.collect())) == sorted(map(repr, bulk.drop(*se.LISTS).collect()))
    led = se.leader_sessions(graph, graph.artists, year_min=1962)
    assert [r.title for r in led.collect()] == ["Harbour"]
    pairs = [("r1", [ANA, BO, ANA]), ("r2", [ANA, BO, CY]), ("r3", [ANA, "nobody"]), ("r4", [ANA]),
             ("r5", [CY, BO])]
    requests = spark.createDataFrame(
        [(r, a) for r, ids in pairs for a in ids], "request_id STRING, artist_id STRING")
    assert "leaders" in se.collab_albums_bulk(graph, requests, with_lists=True).columns
    got = sorted((r.request_id, r.album_id) for r in se.collab_albums_bulk(graph, requests).collect())
    want = [(r, x.album_id) for r, ids in pairs if len(set(ids)) > 1
            for x in se.collab_albums(graph, ids).collect()]
    assert got == sorted(want)


def test_limit_holds_for_each_id_and_equal_rows_have_an_order(spark, graph, monkeypatch):
    def rows(df):
        return sorted(map(repr, df.collect()))

    twin = graph.albums.where("album_id = 1").withColumn("album_id", F.lit(50).cast("long"))
    edges = {n: df.unionByName(df.where("album_id = 1").withColumn("album_id", F.lit(50).cast("long")))
             for n, df in graph.edges.items()}
    more = Graph({**graph.nodes, "albums": graph.albums.unionByName(twin)}, edges).map(lambda _, df: df.cache())
    every = se.artist_sessions(more, ANA).collect()
    assert [r.album_id for r in every] == [1, 50, 2]
    for limit in (0, 1, 2, 9):
        first = se.artist_sessions(more, graph.artists, limit=limit, with_lists=True).where(F.col("artist_id") == ANA)
        assert rows(first.drop("artist_id")) == sorted(map(repr, every[:limit]))
    monkeypatch.setattr(se, "FEW", 0)  # chosen among parts of a key first
    first = se.artist_sessions(more, None, limit=2).where(F.col("artist_id") == ANA)
    assert sorted(r.album_id for r in first.collect()) == [1, 50]
    monkeypatch.undo()
    assert [r.album_id for r in se.artist_sessions(more, ANA, limit=2).collect()] == [1, 50]
    assert [r.title for r in se.leader_sessions(more, None, limit=1, year_min=1962).collect()] == ["Harbour"]
    assert se.work_appearances(more, None, limit=1).count() == graph.contains.select("work_id").distinct().count()
    requests = spark.createDataFrame([("r", ANA), ("r", BO)], "request_id STRING, artist_id STRING")
    got = se.collab_albums_bulk(more, requests, limit=2, with_lists=True).collect()
    assert sorted(r.album_id for r in got) == [1, 50] and got[0].leaders == ["Ana Sánchez"]
    assert [r.album_id for r in se.collab_albums(more, [ANA, BO], limit=2).collect()] == [1, 50]
    with pytest.raises(ValueError):
        se.artist_sessions(more, None, limit=-1)


def test_first_rows_are_cut_before_they_meet(graph):
    plan = se.artist_sessions(graph, None, limit=2)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_all_and_a_table_of_all_agree(graph):
    def rows(df):
        return sorted(map(repr, df.collect()))

    assert rows(se.artist_sessions(graph, None)) == rows(se.artist_sessions(graph, graph.artists))
    assert rows(se.leader_sessions(graph, None, with_lists=True)) == rows(
        se.leader_sessions(graph, graph.artists, with_lists=True))
    assert rows(se.album_detail(graph)) == rows(se.album_detail(graph, graph.albums))
    assert rows(se.work_appearances(graph, None)) == rows(se.work_appearances(graph, graph.works))


def test_work_appearances(graph):
    got = se.work_appearances(graph, sha("sea song")).collect()
    assert [(r.work_title, r.album_title) for r in got] == [("Sea Song", "Blue Hour"), ("Sea Song", "Harbour")]
    assert got[0].tracks == ["Late Train", "Sea Song"]
    bulk = se.work_appearances(graph, graph.works)
    assert bulk.count() == graph.contains.count()


def test_led_sessions_of(graph):
    got = sorted((r.player, r.title, r.leader) for r in se.led_sessions_of(graph, "Cy Young").collect())
    assert got == [("Cy Young", "Harbour", "Bo Lind")]


def test_album_with_two_labels_gives_two_rows(spark, graph):
    extra = spark.createDataFrame([(1, sha("verve"))], "album_id LONG, label_id STRING")
    both = Graph(graph.nodes, {**graph.edges, "released_by": graph.released_by.unionByName(extra)})
    assert sorted(r.album.label for r in se.album_detail(both, 1).collect()) == ["Northern Star", "Verve"]


def test_lists_are_distinct_by_name(spark, graph):
    twin = spark.createDataFrame([("id2", "Bo Lind")], "artist_id STRING, name STRING")
    edge = spark.createDataFrame([("id2", 1)], "artist_id STRING, album_id LONG")
    more = Graph({**graph.nodes, "artists": graph.artists.unionByName(twin)},
                 {**graph.edges, "plays_in": graph.plays_in.unionByName(edge)})
    assert se.album_detail(more, 1).first().album.participants == ["Ana Sánchez", "Bo Lind"]
    names = se.album_names(more).where("album_id = 1 AND kind = 'participants'")
    assert sorted(r.name for r in names.collect()) == ["Ana Sánchez", "Bo Lind"]


def test_distinct_ids(spark):
    assert se.distinct_ids(["b", "a", "b"]) == ["b", "a"]
    df = spark.createDataFrame([(["b", "a", "b"],), (["a", "a"],)], "ids ARRAY<STRING>")
    assert [r.ids for r in se.distinct_id_lists(df, "ids", 2).collect()] == [["b", "a"]]


def test_suggestions(spark):
    nodes = spark.createDataFrame(
        [("1", "Ann Lee"), ("2", "lee Ann"), ("3", "100% Ann"), ("4", "a_b")], "k STRING, n STRING")

    def ask(q, limit=None):
        return [r.name for r in suggest.suggestions(nodes, "k", "n", q, limit).collect()]

    assert ask("LEE") == ["lee Ann", "Ann Lee"]
    assert ask("") == ["100% Ann", "a_b", "Ann Lee", "lee Ann"]
    assert ask("%") == ["100% Ann"] and ask("_") == ["a_b"] and ask("zz") == []
    assert ask("ann", 1) == ["Ann Lee"]


def test_suggest_over_graph(graph):
    assert [r.name for r in suggest.suggest_artists(graph, "lind").collect()] == ["Bo Lind"]
    assert [r.name for r in suggest.suggest_works(graph, "SEA").collect()] == ["Sea Song"]
    assert [r.id for r in suggest.suggest_albums(graph, "night").collect()] == [3]


def longest_step(df):
    """The rows of the longest intermediate result of a query that has run."""
    def steps(plan):
        kind = plan.getClass().getSimpleName()
        inner = plan.executedPlan() if kind == "AdaptiveSparkPlanExec" else plan.plan() if kind.endswith("QueryStageExec") else None
        if inner is not None:
            return steps(inner)
        metric, children = plan.metrics().get("numOutputRows"), plan.children()
        below = [n for i in range(children.length()) for n in steps(children.apply(i))]
        return [metric.get().value(), *below] if metric.isDefined() else below

    return max(steps(df._jdf.queryExecution().executedPlan()))


def test_equal_requests_are_answered_once(spark):
    """Two artists on 200 albums each but one album shared, asked for 300 times."""
    ids, n = [sha("a"), sha("b")], 300
    plays = spark.createDataFrame([(a, 200 * j + i) for j, a in enumerate(ids) for i in range(200 + (not j))], "artist_id STRING, album_id LONG")
    asked = [(r, a) for r in range(n) for a in ids]
    requests = spark.createDataFrame([*asked, *asked[:50]], "request_id LONG, artist_id STRING")
    shared = se.shared_albums(Graph({}, {"plays_in": plays}), requests)
    assert sorted(map(tuple, shared.collect())) == [(r, 200) for r in range(n)]
    assert longest_step(shared) <= 650  # not 300 requests times 200 albums


def test_requests_with_missing_ids_share_nothing(spark):
    plays = spark.createDataFrame([(a, 1) for a in ("a", "b")], "artist_id STRING, album_id LONG")
    pairs = [(1, "a"), (1, "b"), (1, None), (2, "b"), (2, "a"), (None, "a"), (None, "b"), (3, "a"), (3, "a"), (4, "a"), (4, "x")]
    requests = spark.createDataFrame(pairs, "request_id LONG, artist_id STRING")
    assert se.shared_albums(Graph({}, {"plays_in": plays}), requests).collect() == [(2, 1)]


def test_plays_are_not_broadcast_for_shared_albums(spark):
    """Plays in order are next to nothing in a file: Spark would send them all to the driver."""
    import re

    plays = spark.range(6).selectExpr("cast(id % 3 AS string) AS artist_id", "id DIV 3 AS album_id")
    asked = spark.range(4).selectExpr("id DIV 2 AS request_id", "cast(id % 2 AS string) AS artist_id")
    shared = se.shared_albums(Graph({}, {"plays_in": plays}), asked)
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[album_id\S+ artist_id\S+ \[album_id\S+ artist_id\S+ LeftSemi", plan)
    assert "SortMergeJoin [start" in plan
    assert sorted(map(tuple, shared.collect())) == [(0, 0), (0, 1), (1, 0), (1, 1)]
