"""A query costs the tables it reads: the others are not written."""

import os

import pytest
from pyspark.sql import functions as F

from linernotes.config import BronzeConfig
from linernotes.operators import graph as gr, sessions as se
from linernotes.operators.graph import Graph
from linernotes.plans import gold_versions as gov
from linernotes.plans.refresh import write_graph
from linernotes.sources import landing
from linernotes.sources.tables import read_bronze, write_sorted
from linernotes.streaming.bronze import append_batch
from testbed import views, workspace as ws


@pytest.fixture
def tables(spark, tmp_path):
    """Three orders, one without line items."""
    lines = [(1, 1, 1, 1), (1, 2, 2, 2), (2, 1, 2, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").selectExpr(
        "*", "'N' AS l_returnflag", "timestamp'1997-01-01' AS l_shipdate"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1, 3).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "'Brand#1' AS p_brand", "'SMALL' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1, 3).selectExpr("id AS s_suppkey", "concat('Supplier#', id) AS s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(1, 3).selectExpr("id AS c_custkey", "'BUILDING' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1, 4).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "timestamp'1997-01-01' AS o_orderdate", "'5-LOW' AS o_orderpriority"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def folder(graph, name):
    return os.path.dirname(os.path.dirname(graph.nodes[name].inputFiles()[0].removeprefix("file://")))


def test_only_the_tables_asked_for_are_written(spark, tables):
    graph = ws.graph(spark, tables, "artists")
    assert list(graph.nodes) == ["artists"] and not graph.edges
    assert os.listdir(folder(graph, "artists")) == ["artists"]
    gold = ws.gold_tables(spark, tables, "artists").path
    assert os.listdir(gold) == ["artists"]
    led = ws.graph(spark, tables, "leads")
    assert set(os.listdir(folder(led, "artists"))) == {"artists", "albums", "leads"} and not led.by_album
    again = ws.graph(spark, tables, "leads_by_album")
    assert set(os.listdir(folder(again, "artists"))) == {"artists", "albums", "leads", "leads_by_album"}
    assert again.of_albums("leads").collect() == led.leads.collect()


def test_a_graph_made_in_parts_is_the_whole_graph(spark, tables):
    ws.graph(spark, tables, "plays_in")
    grown, whole = ws.graph(spark, tables), ws.graph(spark, f"{tables}/")
    assert sorted(grown.by_album) == sorted(whole.by_album) == ["contains", "leads", "plays_in"]
    for parts in (lambda g: g.nodes, lambda g: g.edges, lambda g: g.by_album):
        assert {n: sorted(map(str, df.collect())) for n, df in parts(grown).items()} == {n: sorted(map(str, df.collect())) for n, df in parts(whole).items()}


def test_a_document_table_is_written_by_itself(spark, tables):
    assert ws.documents(spark, tables, "releases").count() == 3
    built = {purpose for _, sf_dir, purpose in ws._built if sf_dir == tables}
    assert built == {"catalogue_releases"}


def test_cards_read_no_edges_of_lists_that_are_not_shown(spark, tables):
    whole = ws.graph(spark, tables)
    people = Graph({n: df for n, df in whole.nodes.items() if n != "works"}, {n: df for n, df in whole.edges.items() if n != "contains"})
    both = [r["artist_id"] for r in whole.artists.orderBy("name").collect()]
    want = se.collab_albums(whole, both).collect()
    assert len(want) == 1 and se.collab_albums(people, both).collect() == want


def test_written_tables_are_packed(spark, tmp_path):
    write_sorted(spark.range(9), f"{tmp_path}/rows", "id")
    assert all(".zstd." in f for f in os.listdir(f"{tmp_path}/rows") if f.startswith("part-"))


def test_a_customer_is_looked_up_before_the_line_items(spark, tables):
    rows = views.bronze(spark, tables, "id", "label")
    assert sorted(map(tuple, rows.collect())) == [(1, "BUILDING"), (1, "BUILDING"), (2, "BUILDING"), (3, None)]
    lines = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {c: min(len(x) - len(x.lstrip(" :+-")) for x in lines if c in x and x.lstrip(" :+-").startswith("Join")) for c in ("o_custkey", "l_orderkey")}
    assert depth["l_orderkey"] < depth["o_custkey"]


def test_a_first_load_of_gold_joins_nothing_with_itself(spark, tables, tmp_path):
    rows = views.bronze(spark, tables, *ws.ALBUM_COLUMNS, "_ingested_at", "_ingested_filename").selectExpr("*", "'x' AS _ingest", "0L AS _batch")
    from linernotes import fixed_values as fv

    rows = rows.withColumnsRenamed({"_ingest": fv.INGEST_COLUMN, "_batch": fv.BATCH_COLUMN})
    base = f"{tmp_path}/gold_versions"
    gov.load(spark, base, rows, buckets=2)
    assert {n: sorted(map(str, df.collect())) for n, df in gov.changed(spark, base, 0).items()} == {n: sorted(map(str, df.select(*gov.changed(spark, base, 0)[n].columns).collect())) for n, df in gov.read(spark, base).items()}
    # Links that came are the changed rows: they are written once beside the buckets.
    assert not {"album_artist", "album_work", "album_label"} & set(os.listdir(f"{base}/_incoming"))


def test_packed_records_are_the_landed_records(spark, tables):
    plain, packed = (spark.read.schema(ws.ALBUM_DDL).json(ws.landing(spark, tables, p)) for p in (False, True))
    assert packed.count() == 4 and sorted(map(str, packed.collect())) == sorted(map(str, plain.collect()))
    assert all(f.endswith(".json.gz") for f in packed.inputFiles()) and all(f.endswith(".json") for f in plain.inputFiles())
    streamed = [read_bronze(spark, ws.ingested(spark, tables, p)).select(*plain.columns) for p in (False, True)]
    assert [sorted(map(str, df.collect())) for df in streamed] == [sorted(map(str, plain.collect()))] * 2


def test_packed_files_are_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "PACKED_RECORDS", 10)
    landing.write_albums(spark.range(35).coalesce(1), f"{tmp_path}/packed", "gzip")
    landing.write_albums(spark.range(35).coalesce(1), f"{tmp_path}/plain")
    assert [len(spark.read.json(f"{tmp_path}/{n}").inputFiles()) for n in ("packed", "plain")] == [4, 1]


def test_a_batch_can_be_written_by_the_tasks_that_read_it(spark, tmp_path):
    batch = ws.as_landed(spark.range(40).repartition(3))
    files = {}
    for n in (None, 0):
        cfg = BronzeConfig(landing="", bronze=f"{tmp_path}/{n}", checkpoint="", files_per_batch=n)
        append_batch(batch, 0, cfg)
        files[n] = len(read_bronze(spark, cfg).inputFiles())
        assert read_bronze(spark, cfg).count() == 40
    assert files == {None: 1, 0: 3}


def test_edges_in_album_order_are_written_alone(spark, tables):
    first = ws.graph(spark, tables, "contains_by_album", "leads_by_album")
    assert set(os.listdir(folder(first, "albums"))) == {"albums", "works", "artists", "contains_by_album", "leads_by_album"}
    assert first.contains.collect() == first.of_albums("contains").collect()
    whole = ws.graph(spark, f"{tables}/")
    for name in ("contains", "leads"):
        assert sorted(first.edges[name].collect()) == sorted(whole.edges[name].select(first.edges[name].columns).collect())
    later = ws.graph(spark, tables, "contains", "leads_by_album")
    assert sorted(later.contains.collect()) == sorted(whole.contains.collect()) and "/contains/" in later.contains.inputFiles()[0]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_links_whose_ends_are_there_are_not_joined(spark, tmp_path):
    nodes = {"albums": spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "album_id long, title string"),
             "works": spark.createDataFrame([("x", "X"), ("y", "Y")], "work_id string, work_title string")}
    spec = next(s for s in gr.EDGES if s.name == "contains")
    for i, (more, joins) in enumerate([([], 0), ([(3, "x")], 1), ([(3, "z")], 2)]):
        gold = {"album_work": spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "x"), (1, None), *more], "album_id long, work_id string")}
        loaded = gr.load(gold, Graph(nodes, {}), [], [spec], to_write=True).edges
        assert plan_of(loaded["contains"]).count("Join LeftSemi") == joins
        write_graph(Graph({}, loaded), f"{tmp_path}/{i}")
        for name in ("contains", "contains_by_album"):
            assert sorted(spark.read.parquet(f"{tmp_path}/{i}/{name}").collect()) == [(1, "x"), (2, "y")]
        assert sorted(gr.load(gold, Graph(nodes, {}), [], [spec]).contains.collect()) == [(1, "x"), (2, "y")]


def shuffles(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum(line.strip(" :+-").startswith("Exchange") for line in text.splitlines())


def test_nodes_to_write_meet_in_the_order_they_are_written_in(spark, tmp_path):
    rows = spark.range(300).selectExpr("id % 100 AS album_id", "concat('t', id) AS title").repartition(3).localCheckpoint()
    spec = gr.NodeSpec("albums", "albums", "album_id", ("title",))
    by_key, ranged = (gr.load({"albums": rows}, None, [spec], [], to_write=w) for w in (False, True))
    assert sorted(ranged.albums.collect()) == sorted(by_key.albums.collect()) and ranged.albums.count() == 100
    assert shuffles(ranged.albums) == 1
    write_graph(ranged, f"{tmp_path}/graph", nodes_in_ranges=True)
    files = spark.read.parquet(f"{tmp_path}/graph/albums").groupBy(F.col("_metadata.file_path")).agg(F.min("album_id"), F.max("album_id"))
    ends = sorted(tuple(r)[1:] for r in files.collect())
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:])) and ends[-1][1] == 99


def joins_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_line_items_are_not_broadcast_for_their_orders(spark, tables, monkeypatch):
    monkeypatch.setattr(views, "FEW_LINES", 2)
    assert "SortMergeJoin [o_orderkey" in joins_of(views.bronze(spark, tables, "id", "title"))


def test_people_of_all_records_are_not_broadcast(spark, tables):
    from testbed.queries import QUERIES

    found = QUERIES["l4_own_map"](spark, tables)
    assert "SortMergeJoin [album_id" in joins_of(found)
    assert sorted((r.album_id, r.people) for r in found.collect()) == [(1, 2), (2, 1), (3, None)]
