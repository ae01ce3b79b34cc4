import json
import os
import time
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from linernotes.config import BronzeConfig, GoldConfig, load
from linernotes import fixed_values as fv
from linernotes.fixed_values import ALBUM_DDL
from linernotes.operators import gold as g
from linernotes.operators import graph as gr
from linernotes.plans.refresh import read_graph, refresh
from linernotes.session import build_session, shared_folder
from linernotes.sources import delivery, landing as ld, tables as tb
from linernotes.streaming import bronze as br, quarantine as qu, schemas as sc
from linernotes.streaming.quarantine import UnreadableFiles


@pytest.fixture
def cfg(tmp_path):
    (tmp_path / "landing").mkdir()

    def make(**settings):
        settings.setdefault("database", f"bronze_{uuid.uuid4().hex[:8]}")
        return BronzeConfig(
            landing=str(tmp_path / "landing"), bronze=str(tmp_path / "bronze"),
            checkpoint=str(tmp_path / "checkpoint"), **settings)

    return make


def put(cfg, name, *records):
    path = f"{cfg.landing}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")


def album(i, **more):
    return {"id": i, "title": f"Título {i}", "artists": "Bo", "year": "1960", **more}


def ids(spark, cfg):
    return sorted(r.id for r in tb.read_bronze(spark, cfg).select("id").collect())


def ids_of(spark, cfg, column):
    return sorted(r[0] for r in tb.read_bronze(spark, cfg).select(column).collect())


def test_stream_plan(spark, cfg):
    c = cfg()
    put(c, "a.json", album(1))
    df = br.read_landing(spark, c).transform(br.with_ingestion_columns)
    assert df.isStreaming
    assert df.columns[:2] == ["_ingested_at", "_ingested_filename"]
    assert df.columns[2:-1] == [f.strip().split(" ")[0] for f in ALBUM_DDL.split(",")]


def test_only_json_is_accepted(spark, cfg):
    with pytest.raises(ValueError):
        br.read_landing(spark, cfg(source_format="csv"))


def test_new_files_only_and_registered(spark, cfg):
    c = cfg()
    put(c, "a.json", album(1), album(2))
    put(c, "b.txt", album(9))
    table, path, fmt = br.run_bronze(spark, c)
    assert (table, path, fmt) == (c.table, c.path, "parquet")
    assert ids(spark, c) == [1, 2] and spark.table(table).count() == 2
    br.run_bronze(spark, c)
    assert ids(spark, c) == [1, 2]
    put(c, "c.JSON", album(3))
    br.run_bronze(spark, c)
    assert ids(spark, c) == [1, 2, 3] and spark.table(table).count() == 3
    row = tb.read_bronze(spark, c).where("id = 3").first()
    assert row.title == "Título 3" and row._ingested_filename.endswith("/c.JSON")
    assert row._ingested_at is not None


def test_same_name_in_another_folder_is_not_new(spark, cfg, tmp_path):
    c = cfg()
    put(c, "a.json", album(1))
    br.run_bronze(spark, c)
    (tmp_path / "landing" / "deep").mkdir()
    put(c, "deep/a.json", album(5))
    put(c, "deep/z.json", album(6))
    br.run_bronze(spark, c)
    assert ids(spark, c) == [1, 6]


def test_replayed_batch_replaces_itself(spark, cfg):
    c = cfg(max_files_per_trigger=1, partition_by=("label",))
    put(c, "a.json", album(1, label="A"), album(2, label="B"))
    put(c, "b.json", album(3, label="A"))
    br.run_bronze(spark, c)
    assert ids(spark, c) == [1, 2, 3]
    for batch in (0, 1):
        rows = tb.read_bronze(spark, c).where(F.col(fv.BATCH_COLUMN) == batch)
        rows = rows.drop(fv.INGEST_COLUMN, fv.BATCH_COLUMN)
        copy = spark.createDataFrame(rows.collect(), rows.schema)
        br.append_batch(copy, batch, c, br.ingest_id(spark, c))
        br.append_batch(copy, batch, c, br.ingest_id(spark, c))
    assert ids(spark, c) == [1, 2, 3]
    assert "label" in tb.read_bronze(spark, c).columns


def test_old_files_are_read_too(spark, cfg):
    c = cfg()
    put(c, "a.json", album(1))
    br.run_bronze(spark, c)
    put(c, "b.json", album(2))
    old = time.time() - 400 * 86_400
    os.utime(f"{c.landing}/b.json", (old, old))
    put(c, "c.json", album(3))
    br.run_bronze(spark, c)
    assert ids(spark, c) == [1, 2, 3]


def test_a_new_checkpoint_replaces_nothing(spark, cfg, tmp_path):
    c = cfg()
    put(c, "a.json", album(1))
    put(c, "b.json", album(2))
    br.run_bronze(spark, c)
    (tmp_path / "landing" / "a.json").unlink()
    (tmp_path / "landing" / "b.json").unlink()
    put(c, "c.json", album(3))
    second = replace(c, checkpoint=str(tmp_path / "checkpoint2"))
    table, _, _ = br.run_bronze(spark, second)
    assert ids(spark, second) == [1, 2, 3] and spark.table(table).count() == 3
    assert tb.read_bronze(spark, c).select(fv.INGEST_COLUMN).distinct().count() == 2


def test_new_partitions_are_added_without_a_listing(spark, cfg, monkeypatch):
    c = cfg(max_files_per_trigger=1)
    put(c, "a.json", album(1))
    br.run_bronze(spark, c)
    monkeypatch.setattr(type(spark.catalog), "recoverPartitions", None)
    put(c, "b.json", album(2))
    put(c, "c.json", album(3))
    table, _, _ = br.run_bronze(spark, c)
    assert spark.table(table).count() == 3
    br.run_bronze(spark, c)
    assert spark.table(table).count() == 3


def test_multi_line_files(spark, cfg):
    c = cfg(reader_options={"multiLine": "true"})
    put(c, "a.json", json.dumps(album(1), indent=4))
    br.run_bronze(spark, c)
    assert ids(spark, c) == [1]


def test_corrupt_rows_are_set_aside(spark, cfg):
    c = cfg()
    put(c, "a.json", album(1), '{"id": 2, "title": ', album("x"), {"title": "no id"},
        album(3, year=1961))
    br.run_bronze(spark, c)
    good, bad = g.split_corrupt(tb.read_bronze(spark, c))
    assert sorted((r.id, r.year) for r in good.collect()) == [(1, "1960"), (3, "1961")]
    assert bad.count() == 3
    assert bad.where("_corrupt LIKE '%\"title\": '").count() == 1
    aside = qu.read_quarantine(spark, c)
    assert sorted(r["reason"] for r in aside.collect()) == [qu.NO_ID, qu.UNREADABLE, qu.UNREADABLE]
    assert {r["file"].rsplit("/", 1)[-1] for r in aside.collect()} == {"a.json"}
    assert '{"id": 2, "title": ' in [r["record"] for r in aside.collect()]


def test_quarantine_reads_only_its_batch(spark, cfg, monkeypatch):
    """Earlier partitions may be gone: the batch's own is enough. A repeated batch replaces its rows."""
    c = cfg(max_files_per_trigger=1)
    put(c, "a.json", "{bad", album(1))
    br.run_bronze(spark, c)
    put(c, "b.json", "{worse", album(2))
    opened = []
    monkeypatch.setattr(qu, "open_table", lambda s, path, *a: opened.append(path) or tb.open_table(s, path, *a))
    br.run_bronze(spark, c)
    assert opened and all(f"{fv.BATCH_COLUMN}=1" in p for p in opened)
    ingest = br.ingest_id(spark, c)
    assert qu.set_aside_batch(spark, c, ingest, 1) == {qu.UNREADABLE: 1}
    assert sorted(r["record"] for r in qu.read_quarantine(spark, c).collect()) == ["{bad", "{worse"]


def test_a_bad_file_blocks_only_its_own_run_and_can_be_repaired(spark, cfg, tmp_path):
    c = cfg()
    put(c, "good.json", album(1), "{cut", album(2))
    put(c, "bad.json", "{", "[")
    gold = GoldConfig(path=str(tmp_path / "gold"), database="gold_repair")
    with pytest.raises(UnreadableFiles, match="bad.json"):
        refresh(spark, c, gold, str(tmp_path / "graph0"))
    put(c, "later.json", album(3))
    refresh(spark, c, gold, str(tmp_path / "graph1"))
    assert spark.read.parquet(f"{gold.path}/albums").count() == 3
    assert {r["reason"]: r["count"] for r in qu.read_quarantine(spark, c).groupBy("reason").count().collect()} == {
        qu.WHOLE_FILE: 2, qu.UNREADABLE: 1}
    repaired = tmp_path / "repaired"
    repaired.mkdir()
    for name, records in (("good.json", [album(1), album(9), album(2)]), ("bad.json", [album(4), "still {bad"])):
        put(replace(c, landing=str(repaired)), name, *records)
    files = [str(repaired / n) for n in ("good.json", "bad.json")]
    for _ in range(2):
        br.repair(spark, c, files)
        good, _ = g.split_corrupt(tb.read_bronze(spark, c))
        assert sorted(r.id for r in good.select("id").collect()) == [1, 2, 3, 4, 9]
        assert [r["record"] for r in qu.read_quarantine(spark, c).collect()] == ["still {bad"]
    assert spark.table(c.table).where("_corrupt IS NULL").count() == 5
    refresh(spark, c, gold, str(tmp_path / "graph2"))
    assert spark.read.parquet(f"{gold.path}/albums").count() == 5


def test_a_run_broken_before_registration_loses_nothing(spark, cfg, monkeypatch):
    c = cfg(max_files_per_trigger=1)
    put(c, "a.json", album(1))
    br.run_bronze(spark, c)
    put(c, "b.json", album(2))
    put(c, "c.json", album(3))
    br.start_bronze(spark, c).awaitTermination()  # ends before it registers
    monkeypatch.setattr(type(spark.catalog), "recoverPartitions", None)
    put(c, "d.json", album(4))
    table, _, _ = br.run_bronze(spark, c)
    assert sorted(r.id for r in spark.table(table).select("id").collect()) == [1, 2, 3, 4] == ids(spark, c)


def test_a_commit_log_that_begins_later_is_made_up_by_a_listing(spark, cfg):
    c = cfg(max_files_per_trigger=1)
    put(c, "a.json", album(1))
    br.run_bronze(spark, c)
    for i in range(2, 6):
        put(c, f"{i}.json", album(i))
    br.start_bronze(spark, c).awaitTermination()
    for i in range(4):  # as Spark does with old batches
        for name in (f"{i}", f".{i}.crc"):
            os.remove(f"{c.checkpoint}/commits/{name}")
    assert br.unregistered(spark, c) is None
    table, _, _ = br.run_bronze(spark, c)
    assert spark.table(table).count() == 5


def test_inferred_schema(spark, cfg):
    c = cfg(schema=None)
    put(c, "a.json", {"k": 1, "name": "n"})
    br.run_bronze(spark, c)
    assert tb.read_bronze(spark, c).select("k", "name").first() == (1, "n")
    put(c, "b.json", {"k": 2, "name": "m", "later": True})
    table, _, _ = br.run_bronze(spark, c)
    for rows in (tb.read_bronze(spark, c), spark.table(table)):
        assert sorted((r.k, r.later) for r in rows.collect()) == [(1, None), (2, True)]
    assert [r["version"] for r in sc.versions(spark, c).orderBy("version").collect()] == [0, 1]


def test_fields_types_and_conflicts_of_later_files(spark, cfg):
    c = cfg(schema=None, max_files_per_trigger=1)
    files = [
        [{"id": 1, "n": 5, "t": "x", "s": {"a": 1}, "l": [1], "nothing": None}],
        [{"id": 2, "n": 2.5, "t": 7, "s": {"a": 2, "b": "new"}, "l": [2], "nothing": "now text"}],
        [{"id": 3, "n": 9007199254740993}, {"id": "four", "n": 1}, {"id": 5, "s": "not a struct"}, "{cut"],
    ]
    for i, records in enumerate(files):
        put(c, f"{i}.json", *records)
        time.sleep(0.05)
        table, _, _ = br.run_bronze(spark, c)
    for rows in (tb.read_bronze(spark, c), spark.table(table)):
        good = {r.id: r for r in rows.where("_corrupt IS NULL").collect()}
        assert sorted(good) == [1, 2, 3]
        assert [float(good[i].n) for i in (1, 2)] == [5.0, 2.5] and int(good[3].n) == 9007199254740993
        assert (good[1].nothing, good[2].nothing, good[2].t) == (None, "now text", "7")
        assert good[1].s.asDict() == {"a": 1, "b": None} and good[2].s.asDict() == {"a": 2, "b": "new"}
        assert rows.where("_corrupt IS NOT NULL").count() == 3
    last = sc.latest(spark, c)
    assert len(last.conflicts) == 2 and any(x.startswith("id: string") for x in last.conflicts)
    assert sc.advance(spark, c, last.schema, "again", 7).number == last.number
    assert qu.read_quarantine(spark, c).count() == 3


def test_names_that_look_like_patterns(spark, cfg):
    c = cfg(schema=None)
    for i, name in enumerate(("a[1].json", "b{x,y}.json", "c d,e.json")):
        put(c, name, {"id": i})
    br.run_bronze(spark, c)
    assert ids(spark, c) == [0, 1, 2]


def test_first_write_clears_leftovers_and_later_ones_append(spark, cfg, tmp_path):
    c = cfg()
    (tmp_path / "bronze" / "albums").mkdir(parents=True)
    (tmp_path / "bronze" / "albums" / "_left").write_text("x")
    one = spark.createDataFrame([(1,)], "id LONG")
    br.append_batch(one, 0, c)
    assert not (tmp_path / "bronze" / "albums" / "_left").exists()
    br.append_batch(spark.createDataFrame([(2, "new")], "id LONG, label STRING"), 1, c)
    assert sorted((r.id, r.label) for r in tb.read_bronze(spark, c).collect()) == [(1, None), (2, "new")]
    free = cfg(schema=None, files_per_batch=None)
    br.append_batch(spark.createDataFrame([(3, "more")], "id LONG, extra STRING"), 2, free)
    assert sorted(r.extra or "" for r in tb.read_bronze(spark, free).collect()) == ["", "", "more"]
    over = cfg(mode="overwrite")
    br.append_batch(one, 2, over)
    assert ids(spark, over) == [1]


def test_registering_without_data_does_nothing(spark, cfg):
    c = cfg()
    assert tb.ensure_bronze(spark, c)[0] == c.table
    assert not spark.catalog.tableExists(c.table)


def test_gold_sink(spark, tmp_path):
    c = GoldConfig(path=str(tmp_path / "gold"), database="gold_test")
    table = tb.write_gold(spark, spark.range(3).toDF("album_id"), "  Album Works  ", c)
    assert table == "gold_test.album_works" and spark.table(table).count() == 3
    tb.write_gold(spark, spark.range(5).selectExpr("id AS album_id", "'x' AS extra"), "Album Works", c)
    assert spark.table(table).count() == 5 and "extra" in spark.table(table).columns
    found = tb.open_tables(spark, c.path, ["album_works", "missing"])
    assert list(found) == ["album_works"]


def test_new_files(spark, tmp_path):
    for name in ("in/a.json", "in/b.txt", "in/sub/a.json", "in/sub/d.JSON", "raw/d.JSON", "in/e.json"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("{}")
    landed = ld.list_files(spark, str(tmp_path / "in"))
    assert "content" not in landed.columns
    got = ld.new_files(landed, ld.list_files(spark, str(tmp_path / "raw")))
    assert sorted(r.name for r in got.collect()) == ["a.json", "e.json"]
    assert ld.new_files(landed).count() == 3


def test_album_json_round_trip(spark, bronze, tmp_path):
    ld.write_albums(bronze, str(tmp_path / "out"))
    text = spark.read.text(str(tmp_path / "out"))
    assert text.where("value LIKE '%Ana Sánchez%'").count() == 2
    back = spark.read.schema(bronze.schema).json(str(tmp_path / "out"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, bronze.collect()))


@pytest.mark.parametrize("rows,size,want", [(7, 3, [1, 3, 3]), (0, 3, []), (2, 1, [1, 1])])
def test_deliveries(spark, tmp_path, rows, size, want):
    folder = str(tmp_path)

    def send(batch):
        import os
        import uuid as u
        with open(os.path.join(folder, u.uuid4().hex), "w") as f:
            f.write(repr(batch))

    df = spark.range(rows).coalesce(1)
    assert sorted(r.rows for r in delivery.deliveries(df, lambda b: None, size).collect()) == want
    assert delivery.deliver(df, send, size) == rows
    assert len(list(tmp_path.iterdir())) == len(want)


def test_refresh_end_to_end(spark, cfg, tmp_path, bronze):
    c = cfg()
    gold = GoldConfig(path=str(tmp_path / "gold"), database="gold_refresh")
    albums = bronze.where("id < 3")
    ld.write_albums(albums, f"{c.landing}/first")
    graph, counts = refresh(spark, c, gold, str(tmp_path / "graph" / "v1"))
    n = {r.table_name: r.rows for r in counts.collect()}
    assert n["bronze"] == 2 and n["albums"] == 2 and n["works"] == 3 and n["quarantine"] == 0
    assert graph.plays_in.count() == 5
    ld.write_albums(bronze.where("id >= 3"), f"{c.landing}/second")
    old = read_graph(spark, str(tmp_path / "graph" / "v1"))
    new, _ = refresh(spark, c, gold, str(tmp_path / "graph" / "v2"), old)
    assert new.albums.count() == 4 and new.plays_in.count() == 6
    assert old.albums.count() == 2


def test_refresh_equals_the_tables_one_by_one(spark, cfg, tmp_path, bronze):
    c = cfg()
    gold = GoldConfig(path=str(tmp_path / "gold"), database="gold_shared")
    ld.write_albums(bronze, f"{c.landing}/all")
    refresh(spark, c, gold, str(tmp_path / "graph"))
    rows = tb.read_bronze(spark, c)
    for name, build in g.TABLES.items():
        written = spark.read.parquet(f"{gold.path}/{name}")
        want = build(rows).select(written.columns)
        assert sorted(map(repr, written.collect())) == sorted(map(repr, want.collect())), name


def test_what_cannot_be_used_is_written_and_counted(spark, cfg, tmp_path):
    c = cfg()
    put(c, "a.json", album(1, tracklist=["A"]), '{"id": 2, "title": ', {"title": "no id"})
    gold = GoldConfig(path=str(tmp_path / "gold"), database="gold_quarantine")
    _, counts = refresh(spark, c, gold, str(tmp_path / "graph"))
    n = {r.table_name: r.rows for r in counts.collect()}
    assert (n["bronze"], n["quarantine"], n["albums"]) == (3, 2, 1)
    texts = [r["record"] for r in qu.read_quarantine(spark, c).collect()]
    assert '{"id": 2, "title": ' in texts


def test_a_file_without_a_readable_record_stops_the_refresh(spark, cfg, tmp_path):
    c = cfg()
    put(c, "a.json", json.dumps(album(1), indent=4))
    put(c, "b.json", album(2))
    gold = GoldConfig(path=str(tmp_path / "gold"), database="gold_unreadable")
    with pytest.raises(UnreadableFiles, match="a.json"):
        refresh(spark, c, gold, str(tmp_path / "graph"))
    assert {r["reason"] for r in qu.read_quarantine(spark, c).collect()} == {qu.WHOLE_FILE}
    good, _ = g.split_corrupt(tb.read_bronze(spark, c))
    assert [r.id for r in good.collect()] == [2]


def test_refresh_with_an_own_load_map(spark, cfg, tmp_path, bronze):
    specs = gr.load_map({
        "nodes": [
            {"name": "records", "table": "albums", "key": "album_id", "props": ["title"]},
            {"name": "records", "table": "tracks", "key": "album_id", "props": ["name"]},
            {"name": "people", "table": "artists", "key": "artist_id", "props": ["name"]},
            {"name": "nothing", "table": "not_there", "key": "k", "props": []},
        ],
        "edges": [
            {"name": "on", "table": "album_artist", "source": ["artist_id", "people"],
             "target": ["album_id", "records"], "roles": [role]} for role in ("leader", "musician")
        ],
    })
    c = cfg()
    gold = GoldConfig(path=str(tmp_path / "gold"), database="gold_own_map")
    ld.write_albums(bronze, f"{c.landing}/all")
    graph, _ = refresh(spark, c, gold, str(tmp_path / "graph"), None, *specs)
    assert graph.skipped == {"nothing": "no such table"}
    back = read_graph(spark, str(tmp_path / "graph"), *specs)
    rows = {r.album_id: (r.title, r.name) for r in back.records.collect()}
    assert rows[2] == ("Harbour", "Harbour") and rows[3] == ("Night", None) and len(rows) == 4
    assert back.on.count() == 6


def test_settings_from_json(tmp_path):
    path = tmp_path / "gold.json"
    path.write_text('{"path": "/x", "format": "orc"}')
    assert load(GoldConfig, str(path)) == GoldConfig(path="/x", format="orc")
    path.write_text('{"path": "/x", "nonsense": 1}')
    with pytest.raises(ValueError):
        load(GoldConfig, str(path))


def test_session(spark):
    session = build_session({"spark.sql.linernotes.test": "1"})
    assert session.conf.get("spark.sql.linernotes.test") == "1"
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
