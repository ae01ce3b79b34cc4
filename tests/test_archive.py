import os
import uuid

import pytest

from linernotes.config import BronzeConfig
from linernotes.sources import tables as tb
from linernotes.streaming import bronze as br
from tests.test_ingest import album, put


@pytest.fixture(params=["configured", "learned"])
def cfg(tmp_path, request):
    (tmp_path / "landing").mkdir()
    settings = {} if request.param == "configured" else {"schema": None}

    def make(**more):
        return BronzeConfig(
            landing=str(tmp_path / "landing"), bronze=str(tmp_path / "bronze"), checkpoint=str(tmp_path / "checkpoint"),
            archive=str(tmp_path / "archive"), database=f"archive_{uuid.uuid4().hex[:8]}", **settings, **more)

    return make


def ids(spark, c):
    return sorted(r["id"] for r in tb.read_bronze(spark, c).select("id").collect())


def names(folder):
    return sorted(f for _, _, found in os.walk(folder) for f in found if not f.startswith("."))


def test_landing_empties_itself(spark, cfg):
    c = cfg(max_files_per_trigger=1)
    for i in range(3):
        put(c, f"{i}.json", album(i))
    br.run_bronze(spark, c)
    put(c, "3 with spaces.json", album(3))
    br.run_bronze(spark, c)
    put(c, "4.json", album(4))
    br.run_bronze(spark, c)
    assert ids(spark, c) == [0, 1, 2, 3, 4]
    left, moved = names(c.landing), names(c.archive)
    assert sorted(left + moved) == ["0.json", "1.json", "2.json", "3 with spaces.json", "4.json"]
    assert set(left) <= {"4.json"}


def test_a_name_is_admitted_once(spark, cfg):
    c = cfg()
    put(c, "a.json", album(1))
    br.run_bronze(spark, c)
    os.mkdir(f"{c.landing}/other")
    put(c, "other/a.json", album(2))
    put(c, "b.json", album(3))
    br.run_bronze(spark, c)
    assert ids(spark, c) == [1, 3]


def test_names_stored_before_are_left_out(spark, cfg, tmp_path):
    stored = tmp_path / "stored" / "deep"
    c = cfg(stored=str(tmp_path / "stored"))
    put(c, "a.json", album(1))
    br.run_bronze(spark, c)  # nothing is stored yet
    stored.mkdir(parents=True)
    (stored / "b b.json").write_text("{}")
    put(c, "b b.json", album(2))
    put(c, "c.json", album(3))
    br.run_bronze(spark, c)
    assert ids(spark, c) == [1, 3]
    assert spark.table(c.table).count() == 2


def test_a_new_checkpoint_knows_the_archive(spark, cfg, tmp_path):
    from dataclasses import replace

    c = cfg(stored=str(tmp_path / "archive"), max_files_per_trigger=1)
    put(c, "a.json", album(1))
    put(c, "b.json", album(2))
    br.run_bronze(spark, c)
    gone = names(c.archive)
    assert gone  # at least all but the last batch's
    for name in gone:
        put(c, name, album(9))
    for name in names(c.landing):
        if name not in gone:
            os.rename(f"{c.landing}/{name}", f"{c.archive}/{name}")
    put(c, "c.json", album(3))
    br.run_bronze(spark, replace(c, checkpoint=str(tmp_path / "second")))
    assert ids(spark, c) == [1, 2, 3]
