import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linernotes.fixed_values import ALBUM_DDL  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def album_rows():
    """In the order of ALBUM_DDL."""
    return [
        ("Ana Sánchez Trio ", " Blue Hour", 1, "1961", "Northern Star",
         ["Late Train (Take 1)", "Late Train (alt take)", "Sea Song", "???"],
         ["Ana Sánchez", "Ana Sánchez", "ANA   SANCHEZ", "Bo Lind", " ", None], ["Ana Sánchez"],
         ["Hard Bop"], "http://c/1"),
        ("Bo Lind", "Harbour", 2, "1965.0", "northern star ",
         ["Sea  Song (Master Take)", "Harbour"],
         ["Bo Lind", "Cy Young", "Ana Sánchez"], ["Bo Lind"], ["Modal"], None),
        ("Cy Young", "Night", 3, "n/a", " ", [], ["Cy Young"], None, None, "http://c/3"),
        ("Nobody", "Empty", 4, None, "Verve", None, None, None, [], None),
    ]


@pytest.fixture(scope="session")
def bronze(spark):
    return spark.createDataFrame(album_rows(), ALBUM_DDL)


@pytest.fixture(scope="session")
def graph(spark, bronze):
    from linernotes.operators import gold, graph as gr

    return gr.load(gold.all_tables(bronze)).map(lambda _, df: df.cache())
