import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from linernotes.functions import text as tx


def values(spark, f, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [r.x for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


def test_norm_text(spark):
    cases = {
        "  ¿Qué   pasó?  ": "que paso",
        "Señor-Blues": "senor blues",
        "a_b\tc": "a_b c",
        "Børn": "b rn",
        "Étude": "e tude",
        " edge ": "edge",
        "???": "",
        "": "",
    }
    assert values(spark, tx.norm_text, *cases) == list(cases.values())
    assert values(spark, tx.norm_text, None) == [None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aZ9_ÀéñøÇ?!( )-\t K", max_size=12), min_size=1, max_size=30))
def test_title_normaliser_is_strip_then_norm(spark, texts):
    titles = values(spark, tx.norm_title, *texts)
    assert titles == values(spark, lambda c: tx.norm_text(tx.strip_takes(c)), *texts)


@pytest.mark.parametrize("raw,clean", [
    ("Tune (take 7)", "Tune"),
    ("TUNE   (Second Take)   ", "TUNE"),
    ("(short take) Tune", "Tune"),
    ("Tune (Take Two) reprise", "Tune reprise"),
    ("mistake (mistake)", "mistake (mistake)"),
    ("x (a) (take) (b)", "x (a) (b)"),
    ("plain", "plain"),
])
def test_strip_takes(spark, raw, clean):
    assert values(spark, tx.strip_takes, raw) == [clean]


def test_ids_match_hashlib(spark):
    want = hashlib.sha256("northern star".encode()).hexdigest()
    assert values(spark, tx.label_key, " Northern STAR ") == [want]
    assert values(spark, lambda c: tx.content_id(tx.norm_text(c)), "Northern  Star!") == [want]


def test_year_number(spark):
    cases = {"1959": 1959, "1959.0": 1959, " 1959 ": 1959, "-3": -3, "abc": None, "": None,
             "1e3": None, "99999999999": None}
    assert values(spark, tx.year_number, *cases) == list(cases.values())


def test_table_name():
    assert tx.table_name("  Album Works  ") == "album_works"


def test_contains_is_literal(spark):
    texts = ["50% off", "a_b", "ABC", None]
    assert values(spark, lambda c: tx.contains_text(c, "%"), *texts) == [True, False, False, None]
    assert values(spark, lambda c: tx.contains_text(c, "_"), *texts) == [False, True, False, None]
    assert values(spark, lambda c: tx.contains_text(c, "Bc"), *texts) == [False, False, True, None]
    assert values(spark, lambda c: tx.contains_text(c, ""), *texts) == [True] * 4


def test_prefix_rank(spark):
    assert values(spark, lambda c: tx.prefix_rank(c, "AB"), "abc", "cab") == [0, 1]
    assert values(spark, lambda c: tx.prefix_rank(c, ""), "abc", "cab") == [1, 1]
