import itertools
import re
import timeit
import zlib

import numpy as np
import pytest

from linernotes.llm.language_id import START, Fit, Model, Pieces, fit, language_of, long_word, sample_ids, verdict, vocabulary, words
from tests.llm.conftest import SCHEMA, row

PIECES = [START, START + "a", "a", "b", "ab", "ba", START + "ab"]


def summed(word, p, pieces):
    """All segmentations one by one."""
    total = 0
    n = len(word)
    for cuts in itertools.product([0, 1], repeat=n - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], n]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        total += np.prod([p[pieces.of(x)] for x in parts], axis=0)
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    pieces = Pieces(PIECES)
    p = rng.random((len(PIECES) + 2, 2))
    p[pieces.none] = 0
    model = Model(["x", "y"], PIECES, p)
    words = ["a", "ab", "abba", "aabab", "cab", "ccc"]
    got = model.word_logs(words)
    for w, logs in zip(words, got):
        assert np.allclose(np.exp(logs), summed(START + w, p, pieces))
        assert np.allclose(long_word(START + w, pieces, p), logs)


def test_long_words_do_not_underflow():
    pieces = Pieces(PIECES)
    p = np.full((len(PIECES) + 2, 2), 1e-3)
    p[pieces.none] = 0
    assert np.isfinite(Model(["x", "y"], PIECES, p).word_logs(["ab" * 5000])).all()


def test_probabilities_sum_to_one():
    model = fit([("de", ["und der die"]), ("en", ["and the of"])], vocabulary())
    covered = model.p[: len(model.pieces)]
    assert np.allclose(covered.sum(axis=0), 1)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_of(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang_pred <> 'und'").collect()
    assert len(got) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_sample_is_bounded_for_each_language(spark):
    rows = [row(i, "text", lang) for i, lang in enumerate(["a"] * 3000 + ["b"] * 40 + ["c"] * 5)]
    docs = spark.createDataFrame(rows + rows[:100], SCHEMA)
    got = sample_ids(docs, Fit(docs_a_language=30)).groupBy("lang").count().collect()
    b, c = (sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids) for ids in (range(3000, 3040), range(3040, 3045)))
    assert {r["lang"]: r["count"] for r in got} == {"a": 30, "b": min(b, 30), "c": c}


def test_odd_rows(spark, odd_docs, no_docs):
    got = language_of(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_text = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert (1, "und") in by_text and (10, "und") in by_text
    assert all(0 <= r["score"] <= 1 for r in got)
    assert language_of(no_docs).count() == 0
    nameless = spark.createDataFrame([row(1, "some words", None)], SCHEMA)
    assert [(r["lang_pred"], r["score"]) for r in language_of(nameless).collect()] == [("und", 0.0)]


def test_numerals_are_no_letters(spark, no_docs):
    texts = ["½ ²", "Ⅷ ⅷ", "①④", "٣ 12", "_", "", None, "½ word", "一"]
    rows = [row(i, t) for i, t in enumerate(texts)] + [row(100 + i, "some plain words", "en") for i in range(9)]
    got = {r["doc_id"]: r["lang_pred"] for r in language_of(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(len(texts))] == ["und"] * 7 + ["en"] * 2


def test_ties_go_to_the_first_language():
    assert verdict(np.zeros(3), ["a", "b", "c"]) == ("a", pytest.approx(1 / 3))


def test_words_are_runs_of_letters():
    assert words("½ab²c Ⅷd٣e_f-g é一") == ["ab", "c", "d", "e", "f", "g", "é一"]
    assert [c for c in map(chr, range(0x110000)) if (words(c) == [c]) != c.isalpha()] == []


def test_numerals_do_not_slow_down_the_reading_of_letters():
    text, plain = "some plain words, 12 of them, über alles " * 5000, re.compile(r"[^\W\d_]+")
    assert words(text) == plain.findall(text)
    own, least = (min(timeit.repeat(f, number=1, repeat=5)) for f in (lambda: words(text), lambda: plain.findall(text)))
    assert own < 4 * least
