import itertools
import math
import random

import pytest

from linernotes.llm.decontaminate import MASKS, SHARE, SHORT_MASKS, WINDOW, contaminated, drop_contaminated
from tests.llm.conftest import SCHEMA, prose, row


def test_masks_survive_any_four_substitutions():
    """Each placement of four exchanged words in a window leaves a seed whose words are all untouched."""
    seeds = [{s + i for i, b in enumerate(m) if b == "1"} for m in MASKS for s in range(WINDOW - len(m) + 1)]
    for changed in itertools.combinations(range(WINDOW), 4):
        assert any(seed.isdisjoint(changed) for seed in seeds)


def brute(docs, items):
    words = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "").lower()).split()
    found = set()
    for doc_id, text in docs:
        own = words(text)
        for item_id, passage in items:
            item = words(passage)
            window = min(WINDOW, len(item))
            if not item:
                continue
            for shift in range(-len(item), len(own)):
                equal = [0 <= shift + i < len(own) and own[shift + i] == w for i, w in enumerate(item)]
                inside = [i for i in range(len(item) - window + 1) if 0 <= shift + i and shift + i + window <= len(own)]
                if any(5 * sum(equal[i : i + window]) >= 4 * window for i in inside):
                    found.add((doc_id, item_id))
    return found


def case():
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    fresh = lambda n: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    items = [(i, fresh(n)) for i, n in enumerate([25, 40, 60, 20, 12, 5])]
    docs = [(i, fresh(60)) for i in range(20)]
    for i in range(20, 80):
        passage = rng.choice(items)[1].split()
        a = rng.randrange(0, max(1, len(passage) - 20))
        part = passage[a : a + rng.choice([15, 20, 24, 60])]
        for _ in range(rng.choice([0, 0, 2, 4, 6])):
            part[rng.randrange(len(part))] = fresh(1)
        docs.append((i, fresh(30) + ". " + ", ".join(part).upper() + "! " + fresh(rng.choice([0, 300]))))
    return docs, items


def test_against_brute_force(spark):
    docs, items = case()
    df = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(df, bench).collect()}
    want = brute(docs, items)
    assert want and got == want
    kept = {r["doc_id"] for r in drop_contaminated(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


def test_a_document_full_of_passages(spark):
    _, items = case()
    text = " ".join(items[1][1] for _ in range(200))
    df = spark.createDataFrame([row(1, text), row(1, text)], SCHEMA)
    bench = spark.createDataFrame(items + [items[1], (None, items[1][1]), (9, None)], "item_id long, text string")
    got = contaminated(df, bench).collect()
    assert sorted((r["doc_id"], r["item_id"] is None, r["first_word"], r["equal_words"]) for r in got) == [(1, False, 0, 20), (1, True, 0, 20)]


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, prose(random.Random(9), 30))], "item_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(odd_docs, bench).count() == 0
    assert contaminated(odd_docs, empty).count() == 0
    assert contaminated(no_docs, bench).count() == 0
    kept = drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    own = spark.createDataFrame([(1, " ".join(odd_docs.filter("doc_id = 6").first()["text"].split()[:30]))], "item_id long, text string")
    assert {r["doc_id"] for r in contaminated(odd_docs, own).collect()} == {6, 7, None}
    assert drop_contaminated(odd_docs, own).count() == odd_docs.count() - 4


@pytest.mark.parametrize("n", range(1, WINDOW))
def test_masks_of_short_items_survive_the_allowed_substitutions(n):
    seeds = [{s + i for i, b in enumerate(m) if b == "1"} for m in SHORT_MASKS.get(n, MASKS) for s in range(n - len(m) + 1)]
    for changed in itertools.combinations(range(n), n - math.ceil(n * SHARE)):
        assert any(seed.isdisjoint(changed) for seed in seeds)


def test_short_items_of_every_length(spark):
    """Each placement (of those of many, some) of the allowed substitutions is found, of one more not."""
    rng = random.Random(8)
    fresh = lambda n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n)]
    items = [(n, " ".join(fresh(n))) for n in range(1, WINDOW)]
    docs, want = [], set()
    for n, passage in items:
        allowed = n - math.ceil(n * SHARE)
        for k in range(allowed + 2):
            places = list(itertools.combinations(range(n), k))
            for changed in rng.sample(places, min(60, len(places))):
                words = passage.split()
                for i in changed:
                    words[i] = fresh(1)[0]
                docs.append((len(docs), " ".join(fresh(rng.choice([0, 3, 50])) + words + fresh(rng.choice([0, 2, 60])))))
                if k <= allowed:
                    want.add((docs[-1][0], n))
    # The places of an item of 15 words that the three masks miss.
    words = items[14][1].split()
    docs.append((len(docs), " ".join(fresh(1)[0] if i in (2, 7, 9) else w for i, w in enumerate(words))))
    want.add((docs[-1][0], 15))
    df = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(df, bench).collect()} == want
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(df, bench, shortest=6).collect()} == {(d, n) for d, n in want if n >= 6}


def test_scripts_without_spaces(spark):
    passage = "今日は天気がとても良いので公園まで散歩に行きました"
    changed = passage.replace("公園", "学校")
    docs = [(1, "前置き" + passage + "後書き"), (2, "序文。" + changed), (3, "全く別の文章で、何も同じではありません"), (4, passage[:12])]
    df = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert {r["doc_id"] for r in contaminated(df, bench).collect()} == {1, 2}
