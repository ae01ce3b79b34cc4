import random
import zlib
from collections import Counter

from linernotes.llm.sharding import shard_documents, shard_table
from tests.llm.conftest import SCHEMA, prose, row


def docs_of(n=1003):
    rng = random.Random(1)
    return [(i, prose(rng, rng.randint(0, 10)), rng.choice("aaaaaabbc")) for i in range(n)]


def laws(rows, n, shards=40):
    counts = Counter(r["shard"] for r in rows)
    assert sum(counts.values()) == n and max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s, c in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(c))


def test_laws_and_mixture(spark):
    docs = docs_of()
    df = spark.createDataFrame([row(i, t, "en", s) for i, t, s in docs], SCHEMA).repartition(7)
    got = shard_table(df).collect()
    laws(got, len(docs))
    texts = {i: t for i, t, _ in docs}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)
    of_source = {i: s for i, _, s in docs}
    for source, n in Counter(of_source.values()).items():
        for s in range(40):
            assert abs(sum(of_source[r["doc_id"]] == source for r in got if r["shard"] == s) - n / 40) <= 2
    again = shard_table(df.repartition(3)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_documents_keep_their_columns(spark):
    docs = docs_of(300)
    rows = [row(i, t, "en", s) for i, t, s in docs]
    df = spark.createDataFrame(rows + rows[:50] + rows[:20], SCHEMA)
    got = shard_documents(df)
    assert got.columns == [*df.drop("shard").columns, "shard", "slot"]
    got = got.collect()
    laws(got, 370)
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in df.collect())


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([row(1, "a text")], SCHEMA)
    for made in (shard_table(df), shard_documents(df)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(odd_docs, no_docs):
    got = shard_table(odd_docs).collect()
    laws(got, odd_docs.count())
    laws(shard_documents(odd_docs).collect(), odd_docs.count())
    assert shard_table(no_docs).count() == 0
