import hashlib
import random
import zlib

import pytest

from linernotes.llm import manifest as m
from tests.llm.conftest import SCHEMA, row


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    values = [r[0], r[3], r[2], r[4], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, the path of each node: its place in its run and the run's other nodes, level by level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for path, a in zip(paths, at):
            run = runs[a // 16]
            path.append((run[: a % 16], run[a % 16 + 1 :]))
        nodes, at = [h("".join(run)) for run in runs], [a // 16 for a in at]
    return nodes[0], paths


def brute(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    within = {s: sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for s in order}
    trees = {s: tree([leaf(r, r[1]) for r in within[s]]) for s in order}
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for r, path in zip(within[s], trees[s][1]):
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = text.translate(lower)
            node = leaf(r, text)
            for before, after in path + top:
                node = h("".join(before) + node + "".join(after))
            proof = h("".join("".join(before + after) for before, after in path + top))
            out.append((r[0], leaf(r, r[1]), trees[s][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def docs(sizes, seed=3):
    rng, rows = random.Random(seed), []
    for source, n in sizes:
        rows += [row(len(rows) + i, rng.choice(["Some Text", "no capitals", "", None, f"É {rng.random()}"]), rng.choice(["en", None]), source) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    [("a", 1)], [("a", 16), (None, 17)], [("b", 4097), ("a", 1), (None, 300), ("", 257), ("ü", 16)], [(f"s{i}", 1 + i % 3) for i in range(300)],
])
def test_against_brute_force(spark, sizes):
    rows = docs(sizes)
    got = m.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_tables_of_several_rounds(spark):
    """Superblocks of one level: a source of 700 leaves takes three tables, as 4096 ** 3 leaves do."""
    rows = docs([("a", 700), ("b", 17), (None, 1), *[(f"s{i}", 1) for i in range(20)]])
    assert sorted(map(tuple, m.manifest(spark.createDataFrame(rows, SCHEMA), levels=1).collect()), key=repr) == brute(rows)


def test_tampering_shows(spark):
    rows = docs([("a", 400), ("b", 30)])
    got = {r["doc_id"]: r["verified"] for r in m.manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    for r in rows:
        changed = zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] not in (None, "", "no capitals") and r[1].startswith("S")
        assert got[r[0]] is not changed
    assert not all(got.values())


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.collect()]
    got = m.manifest(odd_docs)
    assert dict(got.dtypes)["doc_id"] == "bigint"
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert m.manifest(no_docs).count() == 0
    clash = odd_docs.withColumns({c: odd_docs["score"].cast("string") for c in ("tree", "pos", "total", "digest", "root", "a.b")})
    assert m.manifest(clash).count() == len(rows)


def test_large_ids_stay_exact(spark):
    rows = [row(2**53 + 1, "Text"), row(2**53, "Text"), row(None, "Text")]
    assert sorted(map(tuple, m.manifest(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == brute(rows)
