import hashlib
import random
from collections import defaultdict

from linernotes.llm.line_dedup import with_lines_dropped
from tests.llm.conftest import SCHEMA, row

UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    key = lambda line: line.translate(UPPER_TO_LOWER).strip(" \t\n\x0b\x0c\r")
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= 20:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        gone = [doc_id is not None and len(holders[key(x)]) >= 3 and max(holders[key(x)]) != doc_id for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((doc_id, len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rng = random.Random(1)
    shared = ["A line that many documents share", "  a line THAT many documents share\t", "ÉCOLE is kept in its own case here", "école is kept in its own case here", "short line", "x" * 19, "x" * 20]
    docs = []
    for i in range(120):
        lines = [rng.choice(shared) if rng.random() < 0.6 else f"an own line of document number {i} {rng.random()}" for _ in range(rng.randint(0, 12))]
        docs.append((i, "\n".join(lines)))
    docs += [(200, None), (201, ""), (None, "\n".join(shared)), (3, docs[3][1]), (4, "a line that many documents share")]
    df = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    assert sorted(map(tuple, with_lines_dropped(df, digest=True).collect()), key=repr) == brute(docs)


def test_odd_rows(odd_docs, no_docs):
    got = with_lines_dropped(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r["n_lines"] >= 1 and r["kept"] is not None for r in got)
    assert with_lines_dropped(no_docs).count() == 0
