import random
import re
from collections import Counter, defaultdict

import pytest

from linernotes.llm import collocations as c
from tests.llm.conftest import SCHEMA, row

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(docs):
    for _, text, lang, *_ in docs:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            yield lang or "und", [w for w in re.split(r"[ \t]+", piece) if w]


def counts(docs):
    f, n = Counter(), Counter()
    for lang, w in pieces(docs):
        n[lang] += len(w)
        f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return f, n


def brute(docs, min_count=10, limit=2000):
    f, n = counts(docs)
    strong = {g: a for g, a in f.items() if a >= min_count and len(g[1]) > 1}
    rows, holders = defaultdict(list), defaultdict(list)
    for (lang, q), b in strong.items():
        if len(q) == 3:
            holders[lang, q[:2]].append(b)
            holders[lang, q[1:]].append(b)
    for (lang, p), a in strong.items():
        if any(100 * b >= 50 * a for b in holders[lang, p]):
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        rows[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in rows.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:limit])
    )


def docs(n=300, seed=4):
    """Skewed words, fixed phrases, repeated passages, several languages."""
    rng, rows = random.Random(seed), []
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("a", "É", "io", "U")]
    passage = " ".join(rng.choice(words) + str(i) for i in range(40))
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 12)):
            text.append(rng.choice(["New York city", "hot dog", "of the", passage, rng.choice(words)]) if rng.random() < 0.4 else words[min(int(rng.expovariate(0.3)), len(words) - 1)])
            text.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", " \x0b", "; "]))
        rows.append(row(i, "".join(text), rng.choice(["en", "en", "en", "de", None])))
    return rows


def test_against_brute_force(spark):
    rows = docs()
    got = sorted(map(tuple, c.collocations(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()))
    assert got == brute(rows) and len(got) > 30
    assert sorted(map(tuple, c.collocations(spark.createDataFrame(rows, SCHEMA), min_count=2, limit=7).collect())) == brute(rows, 2, 7)


@pytest.mark.parametrize("together,segment", [(1, 1), (7, 3), (50, 20)])
def test_parts_of_any_size_count_alike(spark, together, segment):
    """Walks handed on in the middle of a piece go on as if they had not been."""
    rows, found = docs(60), Counter()
    walks, saved = {}, (c.SEGMENT,)
    c.SEGMENT = segment
    try:
        for _, text, lang, *_ in rows:
            walk = walks.setdefault(lang or "und", c.Walks())
            for part in c.segments((text or "").encode().translate(c.PLAIN) + b"\n"):
                walk.add(part)
                if walk.size >= together:
                    tally(found, lang or "und", walk.grams(False, 5))
        for lang, walk in walks.items():
            tally(found, lang, walk.grams(True, 5))
    finally:
        (c.SEGMENT,) = saved
    want = Counter()
    for lang, w in pieces(rows):
        want.update((lang, " ".join(w[i : i + 3])) for i in range(len(w)))
    assert found == want


def tally(found, lang, batch):
    for ones, twos, grams, numbers in zip(*(batch.columns[1:] if batch else ((), (), (), ()))):
        lengths = [len(g.split(" ")) for g in grams.as_py().split("\n")]
        assert lengths == [1 if i < ones.as_py() else 2 if i < twos.as_py() else 3 for i in range(len(lengths))]
        for gram, n in zip(grams.as_py().split("\n"), numbers.as_py()):
            found[lang, gram] += n


def test_counts_follow_from_flow(spark):
    rows = docs()
    f, n = counts(rows)
    got = {(r["lang"], tuple(r["gram"].split(" ")) if r["words"] else ()): r["n"] for r in c.frequent(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {g: a for g, a in f.items() if a >= 10} | {(lang, ()): a for lang, a in n.items() if a}
    assert got == want


def test_products_beyond_64_bits(spark):
    found = spark.createDataFrame([
        ("en", 0, "", 10**13), ("en", 1, "x", 3 * 10**12 + 1), ("en", 1, "y", 3 * 10**12 + 7), ("en", 2, "x y", 10**12 + 3)], "lang string, words int, gram string, n long")
    (got,) = c.scored(c.candidates(found), found).collect()
    assert got["score"] == 1000000 * (10**12 + 3) ** 2 // ((3 * 10**12 + 1) * (3 * 10**12 + 7))


def test_unary_paths(spark):
    rows = docs()
    found = c.frequent(spark.createDataFrame(rows, SCHEMA))
    f, _ = counts(rows)
    strong = {g: a for g, a in f.items() if len(g[1]) == 3 and a >= 10}

    def is_inner(lang, node):
        into = [a for (x, e), a in strong.items() if x == lang and e[1:] == node]
        out = [a for (x, e), a in strong.items() if x == lang and e[:2] == node]
        return max(into, default=0) == max(out, default=0) == f[lang, node]

    want = []
    for (lang, edge), a in strong.items():
        if is_inner(lang, edge[:2]):
            continue
        path = list(edge)
        while is_inner(lang, tuple(path[-2:])):
            path.append(next(e[2] for (x, e), b in strong.items() if x == lang and e[:2] == tuple(path[-2:]) and b == a))
        want.append((lang, " ".join(path), a))
    got = sorted(map(tuple, c.unary_paths(found).collect()))
    assert got == sorted(want) and max(len(p.split()) for _, p, _ in got) >= 30


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.collect()]
    assert sorted(map(tuple, c.collocations(odd_docs, min_count=2).collect())) == brute(rows, 2)
    assert c.collocations(no_docs).count() == 0
    clash = odd_docs.withColumns({x: odd_docs["score"] for x in ("gram", "n", "bucket", "a", "rank", "a.b")})
    assert c.collocations(clash, min_count=2).count() == len(brute(rows, 2))


def test_ties_go_by_bytes(spark):
    text = ". ".join(["a b", "É f", "z z1", "a B"] * 12)
    rows = [row(1, text, "en"), row(1, text, "en")]
    assert sorted(map(tuple, c.collocations(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)
