import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from linernotes.llm.mixing import quota_of, Mixture, budget_of, entropy, exponent_for, mix, mixed, weights
from tests.llm.conftest import SCHEMA, prose, row


def docs_of(n=400):
    rng = random.Random(1)
    return [(i, prose(rng, rng.randint(0, 80)), rng.choice("aaaaaaabbc")) for i in range(n)]


def brute(docs, mixture):
    tokens = Counter()
    for _, text, source in docs:
        tokens[source] += len((text or "").split())
    names = sorted(s for s in tokens if tokens[s])
    own = [tokens[s] for s in names]
    shares = weights(own, exponent_for(own, mixture))
    total = budget_of(own, shares, mixture.budget)
    out = []
    for name, share in zip(names, shares):
        left, epoch = math.floor(share * total + 1e-6), 0
        while left > 0:
            epoch += 1
            keyed = sorted((hashlib.md5(f"{mixture.seed}|{epoch}|{i}".encode()).hexdigest(), i, len((t or "").split())) for i, t, s in docs if s == name)
            for key, i, n in keyed:
                if n > left:
                    left = 0
                    break
                left -= n
                out.append((i, name, epoch, int(key[:3], 16)))
    return sorted(out)


@pytest.mark.parametrize("mixture", [Mixture(), Mixture(entropy=1.0, repeats=50), Mixture(repeats=1.2), Mixture(budget=5000), Mixture(entropy=0.5), Mixture(budget=60_000, repeats=9)])
def test_schedule_against_brute_force(spark, mixture):
    docs = docs_of()
    df = spark.createDataFrame([row(i, t, "en", s) for i, t, s in docs], SCHEMA)
    got = [(r["doc_id"], r["source"], r["epoch"], r["block"]) for r in mixed(df, mixture).collect()]
    assert sorted(got) == brute(docs, mixture)
    assert Counter(r["doc_id"] for r in mix(df, mixture).collect()) == Counter(g[0] for g in got)


def test_exponent():
    tokens = [9000, 500, 300, 200]
    for goal in (0.5, 0.8, 0.97):
        mixture = Mixture(entropy=goal, repeats=1e9)
        found = entropy(weights(tokens, exponent_for(tokens, mixture)))
        assert found >= goal * math.log(4) - 1e-9
        if exponent_for(tokens, mixture) < 1:
            assert found == pytest.approx(goal * math.log(4), abs=1e-6)
    mixture = Mixture(entropy=1.0, repeats=2.0)
    shares = weights(tokens, exponent_for(tokens, mixture))
    total = budget_of(tokens, shares, None)
    assert max(s * total / t for s, t in zip(shares, tokens)) == pytest.approx(2.0, abs=1e-6)
    assert exponent_for([5], mixture) == 1.0


def test_first_epochs_are_whole(spark):
    docs = docs_of()
    df = spark.createDataFrame([row(i, t, "en", s) for i, t, s in docs], SCHEMA)
    epochs = defaultdict(set)
    for r in mixed(df).collect():
        epochs[r["doc_id"]].add(r["epoch"])
    assert all(1 in epochs[i] for i, _, _ in docs)


def test_large_first_epochs_stay_whole():
    rng = random.Random(6)
    tokens = [rng.randrange(2**33, 2**35) for _ in range(15_000)]
    shares = [t / sum(tokens) for t in tokens]
    total = max(t / s for t, s in zip(tokens, shares))
    assert all(quota_of(s, total, t, None) // t >= 1 for s, t in zip(shares, tokens))


def test_odd_rows(odd_docs, no_docs):
    got = mixed(odd_docs).collect()
    assert {r["source"] for r in got} == {"", "a"}
    assert len([r for r in got if r["epoch"] == 1]) == odd_docs.count()
    assert mixed(no_docs).count() == 0
    assert mix(odd_docs).columns == odd_docs.columns
