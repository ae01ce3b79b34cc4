import random

import numpy as np
import pytest
import xxhash

from linernotes.llm import simhash
from linernotes.llm.simhash import Shard, components, fingerprint, keep_one, simhash_groups
from tests.llm.conftest import SCHEMA, prose, row


def brute_fingerprint(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = (text or "").translate(table).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(docs, bits=4):
    fps = [brute_fingerprint(t) for _, t in docs]
    label = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for i in range(len(docs)):
            for j in range(len(docs)):
                if bin(fps[i] ^ fps[j]).count("1") <= bits and label[j] > label[i]:
                    label[j], changed = label[i], True
    least = {}
    for (doc_id, _), lab in zip(docs, label):
        least[lab] = min(least.get(lab, doc_id), doc_id)
    return sorted((d, f"{f:016x}", least[lab]) for (d, _), f, lab in zip(docs, fps, label))


def near_copies(rng, n=150):
    docs = [(i, prose(rng, rng.choice([1, 3, 4, 30, 200]))) for i in range(n)]
    for i in range(n, 2 * n):
        words = rng.choice(docs)[1].split()
        words[rng.randrange(len(words))] = "changed"
        docs.append((i, " ".join(words).upper() if rng.random() < 0.3 else " ".join(words)))
    rng.shuffle(docs)
    return docs


def test_fingerprints():
    rng = random.Random(1)
    for text in [None, "", " \n", "One", "a b c", "É é A", prose(rng, 4), prose(rng, 255), prose(rng, 259), prose(rng, 900)]:
        assert fingerprint(None if text is None else text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("shard_rows", [20_000, 4])
def test_groups_against_brute_force(spark, shard_rows):
    docs = near_copies(random.Random(2))
    df = spark.createDataFrame([row(*d) for d in docs], SCHEMA).repartition(5)
    assert sorted(map(tuple, simhash_groups(df, shard_rows=shard_rows).collect())) == brute_groups(docs)


@pytest.mark.parametrize("flips", [3, 20])
def test_tree_finds_every_link(flips):
    """Against all pairs, in a tight cluster and in scattered ones."""
    rng = np.random.default_rng(flips)
    centres = rng.integers(0, 2**63, 20, dtype=np.uint64)
    fps = centres[rng.integers(0, 20, 3000)]
    for _ in range(flips):
        fps ^= np.uint64(1) << rng.integers(0, 64, len(fps), dtype=np.uint64)
    shard = Shard(fps, 4)
    shard.within(np.arange(len(fps)))
    for i in range(len(fps)):
        linked = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4)
        assert (shard.label[linked] == shard.label[i]).all()


def test_masks_of_every_number_of_blocks():
    """Whatever bits are flipped, some tree sees none of them."""
    rng = random.Random(5)
    for blocks in (1, 2, 3, 4):
        masks = simhash.tree_masks(4, blocks)
        for _ in range(3000):
            flipped = sum(1 << b for b in rng.sample(range(64), rng.randrange(5)))
            assert any(not flipped & m for m in masks)
    assert [simhash.blocks_for(n, 4) for n in (0, 10**6, 10**8, 10**10, 10**14)] == [1, 1, 2, 3, 4]


def near_and_far(spark, n, spread, copies):
    """Fingerprints at random or in clusters (``spread`` bits about few centres), each with a near copy at times."""
    rng = np.random.default_rng(n)
    fps = rng.integers(0, 2**64, n, dtype=np.uint64)
    if spread:
        fps = fps[rng.integers(0, 6, n)]
        for _ in range(spread):
            fps ^= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    near = fps[:copies].copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, copies, dtype=np.uint64)
    fps = np.unique(np.concatenate([fps, near]))
    return fps, spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps.view(np.int64))], "node long, fp long")


def linked(fps):
    """Each fingerprint's group by all pairs, named by its smallest."""
    label = np.arange(len(fps))
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4)
        for other in np.unique(label[near]):
            label[label == other] = label[near].min()
    least = {}
    for i, one in enumerate(label):
        least.setdefault(one, i)
    return [least[one] for one in label]


@pytest.mark.parametrize("spread, leaf_rows, shard_rows", [(0, 64, 20_000), (8, 32, 20_000), (14, 16, 40), (2, 8, 20)])
def test_links_against_all_pairs(spark, spread, leaf_rows, shard_rows):
    fps, nodes = near_and_far(spark, 1500, spread, 400)
    found = components(simhash.links(nodes, 4, shard_rows, leaf_rows))
    group = {r["node"]: r["component"] for r in found.collect()}
    assert [group.get(i, i) for i in range(len(fps))] == linked(fps)


@pytest.mark.parametrize("blocks", [1, 2, 3])
def test_near_fingerprints_share_a_leaf(spark, blocks):
    fps, nodes = near_and_far(spark, 600, 0, 300)
    at = {}
    for r in simhash.leaves(nodes, 4, 8, blocks).collect():
        at.setdefault(r["node"], {})[r["tree"]] = r["leaf"]
    assert {len(trees) for trees in at.values()} == {len(simhash.tree_masks(4, blocks))}
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            assert any(at[i][t] == at[j][t] for t in at[i])


@pytest.mark.parametrize("spread", [0, 14])
def test_trees_prune(spark, spread):
    """Distances computed, routing included, are far fewer than all pairs; leaves are large, and pruned inside."""
    fps, nodes = near_and_far(spark, 20_000, spread, 1000)
    routed = simhash.leaves(nodes, 4, 512).toPandas()
    compared, inside, sizes = 0, 0, []
    for _, leaf in routed.groupby(["tree", "leaf"]):
        shard = Shard(leaf["fp"].to_numpy().view(np.uint64), 4)
        shard.within(np.arange(len(leaf)))
        compared += shard.compared
        inside += len(leaf) ** 2
        sizes.append(len(leaf))
    pairs = len(fps) * (len(fps) - 1) / 2
    assert compared + 2 * 3 * len(routed) < 0.1 * pairs
    assert max(sizes) > simhash.LEAF and compared < 0.6 * inside


def test_components_of_a_path_and_a_star(spark):
    path = [(i + 1, i) for i in range(10, 40)]
    star = [(100 + i, 100) for i in range(1, 30)]
    got = dict(map(tuple, components(spark.createDataFrame(path + star, "u long, v long")).collect()))
    assert got == {**{i: 10 for i in range(11, 41)}, **{100 + i: 100 for i in range(1, 30)}}


def test_one_of_each_group_stays(spark):
    docs = near_copies(random.Random(3))
    want = sorted({c for _, _, c in brute_groups(docs)})
    df = spark.createDataFrame([row(*d) for d in [*docs, docs[0]]], SCHEMA)
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_odd_rows(odd_docs, no_docs):
    got = simhash_groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in zero} == {0}
    assert simhash_groups(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0
