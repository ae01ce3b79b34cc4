"""SimHash near-duplicates found with vantage-point trees.

A tree over all 64 bits has to enter both branches at most nodes: fingerprints lie 32 bits apart give or
take 4, and the bound is 4 as well. So there is a tree for each choice of blocks of the bits, which measures
the Hamming distance on its blocks only. Two fingerprints within four bits agree on all blocks of at least
one choice; in that tree both are as far from any vantage point, the triangle bound is zero, and a node's
branches (one for each pair of distances to its two vantage points) never have to be entered together.
A node's vantage points are taken from its own rows and kept in a table, and rows go down the tree by
joins with it, until a node holds few enough rows or its rows differ in other blocks only. Such a node,
where it is large, is cut by rings of the whole distance, and fingerprints within the bound of a ring's
lower boundary are also sent, as guests, to the ring below. Inside a leaf a vantage-point tree splits by
the whole distance and enters two branches together only within the bound.

The more fingerprints there are, the more blocks a choice has, so that leaves stay small: one of five blocks
(5 trees) up to some millions, two of six (15), three of seven (35), four of eight (70).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from linernotes.llm.common import LOWER_BYTES, cut, named, stored

#: The vantage point of the rings, an arbitrary fixed point, and the rings' width.
VANTAGE, RING = 0x5BD1E995C2B2AE35, 8
#: A tree's node of more rows is split, if its rows differ on the tree's blocks.
LEAF_ROWS = 512
#: Rows of a shard that one task compares at a time; larger shards are compared in blocks.
SHARD_ROWS = 20_000
#: Rows that the tree inside a leaf compares in pairs.
LEAF = 48
#: Blocks that a tree measures: up to four of eight.
MOST_BLOCKS = 4


def fingerprint(data: bytes | None, words_a_shingle: int = 4) -> int:
    """The 64-bit SimHash of a text's bytes; a text without words has 0."""
    words = (data or b"").translate(LOWER_BYTES).split()
    if not words:
        return 0
    if len(words) < words_a_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_a_shingle))))
    digests = b"".join([xxhash.xxh64_digest(s, 42) for s in shingles])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 255):  # so many rows can't overflow a byte
        lanes = np.unpackbits(hashes[i : i + 255], axis=1).view(np.uint64)
        ones += lanes.sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint_of(texts: pd.Series) -> pd.Series:
    """The fingerprint's 64 bits as a signed long."""
    return pd.Series(np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long) of each row."""
    return docs.select("doc_id", F.pandas_udf(fingerprint_of, "long")(F.col("text").cast("binary")).alias("fp"))


def hex_digits(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class Shard:
    """Joins the fingerprints of a shard into groups of links at most ``bits`` apart."""

    def __init__(self, fps: np.ndarray, bits: int):
        self.fps, self.bits = fps, bits
        self.label = np.arange(len(fps))
        #: Distances computed so far, to other rows and to vantage points.
        self.compared = 0

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Compares all of a with all of b, indexes of few rows each."""
        self.compared += len(a) * len(b)
        close = np.bitwise_count(self.fps[a][:, None] ^ self.fps[b][None, :]) <= self.bits
        close &= self.label[a][:, None] != self.label[b][None, :]
        while close.any():
            i, j = np.unravel_index(close.argmax(), close.shape)
            one, other = sorted((self.label[a[i]], self.label[b[j]]))
            self.label[self.label == other] = one
            close &= self.label[a][:, None] != self.label[b][None, :]

    def parts(self, ids: np.ndarray, vantage: np.uint64, radius: int) -> tuple[np.ndarray, ...]:
        """Inside, outside, and of either what lies close enough to the boundary to have links across."""
        self.compared += len(ids)
        d = np.bitwise_count(self.fps[ids] ^ vantage).astype(int)
        inner = d <= radius
        return ids[inner], ids[~inner], ids[inner & (d > radius - self.bits)], ids[~inner & (d <= radius + self.bits)]

    def within(self, ids: np.ndarray) -> None:
        """All links among ids."""
        if len(ids) <= LEAF:
            self.link(ids, ids)
            return
        vantage = self.fps[ids[0]]
        radius = int(np.median(np.bitwise_count(self.fps[ids] ^ vantage)))
        inner, outer, near_in, near_out = self.parts(ids, vantage, radius)
        if not len(inner) or not len(outer):
            self.tiles(ids, ids)
            return
        self.within(inner)
        self.within(outer)
        self.across(near_in, near_out)

    def across(self, a: np.ndarray, b: np.ndarray) -> None:
        """All links between a and b."""
        if len(a) * len(b) <= 4 * LEAF * LEAF:
            if len(a) and len(b):
                self.link(a, b)
            return
        vantage = self.fps[(a if len(a) >= len(b) else b)[0]]
        both = np.bitwise_count(self.fps[np.concatenate([a, b])] ^ vantage)
        radius = int(np.median(both))
        a_in, a_out, a_near_in, a_near_out = self.parts(a, vantage, radius)
        b_in, b_out, b_near_in, b_near_out = self.parts(b, vantage, radius)
        kept = len(a_in) * len(b_in) + len(a_out) * len(b_out) + len(a_near_in) * len(b_near_out) + len(a_near_out) * len(b_near_in)
        if kept > 0.9 * len(a) * len(b):  # the split prunes nothing here
            self.tiles(a, b)
            return
        self.across(a_in, b_in)
        self.across(a_out, b_out)
        self.across(a_near_in, b_near_out)
        self.across(a_near_out, b_near_in)

    def tiles(self, a: np.ndarray, b: np.ndarray, side: int = 512) -> None:
        for i in range(0, len(a), side):
            for j in range(0, len(b), side):
                self.link(a[i : i + side], b[j : j + side])


def shard_links(nodes: np.ndarray, fps: np.ndarray, role: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the groups of a shard: each node with its group's first. role: 0 home, 1 guest, or

    for a pair of blocks of a large shard 2 and 3: their members only meet across.
    """
    shard = Shard(fps.view(np.uint64), bits)
    kinds = [np.flatnonzero(role == r) for r in range(4)]
    if len(kinds[0]):
        shard.within(kinds[0])
        if len(kinds[1]):
            shard.across(kinds[0], kinds[1])
    if len(kinds[2]) and len(kinds[3]):
        shard.across(kinds[2], kinds[3])
    moved = np.flatnonzero(shard.label != np.arange(len(fps)))
    return nodes[moved], nodes[shard.label[moved]]


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def tree_masks(bits: int, blocks: int) -> list[int]:
    """The bits of each tree: any two fingerprints within ``bits`` agree on all bits of one of these masks.

    Of ``bits`` + ``blocks`` blocks of the 64 bits at most ``bits`` differ, so ``blocks`` of them agree.
    """
    edges = [64 * i // (bits + blocks) for i in range(bits + blocks + 1)]
    parts = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks)]


def blocks_for(count: int, bits: int, leaf_rows: int = LEAF_ROWS) -> int:
    """The fewest blocks a tree for which evenly spread fingerprints would leave leaves of at most ``leaf_rows``."""
    for blocks in range(1, MOST_BLOCKS):
        if count <= leaf_rows << min(m.bit_count() for m in tree_masks(bits, blocks)):
            return blocks
    return MOST_BLOCKS


def leaves(nodes: DataFrame, bits: int = 4, leaf_rows: int = LEAF_ROWS, blocks: int | None = None) -> DataFrame:
    """(node, fp, tree, leaf): each row once in every tree. Rows that agree on a tree's bits share its leaf.

    A round splits all nodes above ``leaf_rows`` whose rows differ on the tree's bits; a node's row at distance
    zero of itself parts from some other, so the rounds end. Two nodes whose hashed names meet are one.
    """
    if not 0 <= bits <= 64 - MOST_BLOCKS:
        raise ValueError(f"no trees for links within {bits} bits")
    if blocks is None:
        blocks = blocks_for(nodes.count(), bits, leaf_rows)
    trees = F.array(*[F.struct(F.lit(i).alias("tree"), F.lit(signed(m)).alias("mask")) for i, m in enumerate(tree_masks(bits, blocks))])
    rows = nodes.select("node", "fp", F.explode(trees).alias("t")).select("node", "fp", "t.tree", "t.mask", F.lit(0).cast("long").alias("leaf"))
    part = F.col("fp").bitwiseAND(F.col("mask"))

    def distance(point: str) -> Column:
        return F.bit_count(F.col("fp").bitwiseXOR(F.col(point)).bitwiseAND(F.col("mask")))

    while True:
        seen = rows.groupBy("tree", "leaf").agg(
            F.count("*").alias("n"), F.min(part).alias("least"), F.max(part).alias("most"),
            F.min_by("fp", F.xxhash64(F.lit(1), "fp")).alias("one"), F.min_by("fp", F.xxhash64(F.lit(2), "fp")).alias("two"),
        )
        vantage = stored(seen.filter((F.col("n") > leaf_rows) & (F.col("least") != F.col("most"))).select("tree", "leaf", "one", "two"))
        if vantage.isEmpty():
            return rows.drop("mask")
        branch = F.xxhash64("leaf", distance("one"), distance("two"))
        rows = rows.join(vantage, ["tree", "leaf"], "left").select(
            "node", "fp", "tree", "mask", F.when(F.col("one").isNull(), F.col("leaf")).otherwise(branch).alias("leaf")
        )


def links(nodes: DataFrame, bits: int = 4, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Links (u, v), u > v, that connect all of nodes (node long, fp long, one row a fingerprint) within ``bits``."""
    if bits > RING:
        raise ValueError(f"rings find pairs within {RING} bits")
    routed = cut(leaves(nodes, bits, leaf_rows))
    # Rows that agree on a tree's bits and are still many: the tree goes on by the whole distance.
    solid = routed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).filter(F.col("n") > min(4 * leaf_rows, shard_rows))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(VANTAGE))))
    ring = F.floor(distance / RING).cast("int")
    whole = F.array(F.struct(F.lit(-1).alias("ring"), F.lit(0).alias("role")))
    home, guest = F.struct(ring.alias("ring"), F.lit(0).alias("role")), F.struct((ring - 1).alias("ring"), F.lit(1).alias("role"))
    ringed = F.when((distance % RING < bits) & (ring > 0), F.array(home, guest)).otherwise(F.array(home))
    dealt = (
        routed.join(stored(solid.select("tree", "leaf", F.lit(True).alias("solid"))), ["tree", "leaf"], "left")
        .select("node", "fp", "tree", "leaf", F.explode(F.when(F.col("solid"), ringed).otherwise(whole)).alias("p"))
        .select("node", "fp", "tree", "leaf", "p.ring", "p.role")
    )
    # A shard over the limit is compared in pairs of blocks, by as many tasks.
    shard = ["tree", "leaf", "ring"]
    large = dealt.filter("ring >= 0").groupBy(*shard).agg(F.count("*").alias("n")).filter(F.col("n") > shard_rows)
    large = large.select(*shard, F.ceil(F.col("n") * 2 / shard_rows).cast("int").alias("cuts"))
    placed = dealt.join(stored(large), shard, "left")
    own = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("cuts") - 1),
        lambda k: F.struct(
            F.least(own, k).alias("i"), F.greatest(own, k).alias("j"),
            F.when(own == k, F.col("role")).when(own < k, F.lit(2)).otherwise(F.lit(3)).alias("role"),
        ),
    )
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("role").alias("role")))
    keys = [*shard, "i", "j"]
    jobs = placed.withColumn("job", F.explode(F.when(F.col("cuts").isNull(), one).otherwise(pairs))).select(
        *shard, "job.i", "job.j", "job.role", "node", "fp"
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs_of(frames, keys):
            if len(group) > 1:
                u, v = shard_links(group["node"].to_numpy(), group["fp"].to_numpy(), group["role"].to_numpy(), bits)
                if len(u):
                    yield pd.DataFrame({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    return jobs.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "u long, v long")


def runs_of(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a sorted partition, whole ones, though a group may go over batches."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        ids = frame[keys].to_numpy()
        starts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
        if rest and (rest[-1][keys].iloc[-1].to_numpy() == ids[0]).all():
            rest.append(frame.iloc[: starts[0]] if len(starts) else frame)
            if not len(starts):
                continue
            yield pd.concat(rest)
            bounds = starts
        else:
            if rest:
                yield pd.concat(rest)
            bounds = np.concatenate([[0], starts])
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield frame.iloc[a:b]
        rest = [frame.iloc[bounds[-1] :]]
    if rest:
        yield pd.concat(rest)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each linked node with the smallest node reachable, by alternating stars.

    Every round is two aggregations by minimum and two joins; no neighbourhood is gathered in a row.
    """
    edges, before = cut(edges.distinct()), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: each larger neighbour to the least
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: each smaller neighbour, and the node itself, to the least of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small, "u")
        edges = cut(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        )
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state


def simhash_groups(docs: DataFrame, bits: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of docs (doc_id, text; more columns are ignored).

    Null, empty or blank text: fingerprint zero, which links like any other. Repeated rows give
    repeated results. A row whose doc_id is null has a fingerprint; its component is that of its
    equals with an id, else null. No rows: no rows. doc_id must be of a whole-number type (TypeError).
    """
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be a whole number: a component is named by its smallest")
    marked = cut(fingerprints(docs))
    # Exact equals meet first, so that a group of copies is one node.
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("node")).filter("node IS NOT NULL"))
    linked = components(links(nodes, bits, shard_rows))
    labels = cut(nodes.join(linked, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")))
    return marked.join(labels, "fp", "left").select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, bits: int = 4) -> DataFrame:
    """docs without near-duplicates: of each component the document with the smallest id stays.

    Of rows that repeat an id one with the smallest text stays; rows without an id all stay.
    """
    lost = stored(simhash_groups(docs, bits).filter("doc_id <> component_id").select("doc_id").distinct())
    twice = stored(docs.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1").select("doc_id"))
    once = docs.join(lost.unionByName(twice), "doc_id", "left_anti").select(named(docs))
    # Only rows whose id is repeated are put together by id, on the map side first.
    repeated = docs.join(twice, "doc_id", "left_semi").join(lost, "doc_id", "left_anti")
    least = F.min_by(F.struct(*named(docs)), F.struct("text")).alias("__row")
    return once.unionByName(repeated.groupBy("doc_id").agg(least).select("__row.*"))
