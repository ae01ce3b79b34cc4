"""A Merkle manifest of a dataset: cogrouped subtree exchange.

Each row is a leaf. The leaves of a source, in the order of their ids, form a tree of sixteen children a
node; the roots of the sources, in the order of their names, form another one. A superblock is 4096 nodes
that follow one another in one tree: three levels. Upwards, each superblock is reduced to its root by a
task of its own, and the roots are the next, 4096 times smaller table, until a tree is one node.
Downwards, each table's superblocks are cogrouped with what the table above knows about them: the nodes
outside that their proofs need, level by level. The task finishes the three levels inside, joins both
parts of each proof and, at the leaves, folds it. No task sees more than a superblock and one path.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linernotes.llm.common import LOWER, UPPER, cut, stored

#: Children of a node; levels of a superblock, which a task holds at once.
ARITY, LEVELS = 16, 3
#: Hex digits of a digest.
HEX = 64
#: Leaves whose crc32 of the id is divisible by this are tampered with.
TAMPERED = 5


def field(column: str) -> Column:
    """A value with its length in UTF-8 bytes before it, or a dash: no two rows give the same text."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_of(text: Column | None = None) -> Column:
    fields = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    whole = field("text") if text is None else F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.sha2(F.concat(*fields, whole), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed): changed is the tampered leaf, null where nothing is tampered with.

    A tree is named by its source, null before all others.
    """
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        "doc_id",
        leaf_of().alias("leaf"),
        F.when(tampered & F.col("text").isNotNull(), leaf_of(lowered)).alias("changed"),
    )


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """rows with pos (from 0) in their tree and total, the tree's rows.

    Ranges of (tree, order) are sorted each by a task; a row's position is its place in its range, and
    the rows of its tree in the ranges before. Rows alike in all of ``order`` are told apart by the
    partition they came from, so that they spread too.
    """
    keys = ["tree", *order, "from_part"]
    ordered = cut(rows.withColumn("from_part", F.spark_partition_id()).repartitionByRange(*keys).sortWithinPartitions(*keys))
    at = ordered.drop("from_part").withColumn("at", F.monotonically_increasing_id())  # part and place of the written rows
    at = at.withColumn("part", F.shiftright("at", 33))
    of_tree = Window.partitionBy("tree")
    parts = at.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    parts = stored(parts.select(
        "tree", "part", "first",
        (F.sum("n").over(of_tree.orderBy("part")) - F.col("n")).alias("before"),
        F.sum("n").over(of_tree).alias("total"),
    ))
    placed = at.join(parts, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first"))
    return placed.drop("at", "part", "first", "before")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(total: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def reduced(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of a superblock, level by level."""
    rows = [digests]
    for _ in range(levels):
        rows.append([digest("".join(rows[-1][i : i + ARITY])) for i in range(0, len(rows[-1]), ARITY)])
    return rows


def inner_paths(rows: list[list[str]]) -> list[tuple[list[int], list[str]]]:
    """For each node of the lowest level: its place among its run's nodes, and the others joined, by level."""
    above = []
    for row in rows[:-1]:
        runs = ["".join(row[i : i + ARITY]) for i in range(0, len(row), ARITY)]
        above.append([(j % ARITY, (run := runs[j // ARITY])[: j % ARITY * HEX] + run[(j % ARITY + 1) * HEX :]) for j in range(len(row))])
    paths = []
    for j in range(len(rows[0])):
        steps = [level[j // ARITY**k] for k, level in enumerate(above)]
        paths.append(([s[0] for s in steps], [s[1] for s in steps]))
    return paths


def folded(node: str, places: list[int], siblings: list[str]) -> str:
    for place, others in zip(places, siblings):
        node = digest(others[: place * HEX] + node + others[place * HEX :])
    return node


def block(levels: int) -> Column:
    return F.floor(F.col("pos") / ARITY**levels).alias("block")


def tables_of(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """(tree, pos, total, digest) of the nodes given, then of superblocks, to one node a tree; all written."""

    def block_root(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pos")
        total = int(own["total"].iloc[0])
        rows = reduced(list(own["digest"]), min(levels, height(total)))
        size = ARITY**levels
        return pd.DataFrame({"tree": [own["tree"].iloc[0]], "pos": [own["pos"].iloc[0] // size], "total": [-(-total // size)], "digest": rows[-1]})

    tables = [nodes]
    while len(tables) == 1 or (tables[-1].agg(F.max("total")).first()[0] or 1) > 1:
        narrow = tables[-1].select("tree", "pos", "total", "digest")
        roots = narrow.groupBy("tree", block(levels)).applyInPandas(block_root, "tree string, pos long, total long, digest string")
        tables.append(stored(roots))
    return tables


PATH = "places array<int>, siblings array<string>"


def exchanged(nodes: DataFrame, outer: DataFrame, extra: str, finish, levels: int) -> DataFrame:
    """nodes cogrouped by superblock with outer, one row a superblock: (tree, pos, places, siblings, ...).

    ``finish(nodes, outer row, paths)`` makes a frame of the columns ``extra`` from a superblock's nodes,
    in order, and their whole paths.
    """

    def inside(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pos").reset_index(drop=True)
        up = above.iloc[0]
        rows = reduced(list(own["digest"]), min(levels, height(int(own["total"].iloc[0]))))
        return finish(own, up, inner_paths(rows))

    return nodes.groupBy("tree", block(levels)).cogroup(outer.groupBy("tree", "pos")).applyInPandas(inside, extra)


def with_paths(own: pd.DataFrame, up: pd.Series, paths: list) -> pd.DataFrame:
    kept = {c: up[c] for c in ("subroot",) if c in up}
    return own[["tree", "pos", "digest"]].assign(
        places=[[*p, *up["places"]] for p, _ in paths], siblings=[[*s, *up["siblings"]] for _, s in paths], **kept
    )


def paths_below(tables: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """One row a superblock of tables[0]: its outer path, from the path above each tree's root in ``top``."""
    outer = top
    for nodes in reversed(tables[1:-1]):
        outer = stored(exchanged(nodes, outer, f"tree string, pos long, digest string, {PATH}, subroot string", with_paths, levels))
    return outer


def no_path(*columns: Column) -> list[Column]:
    return [*columns, F.expr("cast(array() as array<int>)").alias("places"), F.expr("cast(array() as array<string>)").alias("siblings")]


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of docs.

    proof_sha256 is the digest of the other nodes of each run on the way from the leaf to the root, left to
    right; folded_root is the root that follows from them and the leaf, tampered with or not.
    Nulls are leaves like others: a null id comes first in its source, a null source is the first tree.
    Rows with one id are ordered by their leaf; repeated rows are a leaf each. Empty and very long texts
    are hashed whole. A row without a tampered text verifies. No rows: no rows. Other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType
    own = ranked(stored(leaves(docs)), "doc_id", "leaf").withColumnRenamed("leaf", "digest")
    # Ids travel as text: pandas would make floats of integers with nulls.
    own = cut(own.withColumn("doc_id", F.col("doc_id").cast("string")))
    trees = tables_of(own, levels)

    # The tree over the sources: its leaves are the sources' roots.
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    above = tables_of(cut(ranked(subroots, "name")), levels)
    last = above[-1].select("tree", "pos", "digest", F.lit(None).cast("string").alias("subroot"))
    outer = paths_below(above, last.select(*no_path("tree", "pos", "subroot")), levels)

    def for_source(own: pd.DataFrame, up: pd.Series, paths: list) -> pd.DataFrame:
        found = with_paths(own.assign(tree=own["name"]), up, paths)
        return found.assign(pos=0, subroot=found["digest"])

    top = stored(exchanged(above[0], outer, f"tree string, pos long, digest string, {PATH}, subroot string", for_source, levels))
    outer = paths_below(trees, top, levels)
    first = above[-1].first()  # one row, or none
    root = first["digest"] if first else None

    def for_leaves(own: pd.DataFrame, up: pd.Series, paths: list) -> pd.DataFrame:
        rest = "".join(up["siblings"])
        proofs = [digest("".join(s) + rest) for _, s in paths]
        starts = [c or d for c, d in zip(own["changed"], own["digest"])]
        ends = [folded(folded(x, *p), up["places"], up["siblings"]) for x, p in zip(starts, paths)]
        return pd.DataFrame({
            "doc_id": own["doc_id"], "leaf": own["digest"], "subroot": up["subroot"], "root": root,
            "proof_sha256": proofs, "folded_root": ends, "verified": [x == root for x in ends],
        })

    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return exchanged(trees[0], outer, schema, for_leaves, levels).withColumn("doc_id", F.col("doc_id").cast(kind))
