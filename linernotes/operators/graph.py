"""The property graph as four node and four edge tables, kept by keyed upserts."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from linernotes import fixed_values as fv


@dataclass(frozen=True)
class NodeSpec:
    """A gold table whose rows are nodes."""

    name: str
    table: str
    key: str
    props: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.props]


@dataclass(frozen=True)
class EdgeSpec:
    """A gold table whose rows are edges between nodes that exist."""

    name: str
    table: str
    source: tuple[str, str]  # (key column, node table)
    target: tuple[str, str]
    roles: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return [self.source[0], self.target[0]]

    @property
    def columns(self) -> list[str]:
        return self.keys + (["role"] if self.roles else [])


NODES = [
    NodeSpec("albums", "albums", "album_id",
             ("ensemble", "title", "year", "label", "styles", "cover_url")),
    NodeSpec("artists", "artists", "artist_id", ("name",)),
    NodeSpec("works", "works", "work_id", ("work_title",)),
    NodeSpec("labels", "labels", "label_id", ("name",)),
]
_ARTIST, _ALBUM = ("artist_id", "artists"), ("album_id", "albums")
EDGES = [
    EdgeSpec("leads", "album_artist", _ARTIST, _ALBUM, (fv.LEADER,)),
    EdgeSpec("plays_in", "album_artist", _ARTIST, _ALBUM, (fv.MUSICIAN, fv.LEADER)),
    EdgeSpec("contains", "album_work", _ALBUM, ("work_id", "works")),
    EdgeSpec("released_by", "album_label", _ALBUM, ("label_id", "labels")),
]


def load_map(settings: dict) -> tuple[list[NodeSpec], list[EdgeSpec]]:
    """Specs from plain settings: ``nodes`` and ``edges`` as lists of objects with the spec fields."""
    nodes = [NodeSpec(**{**n, "props": tuple(n["props"])}) for n in settings["nodes"]]
    edges = [
        EdgeSpec(**{
            **e, "source": tuple(e["source"]), "target": tuple(e["target"]),
            "roles": tuple(e.get("roles", ())),
        })
        for e in settings["edges"]
    ]
    return nodes, edges


@dataclass(frozen=True)
class Graph:
    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]
    # Entries left out for want of a table or column, with the reason.
    skipped: dict[str, str] = field(default_factory=dict)
    # Edge tables written a second time in album order, for questions that start from albums.
    by_album: dict[str, DataFrame] = field(default_factory=dict)

    def of_albums(self, name: str) -> DataFrame:
        """An edge table, in album order if it is written so."""
        return self.by_album[name] if name in self.by_album else self.edges[name]

    def __getattr__(self, name: str) -> DataFrame:
        for tables in (self.__dict__.get("nodes", {}), self.__dict__.get("edges", {})):
            if name in tables:
                return tables[name]
        raise AttributeError(name)

    def map(self, f: Callable[[str, DataFrame], DataFrame]) -> Graph:
        return Graph(
            {n: f(n, d) for n, d in self.nodes.items()},
            {n: f(n, d) for n, d in self.edges.items()},
            self.skipped,
            {n: f(n, d) for n, d in self.by_album.items()},
        )


def upsert_nodes(
    incoming: DataFrame, key: str, props: tuple[str, ...], existing: DataFrame | None = None, in_ranges: bool = False
) -> DataFrame:
    """Existing nodes plus incoming ones; an incoming row replaces the given properties, nulls too.

    Other properties of an existing node stay. Incoming rows that share a key collapse to the one
    with the smallest properties. With ``in_ranges`` rows meet by ranges of the key, as they are written.
    """
    rows = incoming.select(key, *props, F.lit(0).alias("_age"))
    others: list[str] = []
    if existing is not None:
        others = [c for c in existing.columns if c not in (key, *props)]
        rows = rows.unionByName(existing.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    columns = [F.min_by(F.struct(*props), F.struct("_age", *props)).alias("_row")] if props else []
    if others:
        columns.append(F.max(F.when(F.col("_age") == 1, F.struct(*others))).alias("_kept"))
    rows = rows.where(F.col(key).isNotNull())
    rows = rows.repartitionByRange(key) if in_ranges else rows
    if not columns:
        return rows.select(key).distinct()
    merged = rows.groupBy(key).agg(*columns)
    return merged.select(key, *(["_row.*"] if props else []), *(["_kept.*"] if others else []))


def upsert_edges(
    links: DataFrame,
    spec: EdgeSpec,
    nodes: dict[str, DataFrame],
    existing: DataFrame | None = None,
    present: Collection[str] = (),
    distinct: bool = True,
) -> DataFrame:
    """Existing edges plus the links in role whose two ends exist, without repeats.

    Link tables hold hardly any repeats, so one distinct at the end does; the semi-joins before it
    can be split when one artist or album has very many links. Keys whose ends are known to be ``present``
    are not joined; without ``distinct`` repeats are left to the writer.
    """
    edges = links.where(F.col("role").isin(*spec.roles)) if spec.roles else links
    for key, table in (spec.source, spec.target):
        if key in present:
            edges = edges.where(F.col(key).isNotNull())
        else:
            edges = edges.join(nodes[table].select(key), key, "left_semi")
    edges = edges.select(*spec.keys)
    if existing is not None:
        edges = existing.select(*spec.keys).unionByName(edges)
    return edges.distinct() if distinct else edges


#: Nodes above this number are not sent to the driver and all executors for a join. Spark goes by the size of
#: files, of which sorted ids in sequence take hardly anything, while each takes some 38 bytes in a broadcast.
FEW_NODES = 500_000


def all_present(links: DataFrame, key: str, nodes: DataFrame) -> bool:
    """Whether every link's end exists, links without one aside. Each task sends its different keys, not its links.

    Keys meet by a shuffle, as the different ones of the links lie by key already: nodes of any number stay
    off the driver. Spark would move an anti-join in front of the distinct, so it is an outer one.
    """
    ends = links.select(key).where(F.col(key).isNotNull()).distinct()
    there = nodes.select(key, F.lit(True).alias("_there")).hint("merge")
    return ends.join(there, key, "left").where(F.col("_there").isNull()).isEmpty()


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def rows_or_skip(df: DataFrame | None, columns: list[str]) -> tuple[DataFrame | None, str]:
    """The needed columns, or None and the reason for leaving the entry out."""
    if df is None:
        return None, "no such table"
    missing = missing_columns(df, columns)
    if missing:
        return None, f"missing columns {missing}"
    rows = df.select(*columns)
    return (None, "no rows") if rows.isEmpty() else (rows, "")


def load(
    gold: dict[str, DataFrame],
    existing: Graph | None = None,
    nodes: list[NodeSpec] = NODES,
    edges: list[EdgeSpec] = EDGES,
    to_write: bool = False,
) -> Graph:
    """Apply gold tables to a graph: all nodes first, then the edges between them.

    What is loaded is declared by the specs; a new entry needs no code. Several entries may feed
    one node or edge name: each adds to what the ones before it left.

    Of a graph ``to_write`` nodes come in ranges of their key. The ends of a link table (gold and nodes are written
    then) are looked up first, and its links are joined with nodes only where an end is missing; ``write_graph``
    takes out repeats. The same is done for ends of more than ``FEW_NODES`` nodes, which are never broadcast.
    """
    skipped: dict[str, str] = {}
    sources = {n: [df] for n, df in existing.nodes.items()} if existing else {}
    large: dict[str, bool] = {}
    found: dict[tuple[str, str, str], bool] = {}

    def many(table: str) -> bool:
        if table not in large:  # the rows that nodes are made from are in files, so counted without reading these
            large[table] = sum(df.count() for df in sources[table]) > FEW_NODES
        return large[table]

    def present(spec: EdgeSpec) -> list[str]:
        looked_up = [end for end in (spec.source, spec.target) if to_write or many(end[1])]
        for key, table in looked_up:
            if (spec.table, key, table) not in found:
                found[spec.table, key, table] = all_present(gold[spec.table], key, new_nodes[table])
        return [key for key, table in looked_up if found[spec.table, key, table]]

    new_nodes = dict(existing.nodes) if existing else {}
    new_edges = dict(existing.edges) if existing else {}
    for spec in nodes:
        rows, why = rows_or_skip(gold.get(spec.table), spec.columns)
        if rows is None:
            skipped[spec.name] = why
            continue
        new_nodes[spec.name] = upsert_nodes(rows, spec.key, spec.props, new_nodes.get(spec.name), to_write)
        sources.setdefault(spec.name, []).append(rows)
    for spec in edges:
        rows, why = rows_or_skip(gold.get(spec.table), spec.columns)
        if rows is not None and any(t not in new_nodes for _, t in (spec.source, spec.target)):
            rows, why = None, "no node table for an end"
        if rows is None:
            skipped[spec.name] = why
            continue
        known = present(spec)
        ends = {t: new_nodes[t] for key, t in (spec.source, spec.target) if key not in known}
        ends = {t: df.hint("merge") if many(t) else df for t, df in ends.items()}
        new_edges[spec.name] = upsert_edges(rows, spec, ends, new_edges.get(spec.name), known, not to_write)
    return Graph(new_nodes, new_edges, skipped)


def key_violations(nodes: dict[str, DataFrame], specs: list[NodeSpec] = NODES) -> DataFrame:
    """Node keys that are null or occur more than once; empty when all keys are unique."""

    def repeated(spec: NodeSpec) -> DataFrame:
        key: Column = F.col(spec.key).cast("string").alias("key")
        n = F.count(F.lit(1)).alias("rows")
        counts = nodes[spec.name].groupBy(key).agg(n)
        bad = counts.where((F.col("rows") > 1) | F.col("key").isNull())
        return bad.select(F.lit(spec.name).alias("node"), "key", "rows")

    return reduce(DataFrame.unionByName, [repeated(s) for s in specs if s.name in nodes])
