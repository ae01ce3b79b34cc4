"""From landed JSON to queryable graph tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from linernotes.config import BronzeConfig, GoldConfig
from linernotes.operators import gold as g
from linernotes.operators.graph import EDGES, NODES, EdgeSpec, Graph, NodeSpec, load
from linernotes.operators.report import row_counts
from linernotes.sources.tables import PACKED, open_tables, read_bronze, write_gold, write_sorted
from linernotes.streaming.bronze import run_bronze
from linernotes.streaming.quarantine import raise_for_unreadable, read_quarantine

# Each graph table is written in the order of the key it is looked up by. The second key lets the
# rows of an artist, work or label with very many edges spread over several files and tasks.
SORT_KEYS = {
    **{n.name: (n.key,) for n in NODES},
    "leads": ("artist_id", "album_id"),
    "plays_in": ("artist_id", "album_id"),
    "contains": ("work_id", "album_id"),
    "released_by": ("album_id", "label_id"),
}
# Edges that are looked up by album as well are written a second time in that order.
ALBUM_ORDER = {
    "leads": ("album_id", "artist_id"),
    "plays_in": ("album_id", "artist_id"),
    "contains": ("album_id", "work_id"),
}

# Links are written with equal ids side by side: files, and the shuffles that read them, pack such runs well.
TOGETHER = {"album_artist": ("artist_id",), "album_work": ("work_id", "album_id")}

# Independent writes that run at a time, so that the last tasks of one leave no cores idle.
WRITES_AT_A_TIME = 4


def write_gold_tables(
    spark: SparkSession, tables: dict[str, DataFrame], cfg: GoldConfig
) -> list[str]:
    """Overwrite the given gold tables; returns their catalog names."""
    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        return list(pool.map(lambda t: write_gold(spark, t[1], t[0], cfg), tables.items()))


def read_gold_tables(spark: SparkSession, cfg: GoldConfig) -> dict[str, DataFrame]:
    return open_tables(spark, cfg.path, list(g.TABLES), cfg.format)


def write_gold_from(
    spark: SparkSession, bronze: DataFrame, cfg: GoldConfig, only: Callable | None = None,
    names: list[str] | None = None,
) -> list[str]:
    """All gold tables, or those named, from bronze rows.

    Tracks and the links of albums and works are made from one written table of an album's titles, whose
    rows are theirs; works and artists from counts of their spellings. ``only`` may narrow bronze to given columns.
    """
    names = [n for n in g.TABLES if names is None or n in names]
    columns = only or (lambda *names: bronze.select(*[n for n in names if n in bronze.columns]))
    tables = {n: g.TABLES[n](columns(*g.INPUT[n])) for n in names if n not in g.FROM_TRACK_TABLE}
    tables = {n: df.sortWithinPartitions(*TOGETHER[n]) if n in TOGETHER else df for n, df in tables.items()}
    with ThreadPoolExecutor(1) as pool:
        others = pool.submit(write_gold_tables, spark, tables, cfg)
        from_titles = [n for n in names if n in g.FROM_TRACK_TABLE]
        if len(from_titles) > 1:
            path = f"{cfg.path.rstrip('/')}/_inputs/tracks"
            g.track_table(columns(*g.INPUT["tracks"])).write.mode("overwrite").options(**PACKED).parquet(path)
            tables = {n: g.FROM_TRACK_TABLE[n](spark.read.parquet(path)) for n in from_titles}
        else:
            tables = {n: g.TABLES[n](columns(*g.INPUT[n])) for n in from_titles}
        tables = {n: df.sortWithinPartitions(*TOGETHER[n]) if n in TOGETHER else df for n, df in tables.items()}
        return [*others.result(), *write_gold_tables(spark, tables, cfg)]


def write_album_order(edges: DataFrame, name: str, folder: str, distinct: bool = False) -> None:
    write_sorted(edges, f"{folder}/{name}_by_album", *ALBUM_ORDER[name], distinct=distinct)


def write_graph(graph: Graph, folder: str, album_order: list[str] | None = None, nodes_in_ranges: bool = False) -> None:
    """Write a graph to a folder of its own; an upsert reads one version and writes the next.

    ``album_order`` names the edges to write in that order as well, of those that can be; all by default.
    ``nodes_in_ranges`` says that the nodes are those of a load ``to_write``.
    """

    def put(name: str, df: DataFrame) -> None:
        keys = SORT_KEYS.get(name, df.columns)
        is_edge = name in graph.edges
        write_sorted(
            df, f"{folder}/{name}", *keys, distinct=is_edge and set(keys) == set(df.columns),
            in_ranges=nodes_in_ranges and not is_edge and len(keys) == 1,
        )
        asked = album_order is None or name in album_order
        if asked and name in graph.edges and set(ALBUM_ORDER.get(name, [""])) <= set(df.columns):
            # From the written rows: the edges are made once for both orders.
            write_album_order(df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}"), name, folder)

    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        list(pool.map(lambda t: put(*t), {**graph.nodes, **graph.edges}.items()))


def read_graph(
    spark: SparkSession,
    folder: str,
    nodes: list[NodeSpec] = NODES,
    edges: list[EdgeSpec] = EDGES,
) -> Graph:
    """A written graph: the tables that the specs of its load map name."""
    found = open_tables(spark, folder, list(dict.fromkeys(e.name for e in edges)))
    copies = open_tables(spark, folder, [f"{n}_by_album" for n in found if n in ALBUM_ORDER])
    return Graph(
        open_tables(spark, folder, list(dict.fromkeys(n.name for n in nodes))),
        found,
        by_album={n.removesuffix("_by_album"): df for n, df in copies.items()},
    )


def load_in_steps(
    spark: SparkSession,
    gold: dict[str, DataFrame],
    folder: str,
    existing: Graph | None = None,
    nodes: list[NodeSpec] = NODES,
    edges: list[EdgeSpec] = EDGES,
) -> Graph:
    """Like ``load``, written to a folder: nodes first, so that edges check the written nodes."""
    first = existing is None
    with_nodes = load(gold, existing, nodes, edges=[], to_write=first)
    write_graph(Graph(with_nodes.nodes, {}), folder, nodes_in_ranges=first)
    known = read_graph(spark, folder, nodes, []).nodes
    # Nodes of an earlier version that this map does not name are written too.
    known |= open_tables(spark, folder, [n for n in with_nodes.nodes if n not in known])
    with_edges = load(gold, Graph(known, existing.edges if existing else {}), nodes=[], edges=edges, to_write=True)
    write_graph(Graph({}, with_edges.edges), folder)
    written = read_graph(spark, folder, nodes, edges)
    return Graph(
        {**known, **written.nodes},
        {**open_tables(spark, folder, list(with_edges.edges)), **written.edges},
        {**with_nodes.skipped, **with_edges.skipped},
        written.by_album,
    )


def refresh(
    spark: SparkSession,
    bronze: BronzeConfig,
    gold: GoldConfig,
    graph_folder: str,
    existing: Graph | None = None,
    nodes: list[NodeSpec] = NODES,
    edges: list[EdgeSpec] = EDGES,
) -> tuple[Graph, DataFrame]:
    """Ingest new files, rebuild gold, write the next graph version. Returns it and row counts.

    What gold leaves out is counted as ``quarantine``; the graph names what it skipped. A file without a
    readable record stops the refresh that ingests it, unless the settings allow it; the next one goes on.
    """
    batches: list[tuple[str, int]] = []
    run_bronze(spark, bronze, batches)
    raise_for_unreadable(spark, bronze, batches)
    rows = read_bronze(spark, bronze)
    write_gold_from(spark, g.split_corrupt(rows)[0], gold)
    tables = read_gold_tables(spark, gold)
    graph = load_in_steps(spark, tables, graph_folder, existing, nodes, edges)
    return graph, row_counts({"bronze": rows, "quarantine": read_quarantine(spark, bronze), **tables})
