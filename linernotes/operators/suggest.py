"""Name suggestions for a search text, by a scan of the names or by an index of their runs of characters.

The index holds a node once for each different run of one to three characters of its lower-cased name, in
the order of the runs. Whoever looks for a text reads the rows of that run of the text which fewest names
hold, and compares these names in full: the answer is that of the scan, for texts of any length and any
characters. Rows of a frequent run spread over several files, as names are the second key of the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linernotes.functions.text import contains_text, prefix_rank
from linernotes.operators.graph import Graph
from linernotes.sources.tables import write_sorted

#: The longest run of characters in the index.
RUN = 3


def suggestions(
    nodes: DataFrame, key: str, name: str, q: str, limit: int | None = None
) -> DataFrame:
    """(id, name) of nodes whose name holds the text: names beginning with it first, then A-Z.

    Equal names follow their id, so that a limit is repeatable.
    """
    low = F.lower(F.col("name"))
    hits = nodes.select(F.col(key).alias("id"), F.col(name).alias("name")).where(
        contains_text(F.col("name"), q)
    )
    # A constant rank would be read as a column number.
    rank = [prefix_rank(F.col("name"), q)] if q else []
    hits = hits.orderBy(*rank, low.asc_nulls_last(), "id")
    return hits if limit is None else hits.limit(limit)


def search_index(nodes: DataFrame, key: str, name: str) -> DataFrame:
    """(gram, id, name) for each different run of up to three characters; null and empty names have none."""
    low = F.lower(name)

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(low) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substring(low, i, n))

    grams = F.array_distinct(F.concat(*[runs(n) for n in range(1, RUN + 1)]))
    rows = nodes.where(F.length(name) > 0).select(
        F.explode(grams).alias("gram"), F.col(key).alias("id"), F.col(name).alias("name")
    )
    return rows.where(F.length("gram") > 0)


def write_index(nodes: DataFrame, key: str, name: str, folder: str) -> None:
    """Write the index of a node table, and how many names hold each run."""
    index = search_index(nodes, key, name)
    write_sorted(index, f"{folder}/names", "gram", "name", "id")
    written = nodes.sparkSession.read.schema(index.schema).parquet(f"{folder}/names")
    write_sorted(written.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), f"{folder}/counts", "gram")


def index_rows(nodes: DataFrame, key: str, name: str, folder: str, q: str) -> DataFrame:
    """(id, name) of the index rows that have to be compared for a text of one character or more."""
    spark = nodes.sparkSession
    # Lower case as the names' is, which is not in all languages as Python's.
    low = spark.range(1).select(F.lower(F.lit(q))).first()[0]
    n = min(RUN, len(low))
    grams = sorted({low[i:i + n] for i in range(len(low) - n + 1)})
    counts = spark.read.schema("gram STRING, n LONG").parquet(f"{folder}/counts")
    found = counts.where(F.col("gram").isin(grams)).collect()  # at most a row a character of the text
    schema = nodes.select(F.lit("").alias("gram"), F.col(key).alias("id"), F.col(name).alias("name")).schema
    rows = spark.read.schema(schema).parquet(f"{folder}/names")
    # A run that no name holds means no name holds the text.
    rarest = min(found, key=lambda r: (r["n"], r["gram"]))["gram"] if len(found) == len(grams) else None
    rows = rows.where(F.lit(False)) if rarest is None else rows.where(F.col("gram") == rarest)
    return rows.select("id", "name")


def indexed_suggestions(
    nodes: DataFrame, key: str, name: str, folder: str, q: str, limit: int | None = None
) -> DataFrame:
    """The answer of ``suggestions``, read from an index written for the same nodes."""
    if not q:
        return suggestions(nodes, key, name, q, limit)
    return suggestions(index_rows(nodes, key, name, folder, q), "id", "name", q, limit)


def suggest_artists(graph: Graph, q: str = "", limit: int | None = None) -> DataFrame:
    return suggestions(graph.artists, "artist_id", "name", q, limit)


def suggest_works(graph: Graph, q: str = "", limit: int | None = None) -> DataFrame:
    return suggestions(graph.works, "work_id", "work_title", q, limit)


def suggest_albums(graph: Graph, q: str = "", limit: int | None = None) -> DataFrame:
    return suggestions(graph.albums, "album_id", "title", q, limit)
