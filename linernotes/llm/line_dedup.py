"""Lines that many documents share, removed from all but one of them.

Lines are exploded with a 128-bit hash of their normalised form; distinct documents are counted per
hash; hashes over the threshold are joined back to the lines' positions; documents are put together
again from the lines that stay.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linernotes.llm.common import LOWER, UPPER, cut

#: Stripped from both ends of a line for its key.
BLANKS = " \t\n\x0b\x0c\r"


def keyed_lines(text: Column) -> Column:
    """The keys of all lines of a text; splitting and lower-casing A-Z don't change positions."""
    return F.transform(F.split(F.translate(text, UPPER, LOWER), "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)))


def lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_key, pos, h1, h2) of each line long enough to count; rows without an id have none."""
    keys = docs.filter("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(keyed_lines(F.col("text"))).alias("pos", "key")
    )
    hashes = [F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")]
    return keys.filter(F.length("key") >= min_chars).select("doc_id", "text_key", "pos", *hashes)


def common_lines(found: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, keeper): keys of at least min_docs documents, and the largest id among these."""
    once = found.select("h1", "h2", "doc_id").distinct()
    counted = once.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
    return counted.filter(F.col("n_docs") >= min_docs).drop("n_docs")


def rebuilt(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    """Line counts and the text of the lines that stay."""
    rows = []
    for text, gone in zip(texts, drops):
        own = ("" if text is None else text).split("\n")
        if gone is None or not len(gone):
            rows.append((len(own), 0, text or ""))
        else:
            lost = set(gone)
            rows.append((len(own), len(lost), "\n".join([x for i, x in enumerate(own) if i not in lost])))
    return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])


def digested(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    out = rebuilt(texts, drops)
    return out.assign(kept=[hashlib.sha256(t.encode()).hexdigest() for t in out["kept"]])


def dropped_positions(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, text_key, drops): positions of the lines that go. A line held by a third of all documents

    has one row in the table of common lines; the joins' large side is split by adaptive execution.
    """
    common = cut(common_lines(lines(docs, min_chars), min_docs))
    # Written, so that both sides of the join are plain exchanges, whose hot keys Spark can split.
    gone = lines(docs, min_chars).join(common, ["h1", "h2"]).filter("doc_id <> keeper")
    return gone.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("drops"))


def with_lines_dropped(docs: DataFrame, digest: bool = False, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs' rows as (doc_id, n_lines, n_dropped, kept): kept is the text of the lines that stay, or its SHA-256.

    A null or empty text is one empty line, kept as empty text. Rows that repeat an id count as one
    document; its lines go from each of its rows. Rows without an id count for nothing and lose nothing.
    No rows: no rows. Other columns are ignored.
    """
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    drops = dropped_positions(narrow, min_chars, min_docs)
    joined = narrow.withColumn("text_key", F.xxhash64("text")).join(drops, ["doc_id", "text_key"], "left")
    out = F.pandas_udf(digested if digest else rebuilt, "n_lines long, n_dropped long, kept string")
    return joined.select("doc_id", out("text", "drops").alias("r")).select("doc_id", "r.*")
