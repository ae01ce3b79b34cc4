"""Shards that each hold the mixture of sources: proportional stratified interleaving.

Rows are ranked in a seeded order within their source. A row's fractional rank, (rank - 1/2) / rows of
the source, spreads each source evenly over 0 to 1; sorted by it, any cut of the whole holds each source
in proportion. Ranks of a source, and of the whole, are counted in 4096 buckets of the sort key: counts
of the buckets before, plus the place in the own bucket. So no source, however large, is one task's.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from linernotes.llm.common import named

SHARDS, SEED = 40, 23
#: Buckets of either ranking: three hex digits of the seeded key, or so many equal parts of 0 to 1.
BUCKET_DIGITS, BUCKETS = 3, 4096


def placed(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, text_key, source, size, text_crc32, shard, slot) of each row; the text itself isn't shuffled.

    Rows of one source that agree in id and text are interchangeable.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce(text, F.lit("")))))).alias("key"),
        F.xxhash64(text).alias("text_key"),
    ).withColumn("bucket", F.conv(F.substring("key", 1, BUCKET_DIGITS), 16, 10).cast("int"))

    by_bucket = Window.partitionBy("source").orderBy("bucket")
    counts = rows.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    offsets = counts.select(
        "source", "bucket",
        (F.sum("n").over(by_bucket) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("source")).alias("in_source"),
    )
    in_bucket = Window.partitionBy("source", "bucket").orderBy("key", "text_crc32", "size")
    ranked = rows.join(offsets, ["source", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(in_bucket))
    fraction = ranked.withColumn("fraction", (F.col("rank") - 0.5) / F.col("in_source"))
    fraction = fraction.withColumn("part", F.floor(F.col("fraction") * BUCKETS).cast("int"))

    # At most 4096 rows, each a sum.
    parts = fraction.groupBy("part").agg(F.count("*").alias("n"))
    upto = Window.orderBy("part")
    parts = parts.select(
        "part", (F.sum("n").over(upto) - F.col("n")).alias("earlier"), F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total")
    )
    in_part = Window.partitionBy("part").orderBy("fraction", "source", "rank")
    position = F.col("earlier") + F.row_number().over(in_part) - 1
    # In whole numbers: shard k starts at the ceiling of k * total / shards.
    whole = F.expr(f"(position * {shards}) div total")
    start = F.expr(f"(((position * {shards}) div total) * total + {shards - 1}) div {shards}")
    return (
        fraction.join(parts, "part").withColumn("position", position)
        .select("doc_id", "text_key", "source", "size", "text_crc32", whole.cast("int").alias("shard"), (F.col("position") - start).alias("slot"))
    )


def shard_table(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, text_crc32, law, shard, slot, grown_shard) of each row of docs.

    The law is ``rows``: shards' row counts are at most one apart. Null text counts as empty, null
    sources are one source, rows without an id are placed by their text, repeated rows each get a slot.
    No rows: no rows. Other columns are ignored.
    """
    return placed(docs, shards, seed).select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """docs with shard and slot, in place of columns of these names. The text is shuffled once.

    Rows alike in id and text get their places in turn, by a hash of all their columns, so that a repeated
    task gives the same. Nulls, repeated rows and empty tables as in ``shard_table``.
    """
    keys = ["__id", "__text"]
    id_key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    places = (
        placed(docs, shards, seed).groupBy(id_key.alias("__id"), F.col("text_key").alias("__text"))
        .agg(F.sort_array(F.collect_list(F.struct("shard", "slot"))).alias("__places"))
    )
    keyed = docs.withColumn("__id", id_key).withColumn("__text", F.xxhash64(F.col("text").cast("string")))
    hashed = [c for c, f in zip(named(docs), docs.schema) if not re.search("map<|variant", f.dataType.simpleString())]
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*hashed)))
    joined = keyed.join(places, keys).withColumn("__place", F.element_at("__places", turn))
    return joined.select(*named(docs, "shard", "slot"), F.col("__place.shard").alias("shard"), F.col("__place.slot").alias("slot"))
