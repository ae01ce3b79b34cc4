"""Mixing sources to target weights: temperature on token shares, block permutations within a budget.

Source shares are raised to an exponent and normalised. The exponent, from 1 (shares as they are) down
to 0 (all sources alike), is bisected to the largest whose weights have the target entropy; if a source
would then be repeated more often than allowed, to the smallest that keeps the limit. A source's
documents are dealt by hash to blocks; each of its epochs goes through the blocks in order, each block
through its documents by hash, until the source's part of the budget is used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from linernotes.llm.common import WORD, cut, named

#: Blocks of a source's permutation: three hex digits of its key. Fixed, so that a block is one of so many parts of a source of any size.
BLOCK_DIGITS = 3


@dataclass(frozen=True)
class Mixture:
    """entropy: target, as a share of the greatest possible. repeats: most epochs of a source.

    budget: tokens to schedule; None: as many as let every source's first epoch be whole, so that
    mixing repeats small sources and drops no document. max_sources bounds what the driver weighs.
    """

    entropy: float = 0.97
    repeats: float = 2.0
    budget: int | None = None
    seed: int = 11
    max_sources: int = 100_000


def weights(tokens: list[int], exponent: float) -> list[float]:
    """Normalised powers of the sources' shares."""
    total = math.fsum(tokens)
    powers = [(t / total) ** exponent for t in tokens]
    whole = math.fsum(powers)
    return [p / whole for p in powers]


def entropy(shares: list[float]) -> float:
    return -math.fsum(s * math.log(s) for s in shares if s > 0)


def budget_of(tokens: list[int], shares: list[float], budget: int | None) -> float:
    return float(budget) if budget is not None else max(t / s for t, s in zip(tokens, shares))


def exponent_for(tokens: list[int], mixture: Mixture) -> float:
    """Bisected to 1e-12. Entropy falls and repetition falls as the exponent grows."""

    def bisect(holds) -> float:
        """The largest exponent for which ``holds``, which is true at 0."""
        low, high = 0.0, 1.0
        if holds(high):
            return high
        while high - low > 1e-12:
            middle = (low + high) / 2
            low, high = (middle, high) if holds(middle) else (low, middle)
        return low

    def most_repeats(exponent: float) -> float:
        shares = weights(tokens, exponent)
        total = budget_of(tokens, shares, mixture.budget)
        return max(s * total / t for s, t in zip(shares, tokens))

    if len(tokens) < 2:
        return 1.0
    goal = mixture.entropy * math.log(len(tokens))
    exponent = bisect(lambda a: entropy(weights(tokens, a)) >= goal)
    if most_repeats(exponent) > mixture.repeats:
        # The smallest exponent within the limit; 1 if even plain shares exceed it.
        exponent = 1.0 if most_repeats(1.0) > mixture.repeats else 1 - bisect(lambda a: most_repeats(1 - a) <= mixture.repeats)
    return exponent


def n_tokens(text: Column | str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_name(source: Column | str = "source") -> Column:
    """Rows without a source are one source, the empty name."""
    return F.coalesce(F.col(source).cast("string") if isinstance(source, str) else source, F.lit(""))


def quota_of(share: float, total: float, own: int, budget: int | None) -> int:
    """Tokens that a source gives; without a budget its first epoch is whole, whatever rounding makes of large counts."""
    quota = math.floor(share * total + 1e-6)
    return quota if budget is not None else max(quota, own)


def order_key(seed: int, epoch: Column, doc_id: Column, text: Column) -> Column:
    """A document's place in an epoch of its source: hex digits, of which the first name the block."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(text))), ))


def source_plan(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """(source, tokens, weight, whole_epochs, cut_key), a row a source.

    A document is scheduled in the first whole_epochs epochs, and in the next if its key there is at
    most cut_key. Sources without tokens get weight 0 and one epoch.
    """
    spark = docs.sparkSession
    rows = cut(docs.select(
        source_name().alias("source"), "doc_id", n_tokens().alias("tokens"), F.when(F.col("doc_id").isNull(), F.col("text")).alias("text")
    ))
    sizes = rows.groupBy("source").agg(F.sum("tokens").alias("tokens")).orderBy("source").limit(mixture.max_sources + 1).collect()
    if len(sizes) > mixture.max_sources:
        raise ValueError(f"more than {mixture.max_sources} sources")
    full = [(r["source"], r["tokens"]) for r in sizes if r["tokens"]]
    planned = [(r["source"], 0, 0.0, 1, 0) for r in sizes if not r["tokens"]]
    if full:
        tokens = [t for _, t in full]
        shares = weights(tokens, exponent_for(tokens, mixture))
        total = budget_of(tokens, shares, mixture.budget)
        for (name, own), share in zip(full, shares):
            quota = quota_of(share, total, own, mixture.budget)
            planned.append((name, own, share, quota // own, quota % own))
    plan = spark.createDataFrame(planned, "source string, tokens long, weight double, whole_epochs long, rest long")

    keyed = rows.join(F.broadcast(plan.select("source", "whole_epochs", "rest")), "source").select(
        "source", "rest", "tokens", order_key(mixture.seed, F.col("whole_epochs") + 1, F.col("doc_id"), F.col("text")).alias("key")
    ).filter("rest > 0").withColumn("block", F.substring("key", 1, BLOCK_DIGITS))
    in_blocks = keyed.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("in_block"))
    by_block = Window.partitionBy("source").orderBy("block")
    opened = in_blocks.withColumn("upto", F.sum("in_block").over(by_block)).withColumn("before", F.col("upto") - F.col("in_block"))
    # The block in which the rest of the budget ends, and how much of it is left there: a row a source, broadcast.
    ending = opened.filter("before <= rest AND upto > rest").select("source", "block", (F.col("rest") - F.col("before")).alias("left_over"))
    in_order = Window.partitionBy("source").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    at_end = (
        keyed.join(F.broadcast(ending), ["source", "block"]).withColumn("upto", F.sum("tokens").over(in_order))
        .groupBy("source", "block").agg(F.max(F.when(F.col("upto") <= F.col("left_over"), F.col("key"))).alias("key"))
    )
    # No document of the block fits: everything before the block does.
    ends = at_end.select("source", F.coalesce("key", "block").alias("cut_key"))
    return plan.join(ends, "source", "left").select("source", "tokens", "weight", "whole_epochs", F.coalesce("cut_key", F.lit("")).alias("cut_key"))


def schedule(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """docs with a row for each scheduled epoch, __epoch long and __key string; the text isn't shuffled.

    The plan has a row a source, max_sources at most, and is broadcast.
    """
    keyed = docs.withColumn("__source", source_name())
    own = plan.select(F.col("source").alias("__source"), F.col("weight").alias("__weight"), "whole_epochs", "cut_key")
    own = own.withColumnsRenamed({"whole_epochs": "__whole", "cut_key": "__cut"})
    key = lambda epoch: order_key(seed, epoch, F.col("doc_id"), F.col("text"))
    joined = keyed.join(F.broadcast(own), "__source")
    last = F.col("__whole") + F.when(key(F.col("__whole") + 1) <= F.col("__cut"), F.lit(1)).otherwise(F.lit(0))
    epochs = F.when(last > 0, F.sequence(F.lit(1).cast("long"), last)).otherwise(F.array().cast("array<bigint>"))
    return joined.withColumn("__epoch", F.explode(epochs)).withColumn("__key", key(F.col("__epoch")))


def mixed(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The schedule: (doc_id, source, weight, epoch, block, order_key, n_tokens), a row for each document and epoch.

    Within a source, epoch, block and order_key give the order. Rows of null source form one source, named
    ''. Null and empty texts have no tokens and come once an epoch. Rows that repeat an id within a source
    share a place; rows without an id are placed by their text. No rows: no rows.
    """
    plan = cut(source_plan(docs, mixture))
    narrow = docs.select("doc_id", "text", "source")
    return schedule(narrow, plan, mixture.seed).select(
        "doc_id", F.col("__source").alias("source"), F.col("__weight").alias("weight"), F.col("__epoch").alias("epoch"),
        F.conv(F.substring("__key", 1, BLOCK_DIGITS), 16, 10).cast("int").alias("block"), F.col("__key").alias("order_key"),
        n_tokens().alias("n_tokens"),
    )


def mix(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The scheduled rows themselves, with the columns of docs; a document of a small source comes in several epochs.

    Nulls, repeated rows and empty tables as in ``mixed``; other columns may have any names.
    """
    plan = cut(source_plan(docs, mixture))
    return schedule(docs, plan, mixture.seed).select(named(docs))
