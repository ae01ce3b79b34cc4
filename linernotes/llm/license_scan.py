"""Licence notices in texts: MinHash bands over overlapping windows retrieve, shingles verify.

Everything is DataFrame expressions. A document's words are hashed once, five at a time; windows of
these shingles overlap by half. Each band is one minimum of the window's hashes under one of four
orders. Template windows are taken at every offset, and a template's window is so short that a copy
which still holds 80 % of its shingles has an unbroken run with a whole document window in it: there
both sides have the same shingles, and every band agrees. Windows that share a part s of their shingles
meet with probability 1 - (1 - s) ** 4.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linernotes.llm.license_notices import NOTICES

#: Anything but letters and digits parts words.
NOT_WORD = r"[^\p{L}\p{N}]+"
SHINGLE, SHARE = 5, 0.8
#: Window lengths in shingles; a template uses the longest that its copies are sure to hold.
WINDOWS = (16, 4, 1)
#: One order of the hashes a band: a hash is compared after exclusive or with the mask.
ORDERS = (0, 0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D)
#: Templates are a fixed list and become literals of the plan; this bounds it.
MOST_TEMPLATES, MOST_WORDS = 200, 2000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD, -1), lambda w: w != "")


def starts(n: Column, window: int, step: int) -> Column:
    """Starts of the windows over n shingles, from 0; the last one ends with the text."""
    inner = F.sequence(F.lit(0), n - window, F.lit(step))
    return F.when(n >= window, F.array_union(inner, F.array(n - window))).otherwise(F.array().cast("array<int>"))


def shingle_hashes(hashes: Column) -> Column:
    """Of five words' hashes each; none for shorter texts."""
    at = F.when(F.size(hashes) >= SHINGLE, F.sequence(F.lit(0), F.size(hashes) - SHINGLE)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(SHINGLE)]))


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once a row: explode of one element.

    A plain projection may be merged into what reads it; inside a lambda it would then be computed again
    for each element, and work would follow the square of a text's length.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def orders(shingles: Column) -> Column:
    """The hashes under each order."""
    return F.struct(*[
        (shingles if order == 0 else F.transform(shingles, lambda h, o=order: h.bitwiseXOR(F.lit(o)))).alias(f"o{i}")
        for i, order in enumerate(ORDERS)
    ])


def minima(ordered: Column, window: int, step: int) -> Column:
    """A band: the least hash of each window. ordered is a settled column."""
    if window == 1:
        return ordered
    return F.transform(starts(F.size(ordered), window, step), lambda s: F.array_min(F.slice(ordered, s + 1, F.lit(window))))


def with_bands(df: DataFrame, windows: list[int], step_of) -> DataFrame:
    """df (text) with words, and bands: a struct of w<window>_<order>."""
    df = settled(df, "words", words_of(F.col("text"))).drop("text")
    df = settled(df, "wh", F.transform("words", lambda w: F.xxhash64(w)))
    df = settled(df, "h", shingle_hashes(F.col("wh"))).drop("wh")
    df = settled(df, "ordered", orders(F.col("h"))).drop("h")
    fields = [minima(F.col(f"ordered.o{i}"), w, step_of(w)).alias(f"w{w}_{i}") for w in windows for i in bands_of(w)]
    return settled(df, "bands", F.struct(*fields)).drop("ordered")


def window_for(n: int) -> int:
    """The window of a template of n shingles.

    A copy may lack a fifth of them. An exchanged word costs five inside the text, fewer only near an
    end; what is left falls into at most one run more than five goes into the lack.
    """
    lost = math.floor(n * (1 - SHARE) + 1e-9)
    run = math.ceil((n - lost) / (lost // SHINGLE + 1))
    return next(w for w in WINDOWS if w + max(1, w // 2) - 1 <= run or w == 1)


def bands_of(window: int) -> range:
    """With one shingle a window, all orders say the same."""
    return range(len(ORDERS) if window > 1 else 1)


def text_shingles(words: Column) -> Column:
    at = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - SHINGLE + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(words, i, F.lit(SHINGLE)), " ")))


def prepared(spark: SparkSession, templates: list[tuple[str, str]]) -> list[dict]:
    """Each template's shingles and bands, by the expressions that documents get. A bounded list."""
    if len(templates) > MOST_TEMPLATES or any(len(t.split()) > MOST_WORDS for _, t in templates):
        raise ValueError(f"at most {MOST_TEMPLATES} templates of {MOST_WORDS} words")
    rows = spark.createDataFrame(templates, "license_id string, text string")
    banded = with_bands(rows, list(WINDOWS), lambda w: 1).withColumn("shingles", text_shingles(F.col("words")))
    out = []
    for r in banded.select("license_id", "shingles", F.greatest(F.size("words") - SHINGLE + 1, F.lit(0)).alias("n"), "bands").collect():
        if r["n"]:
            window = window_for(r["n"])
            out.append({"id": r["license_id"], "shingles": r["shingles"], "window": window, "bands": [r["bands"][f"w{window}_{i}"] for i in bands_of(window)]})
    return out


def longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, license_id, shared, of_shingles, containment): a row for each document and template of whose

    distinct shingles the document holds at least 80 %. Templates under five words are never found.
    Null, empty and short texts hold none; rows without an id are reported with a null id; repeated rows
    give repeated results. No rows or no templates: no rows.
    """
    spark = docs.sparkSession
    known = prepared(spark, templates if templates is not None else NOTICES)
    windows = sorted({t["window"] for t in known})
    if not known:
        known, windows = [{"id": "", "shingles": [""], "window": 1, "bands": [[0]]}], [1]  # meets nothing
    banded = with_bands(docs.select("doc_id", "text"), windows, lambda w: max(1, w // 2))

    def overlaps(window: int, i: int, values: list[int]) -> Column:
        return F.arrays_overlap(F.col(f"bands.w{window}_{i}"), longs(values))

    hit = F.lit(False)
    for window in windows:
        for i in bands_of(window):
            hit |= overlaps(window, i, sorted({v for t in known if t["window"] == window for v in t["bands"][i]}))
    met = [
        F.when(
            F.array_contains(F.array(*[overlaps(t["window"], i, b) for i, b in enumerate(t["bands"])]), True),
            F.struct(F.lit(t["id"]).alias("license_id"), F.array(*map(F.lit, t["shingles"])).alias("shingles")),
        )
        for t in known
    ]
    retrieved = banded.filter(hit).select("doc_id", "words", F.array(*met).alias("met"))
    retrieved = settled(retrieved, "own", text_shingles(F.col("words")))
    pairs = retrieved.select("doc_id", "own", F.explode(F.filter("met", lambda m: m.isNotNull())).alias("t"))
    shared = F.size(F.array_intersect("own", "t.shingles"))
    counted = pairs.select("doc_id", "t.license_id", shared.cast("long").alias("shared"), F.size("t.shingles").cast("long").alias("of_shingles"))
    return counted.filter(F.col("shared") >= SHARE * F.col("of_shingles")).withColumn("containment", F.round(F.col("shared") / F.col("of_shingles"), 6))
