"""Benchmark passages in training text, found by spaced seeds.

A seed is a mask over a span of words: the words at its ones are hashed, those at its zeros ignored, so
a substituted word spoils only the seeds that look at it. Seeds of the benchmark and of the documents
are joined by hash; around each hit the two texts are compared word by word along the hit's diagonal.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linernotes.llm.common import cut, slices, stored

#: Over a window of 20 words, every placement of up to four substitutions leaves a seed of one of these
#: masks untouched (tests/llm/test_decontaminate.py tries them all).
MASKS = ("111111", "1010011101", "101001100011")
#: Masks of items by their number of words, where those above aren't sure: whatever words of the item are
#: exchanged, up to the allowed number, leave a seed of one of them. Other lengths use MASKS.
SHORT_MASKS = {
    1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",),
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111"),
    8: ("111111", "1111011", "1101111"),
    9: ("1111011", "1101111"),
    10: ("11111", "111011", "11010011"),
    11: ("111111", "1110111", "1011111", "111001011"),
    12: (*MASKS, "11101011"),
    13: (*MASKS, "1111101"),
    15: (*MASKS, "1110101001"),
}
#: Every mask; its place here is its number.
ALL_MASKS = tuple(dict.fromkeys(m for masks in (MASKS, *SHORT_MASKS.values()) for m in masks))
SPAN = max(map(len, ALL_MASKS))
#: Items of fewer words are left out; a caller may ask for longer ones only.
SHORTEST = 1
#: Words compared around a hit, and the share of them that must be equal.
WINDOW, SHARE = 20, 0.8
#: Words that are kept on either side of a hit for the comparison.
CONTEXT = 2 * WINDOW
#: Bits of the filter that spares documents' seeds the shuffle: 2 MB, whatever the benchmark's size. A
#: fuller filter lets more seeds through to the join, which decides.
SLOT_BITS = 24
#: Separators of words: ASCII that is neither letter nor digit. Other characters belong to words, but each
#: character of a script that is written without spaces (Thai, Lao, Tibetan, Burmese, Khmer, kana, Han) is a word.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
TO_SPACE = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))
UNSPACED = re.compile("[\u0e01-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, lower-cased."""
    text = (text or "").lower()
    if not text.isascii():
        text = UNSPACED.sub(r" \g<0> ", text)
    words = text.encode().translate(TO_SPACE).split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the masked words from each position that has room for the mask."""
    n = max(0, len(hashes) - len(mask) + 1)
    total = np.zeros(n, np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            total = (total ^ hashes[i : i + n]) * GOLDEN
            total ^= total >> np.uint64(29)
    return total


def passing(seed: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Positions of the seeds whose three bits are set in the filter."""
    at = np.arange(len(seed))
    for shift in (64 - SLOT_BITS, 16, 0):
        slot = (seed[at] >> np.uint64(shift)).astype(np.int64) & ((1 << SLOT_BITS) - 1)
        at = at[(filled[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1]
    return at


def hashes_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: word_hashes(t).view(np.int64))


def seeds_of(texts: pd.Series) -> pd.Series:
    def rows(text: str | None) -> list[tuple[int, int, int]]:
        hashes = word_hashes(text)
        masks = SHORT_MASKS.get(len(hashes), MASKS)
        return [(ALL_MASKS.index(mask), int(s), i) for mask in masks for i, s in enumerate(seeds(hashes, mask).view(np.int64))]

    return texts.map(rows)


def regions_of(texts: list[str | None], filled: np.ndarray, masks: list[int]) -> list[list[tuple[int, np.ndarray, list[tuple[int, int, int]]]]]:
    """For each text, (first word, word hashes, hits (mask, seed, position in the region)) of each stretch

    with seeds of the given masks that pass the filter, with context on both sides. Works through whole texts.
    """
    # Between two texts lies a gap as long as a mask: a seed over the end sees it at the mask's last one.
    gap = np.arange(1, SPAN + 1, dtype=np.uint64)
    own = [word_hashes(t) for t in texts]
    starts = np.cumsum([0, *(len(h) + SPAN for h in own)])
    joined = np.concatenate([x for h in own for x in (h, gap)]) if own else gap
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for m in masks:
        seed = seeds(joined, ALL_MASKS[m])
        at = passing(seed, filled)
        doc = np.searchsorted(starts, at, side="right") - 1
        for d, p, s in zip(doc.tolist(), (at - starts[doc]).tolist(), seed[at].view(np.int64).tolist()):
            found[d].append((p, m, s))
    return [grouped(sorted(hits), hashes) for hits, hashes in zip(found, own)]


def grouped(hits: list[tuple[int, int, int]], hashes: np.ndarray) -> list[tuple[int, np.ndarray, list[tuple[int, int, int]]]]:
    out, group = [], []
    for hit in [*hits, None]:
        if group and (hit is None or hit[0] - group[-1][0] > CONTEXT or hit[0] - group[0][0] > 8 * CONTEXT):
            a, b = max(0, group[0][0] - CONTEXT), group[-1][0] + SPAN + CONTEXT
            out.append((a, hashes[a:b].view(np.int64), [(m, s, p - a) for p, m, s in group]))
            group = []
        group.append(hit)
    return out


def best_overlap(doc: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int]:
    """(equal words, window length, position in doc) of the best window on any of the diagonals, the first of equals.

    A shift is a word's position in doc less that in item.
    """
    window, best = min(WINDOW, len(item)), (0, min(WINDOW, len(item)), 0)
    for shift in shifts:
        a, b = max(0, shift), min(len(doc), shift + len(item))
        if b - a < window:
            continue
        equal = np.concatenate([[0], np.cumsum(doc[a:b] == item[a - shift : b - shift])])
        sums = equal[window:] - equal[:-window]
        i = int(sums.argmax())
        if (sums[i], -(a + i)) > (best[0], -best[2]):
            best = (int(sums[i]), window, a + i)
    return best


def overlap(doc: pd.Series, item: pd.Series, shifts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([best_overlap(*x) for x in zip(doc, item, shifts)], columns=["equal", "window", "at"])


def seed_filter(index: DataFrame) -> np.ndarray:
    """The filter's bits, eight a byte. They are set on the executors; 512 parts of 4 kB at most come to the driver."""
    low = F.lit((1 << SLOT_BITS) - 1)
    slots = F.array(*[F.shiftrightunsigned("seed", by).bitwiseAND(low) + 1 for by in (64 - SLOT_BITS, 16, 0)])
    parts = (
        index.select(F.explode(slots).alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    filled = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    for row in parts.collect():
        first = (row["part"] - 1) * len(row["bits"])
        filled[first : first + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return filled


def contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, item_id, first_word, equal_words, window) where a document holds a benchmark item's words.

    An item counts if in some window of 20 of its words (all of it, if it is shorter) at least 80 % are
    equal at their places; the row names the document's first such window's best. Items of fewer than
    ``shortest`` words are left out; by default only those without a word. Null and empty texts hold
    nothing. Repeated rows and repeated items give one row; rows without an id give a row with a null id,
    items without an id likewise. Empty tables give no rows. Other columns of either table are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").distinct()
    items = cut(items.withColumn("item", F.xxhash64("item_id", "text")).withColumn("words", F.pandas_udf(hashes_of, "array<long>")("text")).filter(F.size("words") >= shortest).select("item", "item_id", "words", "text"))
    index = cut(items.select("item", F.explode(F.pandas_udf(seeds_of, "array<struct<mask:int,seed:long,pos:int>>")("text")).alias("s")).select("s.mask", "s.seed", "item", F.col("s.pos").alias("item_pos")))
    sent = spark.sparkContext.broadcast(seed_filter(index))
    masks = sorted(r["mask"] for r in index.select("mask").distinct().collect())  # those of ALL_MASKS that some item needs

    @F.pandas_udf("array<struct<first:int,words:array<long>,hits:array<struct<mask:int,seed:long,pos:int>>>>")
    def regions(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            found = [r for part in slices(texts, 1 << 22) for r in regions_of(part, sent.value, masks)]
            yield pd.Series([[(a, w.tolist(), h) for a, w, h in r] for r in found], dtype=object)

    found = docs.select("doc_id", F.explode(regions("text")).alias("r")).select("doc_id", "r.*")
    # 128 bits name a region: so many as a large corpus has would share some of 64.
    region = ["region", "region_too"]
    found = cut(found.withColumns({"region": F.xxhash64("doc_id", "first", "words"), "region_too": F.xxhash64(F.lit(1), "doc_id", "first", "words")}))
    hits = found.select(*region, F.explode("hits").alias("h")).select(*region, "h.*")
    met = hits.join(index, ["mask", "seed"]).select(*region, "item", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    pairs = met.groupBy(*region, "item").agg(F.collect_list("shift").alias("shifts"))
    regions_met = found.select(*region, "doc_id", "first", F.col("words").alias("doc_words")).dropDuplicates(region)
    compared = (
        pairs.join(regions_met, region).join(items.select("item", "item_id", "words"), "item")
        .withColumn("o", F.pandas_udf(overlap, "struct<equal:int,window:int,at:int>")("doc_words", "words", "shifts"))
        .filter(F.col("o.equal") >= F.ceil(F.col("o.window") * SHARE))
    )
    return compared.groupBy("doc_id", "item_id").agg(
        F.min(F.col("first") + F.col("o.at")).alias("first_word"),
        F.max("o.equal").alias("equal_words"),
        F.max("o.window").alias("window"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a benchmark item, with all their columns.

    Rows without an id are kept or dropped by their text, null and empty texts kept, repeated rows kept or
    dropped together. An empty benchmark drops nothing.
    """
    key = lambda: F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5("text")))
    keyed = docs.select("text", key().alias("doc_id"))
    bad = stored(contaminated(keyed, benchmark).select(F.col("doc_id").alias("__bad")).distinct())
    return docs.join(bad, key() == F.col("__bad"), "left_anti")
