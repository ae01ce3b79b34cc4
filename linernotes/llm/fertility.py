"""Quality rules: base counts of a text, and how a public tokenizer takes it.

Three measures: characters per token, the share of tokens that are single fallback bytes, and the
entropy of tokens in blocks of 96, as a share of what as many different tokens would have, averaged over
the whole text. (The entropy of a whole text's tokens falls with its length; that of blocks doesn't.)
Each language, or script where no language is named, has bands for the measures, from the quartiles of
all its documents that pass the base rules; documents outside a band are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from linernotes.llm.common import VOCABULARY, cut, read_bounded, slices

SYMBOLS = b"#*$%&|<>"
NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
#: Bytes that continue a code point.
CONTINUED = bytes(range(0x80, 0xC0))
REMEMBERED = 100_000
MEASURES = ["chars_per_token", "byte_share", "token_entropy"]
#: Measures are counted in steps of 1 / STEPS, so that quartiles are exact and alike on every run.
STEPS = 10_000
#: Tokens of an entropy block, and words of a text whose tokens are laid out at a time.
BLOCK, WORDS_AT_A_TIME = 96, 50_000


@dataclass(frozen=True)
class Bands:
    """A band reaches so many quartile distances, of at least ``least`` each, below and above the quartiles.

    In order of MEASURES. Languages with fewer documents than min_docs that pass the base rules share the
    bands of all documents.
    """

    below: tuple[float, float, float] = (6.0, 6.0, 3.0)
    above: tuple[float, float, float] = (6.0, 6.0, 8.0)
    least: tuple[float, float, float] = (0.05, 0.02, 0.008)
    min_docs: int = 50
    min_words: int = 50
    max_repeat_percent: int = 50


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    pairs = pd.factorize(ids[:-1] * (n + 1) + ids[1:])[0].astype(np.int64)
    windows = pd.factorize(pairs[:-1] * (n + 1) + ids[2:])[0]
    again = np.bincount(windows)[windows] > 1
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : n - 2 + i] |= again
    return int(covered.sum())


def base_counts(data: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    chars = sum(map(len, words)) - (len(data) - len(data.translate(None, CONTINUED)))
    symbols = len(data.translate(None, NOT_SYMBOLS))
    written = [line for line in data.split(b"\n") if line.strip()]
    return chars, symbols, len(written) - len(set(written)), repeated_words(words)


class Fertility:
    """Tokens of words, remembered. Pieces don't go over white space, so a text's tokens are its words'."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.flat, self.starts, self.counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self, words: set[bytes]) -> None:
        if len(self.at) > REMEMBERED:
            self.clear()
        new = [w for w in words if w not in self.at]
        if not new:
            return
        encoded = self.model.encode([w.decode() for w in new], num_threads=1)
        counts = np.fromiter(map(len, encoded), np.int64, len(new))
        self.at.update(zip(new, range(len(self.counts), len(self.counts) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, np.fromiter((t for e in encoded for t in e), np.int32, int(counts.sum()))])

    def measures(self, words: list[bytes], chars: int) -> tuple[float, float, float]:
        """Of a text's words, all learned; zeros for none."""
        n = n_bytes = blocks = 0
        entropy = 0.0
        for i in range(0, len(words), WORDS_AT_A_TIME):
            rows = np.array([self.at[w] for w in words[i : i + WORDS_AT_A_TIME]])
            counts = self.counts[rows]
            firsts = np.cumsum(counts) - counts
            tokens = self.flat[np.arange(counts.sum()) + np.repeat(self.starts[rows] - firsts, counts)]
            n += len(tokens)
            n_bytes += int(self.is_byte[tokens].sum())
            of_blocks = block_entropies(tokens)
            entropy += float(of_blocks.sum())
            blocks += len(of_blocks)
        return (chars / n, n_bytes / n, entropy / blocks) if n else (0.0, 0.0, 0.0)


def block_entropies(tokens: np.ndarray) -> np.ndarray:
    """Of each block of tokens, in order; the last block ends with the text and may overlap the one before."""
    if len(tokens) < 2:
        return np.ones(len(tokens))
    width = min(BLOCK, len(tokens))
    whole = len(tokens) // width
    rows = tokens[: whole * width].reshape(whole, width)
    if whole * width < len(tokens):
        rows = np.vstack([rows, tokens[-width:]])
    rows = np.sort(rows, axis=1)
    first = np.ones(rows.shape, bool)
    first[:, 1:] = rows[:, 1:] != rows[:, :-1]
    starts = np.flatnonzero(first)
    times = np.diff(np.append(starts, rows.size))
    lost = np.bincount(starts // width, weights=times * np.log(times), minlength=len(rows))
    return 1 - lost / (width * np.log(width))


def profile(data: bytes | None, fertility: Fertility) -> tuple:
    data = data or b""
    words = data.split()
    counts = base_counts(data, words)
    return len(words), *counts, *fertility.measures(words, counts[0])


def profiles(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """(doc_id, band, n_words, base counts, measures) of each row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(read_bounded(vocabulary_path))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fertility = Fertility(sent.value)
        for texts in series:
            rows = []
            for part in slices(texts, 1 << 21):
                fertility.learn(set().union(*((t or b"").split() for t in part)))
                rows += [profile(t, fertility) for t in part]
            yield pd.DataFrame(rows, columns=names + MEASURES)

    kind = ", ".join([*(f"{n} long" for n in names), *(f"{m} double" for m in MEASURES)])
    profiled = F.pandas_udf(run, kind)(F.col("text").cast("binary"))
    return docs.select("doc_id", band_of(F.col("lang"), F.col("text")).alias("band"), profiled.alias("p")).select("doc_id", "band", "p.*")


def band_of(lang: Column, text: Column) -> Column:
    """The language, or the script most letters of which the text has, where the language is null."""
    scripts = ["Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Han", "Hiragana", "Hangul"]
    counts = F.array(*[
        F.struct(F.regexp_count(text, F.lit(rf"\p{{Is{s}}}")).alias("n"), F.lit(-i).alias("rank"), F.lit(f"script {s}").alias("name"))
        for i, s in enumerate(scripts)
    ])
    most = F.array_max(counts)
    script = F.when(most["n"] > 0, most["name"]).otherwise(F.lit("script none"))
    return F.when(lang.isNotNull(), lang.cast("string")).otherwise(script)


def bands(passed: DataFrame, settings: Bands) -> DataFrame:
    """(band, low and high of each measure), with a row of null band for all documents together.

    Quartiles are exact over counts per step; what is gathered is steps, not documents.
    """
    steps = F.array(*[F.struct(F.lit(i).alias("m"), F.round(F.col(m) * STEPS).cast("int").alias("step")) for i, m in enumerate(MEASURES)])
    counted = passed.select("band", F.explode(steps).alias("s")).groupBy("band", "s.m", "s.step").agg(F.count("*").alias("n"))
    whole = counted.groupBy("m", "step").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("band"), "m", "step", "n")
    counted = counted.unionByName(whole)
    group = Window.partitionBy("band", "m")
    placed = counted.withColumn("upto", F.sum("n").over(group.orderBy("step"))).withColumn("all", F.sum("n").over(group))
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("step"))) / STEPS
    found = placed.groupBy("band", "m").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"), F.max("all").alias("n"))
    found = found.filter((F.col("n") >= settings.min_docs) | F.col("band").isNull())
    of_measure = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("m") + 1)
    unit = F.greatest(F.col("q3") - F.col("q1"), of_measure(settings.least))
    limits = found.select(
        "band", "m", (F.col("q1") - of_measure(settings.below) * unit).alias("low"), (F.col("q3") + of_measure(settings.above) * unit).alias("high")
    )
    sides = [F.max(F.when(F.col("m") == i, F.col(side))).alias(f"{side}_{m}") for i, m in enumerate(MEASURES) for side in ("low", "high")]
    return limits.groupBy("band").agg(*sides)


def quality_rules(docs: DataFrame, settings: Bands = Bands(), vocabulary_path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, the measures, base_failed, kept).

    A row for each row of docs (doc_id, text, lang). Null and empty texts have no words and fail the base
    rules. Repeated rows count as often as they come. Languages too rare for bands of their own are held
    to those of all documents; if no document passes the base rules there are no bands, and none is kept.
    """
    found = cut(profiles(docs.select("doc_id", "text", "lang"), vocabulary_path))
    failed = (F.col("n_words") < settings.min_words) | (100 * F.col("n_repeat_words") > settings.max_repeat_percent * F.col("n_words"))
    found = found.withColumn("base_failed", failed)
    limits = cut(bands(found.filter(~F.col("base_failed")), settings))
    general = limits.filter("band IS NULL").first()
    joined = found.join(limits.filter("band IS NOT NULL"), "band", "left")
    inside = F.lit(True)
    for m in MEASURES:
        low, high = (F.coalesce(F.col(f"{s}_{m}"), F.lit(general[f"{s}_{m}"] if general else None)) for s in ("low", "high"))
        inside &= F.col(m).between(low, high)
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *MEASURES, "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
