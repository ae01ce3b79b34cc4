"""Phrases that occur together more often than their parts let expect: a weighted de Bruijn graph of words.

Nodes are word pairs, an edge is the three words from one node to the next, its weight how often they
follow one another. A piece of text is a walk; its last pair and its last word, which no edge begins with,
are counted as they are. So every word of the corpus starts exactly one gram: three words, or fewer at the
end of its piece. Only these are counted from the text. Shorter counts follow: a node's flow is the weight
of the edges that leave it plus the walks that end in it, a word's count the flow of the nodes that begin
with it plus the walks of which it is the last word.

A node with one edge in and one out, both as heavy as its flow, lies inside an unary path: all that
passes it goes the same way, so the pair has no occurrence outside the longer phrase. Such nodes are
contracted: they are no candidates of their own (``unary_paths`` gives the paths as text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linernotes.llm.common import LOWER, UPPER, cut, stored

#: Words of an edge, and words a candidate has at least.
LONGEST, SHORTEST = 3, 2
MIN_COUNT, LIMIT = 10, 2000
#: A candidate goes if one that holds it has at least this many hundredths of its occurrences.
CONTAINED = 50
#: Text is lower-cased and its separators made alike in one pass.
PLAIN = bytes.maketrans(UPPER.encode() + b".,;:!?\x0b\x0c\r\t", LOWER.encode() + b"\n" * 9 + b" ")
#: Words that a task counts together before it hands them on, and bytes of a text split at a time.
TOGETHER, SEGMENT = 1_000_000, 1 << 20


def segments(data: bytes) -> Iterator[bytes]:
    """A text in parts of about SEGMENT bytes, cut before a blank or the end of a piece."""
    start = 0
    while start < len(data):
        end = start + SEGMENT
        if end < len(data):
            ends = [x for x in (data.find(b" ", end), data.find(b"\n", end)) if x >= 0]
            end = min(ends, default=len(data))
        yield data[start:end]
        start = end


class Walks:
    """Words of one language as numbers, in the order of the texts; 0 stands for the end of a piece."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {b"\n": 0}
        self.steps: list[np.ndarray] = []
        self.size = 0

    def add(self, data: bytes) -> None:
        words = data.replace(b"\n", b" \n ").split(b" ")
        numbers = self.numbers
        self.steps.append(np.array([numbers.setdefault(w, len(numbers)) for w in words if w], dtype=np.int64))
        self.size += len(self.steps[-1])

    def grams(self, last: bool, buckets: int) -> pa.RecordBatch | None:
        """(bucket, ones, twos, grams, counts) of what was added; an unfinished piece's last two words stay, unless last."""
        walk = np.concatenate([*self.steps, np.zeros(2, np.int64)]) if self.steps else np.zeros(2, np.int64)
        known = len(walk) - 2 if last or not self.size or walk[-3] == 0 else max(len(walk) - 4, 0)
        kept = walk[known:-2]
        first, second, third = walk[:known], walk[1 : known + 1], walk[2 : known + 2]
        words = pa.array(list(self.numbers), pa.binary())
        self.numbers, self.steps, self.size = {b"\n": 0}, [], 0
        if len(kept):
            self.add(b" ".join(words.take(pa.array(kept)).to_pylist()))
        real = first != 0
        if not real.any():
            return None
        # Numbered anew in the order of the words: grams come out sorted, which makes their shuffle small.
        order = pc.sort_indices(words).to_numpy().astype(np.int64)
        order = np.concatenate([[0], order[order != 0]])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words = words.take(pa.array(order))
        n = len(order)
        first, second = rank[first[real]], rank[second[real]]
        third = np.where(second == 0, 0, rank[third[real]])
        codes, counts = np.unique((first * n + second) * n + third, return_counts=True)
        a, b, c = codes // n // n, codes // n % n, codes % n

        hashes = np.array([xxhash.xxh64_intdigest(w) for w in words.to_pylist()], dtype=np.uint64)
        hashes[0] = 0
        with np.errstate(over="ignore"):
            mixed = (hashes[a] * np.uint64(0x9E3779B97F4A7C15) + hashes[b]) * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[c]
            mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0x165667B19E3779F9)
        bucket = ((mixed >> np.uint64(24)) % np.uint64(buckets)).astype(np.int32)
        # By length within a bucket, with the places where the next length begins: no gram has to be taken apart to tell its own.
        length = 1 + (b > 0) + (c > 0)
        by = np.argsort(bucket * (LONGEST + 1) + length, kind="stable")
        spaced = pc.binary_join_element_wise(pa.scalar(b" ", pa.binary()), words, pa.scalar(b"", pa.binary()))  # a blank before each
        spaced = pa.concat_arrays([pa.array([b""], pa.binary()), spaced.slice(1)])  # nothing for the end of a piece
        texts = pc.binary_join_element_wise(words.take(pa.array(a[by])), spaced.take(pa.array(b[by])), spaced.take(pa.array(c[by])), pa.scalar(b"", pa.binary()))
        filled, starts = np.unique(bucket[by], return_index=True)
        offsets = pa.array(np.append(starts, len(by)), pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, texts), pa.scalar(b"\n", pa.binary()))
        numbers = pa.ListArray.from_arrays(offsets, pa.array(counts[by], pa.int64()))
        upto = [np.add.reduceat(length[by] <= k, starts, dtype=np.int32) for k in (1, 2)]
        heads = [pa.array(filled, pa.int32()), *(pa.array(u, pa.int32()) for u in upto)]
        return pa.RecordBatch.from_arrays([*heads, joined.cast(pa.string()), numbers], names=["bucket", "ones", "twos", "grams", "counts"])


def counted_in_tasks(docs: DataFrame, buckets: int) -> DataFrame:
    """(lang, bucket, ones, twos, grams, counts): grams, joined by line ends, that tasks counted in parts of the corpus.

    Those of one word end before the place ones, those of two words before twos.
    """
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("ones", pa.int32()), ("twos", pa.int32()), ("grams", pa.string()), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks: dict[str, Walks] = {}

        def handed_on(last: bool) -> Iterator[pa.RecordBatch]:
            for lang, walk in walks.items():
                out = walk.grams(last, buckets)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out), pa.string()), *out.columns], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                walk = walks.setdefault(lang.as_py(), Walks())
                for part in segments(text.as_py().translate(PLAIN) + b"\n"):
                    walk.add(part)
                    if sum(w.size for w in walks.values()) >= TOGETHER:
                        yield from handed_on(last=False)
                        walks = {k: w for k, w in walks.items() if w.size or w is walk}
        yield from handed_on(last=True)

    narrow = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return narrow.mapInArrow(run, "lang string, bucket int, ones int, twos int, grams string, counts array<long>")


def longest_grams(docs: DataFrame) -> DataFrame:
    """(lang, words, gram, n): each edge with its weight, and the ends of walks with theirs."""
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counted_in_tasks(docs, buckets).repartition("bucket")
    zipped = F.arrays_zip(F.split("grams", "\n").alias("gram"), F.col("counts").alias("n"))
    words = F.when(F.col("at") < F.col("ones"), 1).when(F.col("at") < F.col("twos"), 2).otherwise(3).alias("words")
    rows = dealt.select("bucket", "lang", "ones", "twos", F.posexplode(zipped).alias("at", "g")).select("bucket", "lang", words, "g")
    summed = rows.select("bucket", "lang", "words", F.col("g.gram").alias("gram"), F.col("g.n").alias("n")).groupBy("bucket", "lang", "words", "gram").agg(F.sum("n").alias("n"))
    return summed.drop("bucket")


def flowed(grams: DataFrame, words: int, min_count: int) -> DataFrame:
    """Counts of grams of ``words`` - 1 words from those of ``words``: what flows from a gram's beginning.

    Grams of ``words`` words are whole here: they go on only if they are frequent, their flow always.
    """
    full = F.col("words") == words
    own = F.struct("words", "gram", "n")
    start = F.substring_index("gram", " ", words - 1) if words > 1 else F.lit("")
    flow = F.struct(F.lit(words - 1).alias("words"), start.alias("gram"), F.col("n").alias("n"))
    kept = F.when(~full, F.array(own)).when(F.col("n") >= min_count, F.array(own, flow)).otherwise(F.array(flow))
    rows = grams.select("lang", F.explode(kept).alias("g")).select("lang", "g.*")
    return rows.groupBy("lang", "words", "gram").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, words, gram, n) of all grams of one to three words found min_count times or more, exact; written.

    The empty gram of no words holds the language's word count.
    """
    grams = longest_grams(docs)
    for words in range(LONGEST, 0, -1):
        grams = flowed(grams, words, min_count)
    return stored(grams.filter((F.col("words") == 0) | (F.col("n") >= min_count)))


def nodes(found: DataFrame) -> DataFrame:
    """(lang, gram, incoming, outgoing) of each node on a frequent edge: the heaviest edge in and out."""
    ends = F.array(
        F.struct(F.substring_index("gram", " ", 2).alias("gram"), F.lit(None).cast("long").alias("i"), F.col("n").alias("o")),
        F.struct(F.substring_index("gram", " ", -2).alias("gram"), F.col("n").alias("i"), F.lit(None).cast("long").alias("o")),
    )
    rows = found.filter(F.col("words") == LONGEST).select("lang", F.explode(ends).alias("e")).select("lang", "e.*")
    return rows.groupBy("lang", "gram").agg(F.max("i").alias("incoming"), F.max("o").alias("outgoing"))


def inner(n: Column) -> Column:
    """Whether a node lies inside an unary path: as heavy as its flow, the edge in and the edge out are the only ones."""
    return F.coalesce((F.col("incoming") == n) & (F.col("outgoing") == n), F.lit(False))


def candidates(found: DataFrame) -> DataFrame:
    """(lang, phrase, words, a): frequent phrases that no longer one mostly holds, unary paths contracted."""
    phrases = found.filter(F.col("words") >= SHORTEST)
    joined = phrases.join(nodes(found), ["lang", "gram"], "left")
    held = 100 * F.greatest("incoming", "outgoing") >= CONTAINED * F.col("n")
    open_ = joined.filter(~inner(F.col("n"))).filter(~F.coalesce(held, F.lit(False)))
    return open_.select("lang", F.col("gram").alias("phrase"), "words", F.col("n").alias("a"))


def scored(phrases: DataFrame, found: DataFrame) -> DataFrame:
    """phrases with l, r and score of their lowest cut; in decimals, as products pass 64 bits."""
    first = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"),
        F.when(k == 1, F.substring_index("phrase", " ", 1)).otherwise(F.substring_index("phrase", " ", 2)).alias("head"),
        F.when(F.col("words") - k == 1, F.substring_index("phrase", " ", -1)).otherwise(F.substring_index("phrase", " ", -2)).alias("tail"),
    ))
    cuts = phrases.select("lang", "phrase", "a", F.explode(first).alias("c")).select("lang", "phrase", "a", "c.*")
    part = found.filter(F.col("words").between(1, LONGEST - 1))
    cuts = cuts.join(part.select("lang", F.col("gram").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(part.select("lang", F.col("gram").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    wide = {c: f"cast({c} as decimal(18,0))" for c in "alr"}
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * ({wide['a']} * {wide['a']})) div ({wide['l']} * {wide['r']})")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return lowest.select("lang", "phrase", "a", "m.l", "m.r", "m.score")


def best(phrases: DataFrame, limit: int) -> DataFrame:
    """The first phrases of each language with their rank; each of 64 parts of a language first gives its own."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    firsts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= limit)
    return firsts.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= limit)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, limit: int = LIMIT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of two or three words of each language.

    Words are parted by blanks and tabs, pieces by ``.,;:!?`` and line ends; only A-Z are lower-cased. Null
    and empty texts hold no word, a null language is ``und``. Repeated rows count each time, ids play no
    part. Very long texts are split in parts, whose walks go on. Ties go by count, then by the phrase's
    bytes. No rows: no rows. Other columns are ignored.
    """
    found = frequent(docs, min_count)
    top = best(scored(candidates(found), found), limit)
    totals = found.filter(F.col("words") == 0).select("lang", F.col("n").alias("n"))
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def unary_paths(found: DataFrame) -> DataFrame:
    """(lang, phrase, n): the frequent edges, those that follow one another through inner nodes as one phrase.

    By pointer jumping: each round doubles how far an edge sees back, so the longest path takes the
    logarithm of its edges in rounds. A path without a beginning cannot be, as walks enter it somewhere.
    """
    flow = found.filter(F.col("words") == 2).join(nodes(found), ["lang", "gram"]).filter(inner(F.col("n"))).select("lang", F.col("gram").alias("node"))
    edges = found.filter(F.col("words") == LONGEST).select("lang", "gram", "n", F.substring_index("gram", " ", 2).alias("node"))
    before = edges.select("lang", F.col("gram").alias("back"), F.substring_index("gram", " ", -2).alias("node")).join(flow, ["lang", "node"])
    linked = cut(edges.join(before, ["lang", "node"], "left").select("lang", "gram", "n", "back", F.when(F.col("back").isNull(), 0).otherwise(1).alias("steps"), F.coalesce("back", "gram").alias("head")))
    while linked.filter("back IS NOT NULL").limit(1).count():
        to = linked.select("lang", F.col("gram").alias("back"), F.col("back").alias("back2"), F.col("steps").alias("more"), F.col("head").alias("head2"))
        linked = cut(linked.join(to, ["lang", "back"], "left").select("lang", "gram", "n", F.col("back2").alias("back"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.coalesce("head2", "head").alias("head")))
    paths = linked.groupBy("lang", "head", "n").agg(F.sort_array(F.collect_list(F.struct("steps", F.substring_index("gram", " ", -1).alias("word")))).alias("w"))
    words = F.concat(F.array(F.substring_index("head", " ", 2)), F.transform("w", lambda x: x["word"]))
    return paths.select("lang", F.array_join(words, " ").alias("phrase"), "n")
