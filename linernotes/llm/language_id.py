"""Language of a text by unigrams whose segmentation is summed out.

The pieces are those of a fixed public vocabulary. Each language has a probability for each piece; a
word's probability is the sum over all its segmentations into pieces, by the forward algorithm; a text's
is the product over its words. Probabilities are fitted by expectation-maximisation, expected counts
from the forward and backward sums.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from linernotes.llm.common import VOCABULARY, held_out, read_bounded, slices, spread_pieces, stored

#: Runs of letters, digits of no decimal system and numerals; ``words`` keeps their letters.
RUNS = re.compile(r"[^\W\d_]+")
START = "▁"
#: Longer words are summed a character at a time with rescaling, so that nothing underflows.
SHORT = 32
#: Words whose sums a task remembers.
REMEMBERED = 200_000


@dataclass(frozen=True)
class Fit:
    """docs_a_language and pieces of chars bound what is fitted on: each document is seen in evenly spaced pieces."""

    docs_a_language: int = 500
    pieces: int = 16
    chars: int = 256
    rounds: int = 3
    prior: float = 0.01
    #: Probability of a letter that no piece covers.
    unknown: float = 1e-8


def letters(run: str) -> list[str]:
    """A run's words: parted at numerals, which regular expressions take for letters (superscripts, fractions, Roman ones)."""
    return [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()


def words(text: str) -> list[str]:
    """The runs of letters of a text."""
    found = RUNS.findall(text)
    # Hardly any text has a numeral: one look at all of its runs.
    return found if "".join(found).isalpha() else [w for run in found for w in letters(run)]


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces of lower-case letters, some with the mark of a word's start."""
    model = sentencepiece.SentencePieceProcessor(model_proto=read_bounded(path))
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if (p.removeprefix(START) or "a").isalpha() and p == p.lower()})


class Pieces:
    def __init__(self, pieces: list[str]):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        #: Rows of the probability table after the pieces': an uncovered letter, and no piece.
        self.unknown, self.none = len(pieces), len(pieces) + 1

    def of(self, part: str) -> int:
        return self.ids.get(part, self.unknown if len(part) == 1 else self.none)

    def table(self, words: list[str], n: int) -> dict[tuple[int, int], np.ndarray]:
        """For marked words of equal length n: the piece from each start to each end that any word has."""
        out = {}
        for a in range(n):
            for b in range(a + 1, min(n, a + self.longest) + 1):
                get, default = self.ids.get, self.unknown if b == a + 1 else self.none
                ids = np.array([get(w[a:b], default) for w in words], np.int32)
                if (ids != self.none).any():
                    out[a, b] = ids
        return out


def by_length(words: list[str]) -> dict[int, list[int]]:
    groups = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w) + 1].append(i)
    return groups


def forward(table: dict[tuple[int, int], np.ndarray], p: np.ndarray, rows: int, n: int) -> np.ndarray:
    """(n + 1, words, languages): the sum over segmentations of each word's first letters."""
    sums = np.zeros((n + 1, rows, p.shape[1]))
    sums[0] = 1
    for (a, b), ids in sorted(table.items(), key=lambda x: x[0][1]):
        sums[b] += sums[a] * p[ids]
    return sums


def long_word(word: str, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Log sums of a word of any length, rescaled at each letter."""
    longest, logs = pieces.longest, np.zeros(p.shape[1])
    window = [np.ones(p.shape[1])]
    for end in range(1, len(word) + 1):
        total = sum(window[-k] * p[pieces.of(word[end - k : end])] for k in range(1, min(len(window), longest) + 1))
        top = total.max()
        logs += np.log(top)
        window = [w / top for w in window[-longest + 1 :]] + [total / top]
    return logs + np.log(np.maximum(window[-1], 1e-300))


class Model:
    def __init__(self, languages: list[str], pieces: list[str], p: np.ndarray):
        self.languages, self.pieces, self.p = languages, pieces, p

    def word_logs(self, words: list[str]) -> np.ndarray:
        """(words, languages): log probabilities of words of letters."""
        own, out = Pieces(self.pieces), np.empty((len(words), len(self.languages)))
        return self.fill(own, words, out)

    def fill(self, own: Pieces, words: list[str], out: np.ndarray) -> np.ndarray:
        for n, at in by_length(words).items():
            if n > SHORT:
                for i in at:
                    out[i] = long_word(START + words[i], own, self.p)
                continue
            for i in range(0, len(at), 4096):
                some = at[i : i + 4096]
                marked = [START + words[j] for j in some]
                out[some] = np.log(forward(own.table(marked, n), self.p, len(some), n)[n])
        return out


def fit(samples: list[tuple[str, list[str]]], vocabulary_pieces: list[str], settings: Fit = Fit()) -> Model:
    """samples: (language, pieces of text). No samples: a model without languages."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for lang, texts in samples:
        for text in texts:
            counts[lang].update(w for w in words(text.lower()) if len(w) < SHORT)
    languages = sorted(counts)
    own = Pieces(vocabulary_pieces)
    known = sorted({w for c in counts.values() for w in c})
    weight = np.array([[counts[lang][w] for lang in languages] for w in known], float).reshape(len(known), len(languages))
    groups = []
    for n, at in by_length(known).items():
        for i in range(0, len(at), 8192):
            some = at[i : i + 8192]
            groups.append((n, own.table([START + known[j] for j in some], n), weight[some]))

    def probabilities(expected: np.ndarray) -> np.ndarray:
        p = expected + settings.prior
        p[own.unknown :] = 0
        p /= p.sum(axis=0)
        p[own.unknown] = settings.unknown
        return p

    expected = np.zeros((own.none + 1, len(languages)))
    for n, table, w in groups:  # at first, each occurrence of a piece counts
        for ids in table.values():
            np.add.at(expected, ids, w)
    p = probabilities(expected)
    for _ in range(settings.rounds):
        expected = np.zeros_like(p)
        for n, table, w in groups:
            ahead = forward(table, p, len(w), n)
            behind = np.zeros_like(ahead)
            behind[n] = 1
            for (a, b), ids in sorted(table.items(), key=lambda x: -x[0][0]):
                behind[a] += behind[b] * p[ids]
            share = w / np.maximum(ahead[n], 1e-300)
            for (a, b), ids in table.items():
                np.add.at(expected, ids, share * ahead[a] * behind[b] * p[ids])
        p = probabilities(expected)
    return Model(languages, vocabulary_pieces, p)


def sample_ids(docs: DataFrame, settings: Fit) -> DataFrame:
    """(doc_id, lang) of the documents of each language whose ids come first in the order of their hashes.

    Counts by the hash's first bits say which part of that order can be in the sample; only that part is
    put together by language, so a language of a third of all rows is no task's burden.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(4, 2)).select("doc_id", "lang").distinct()
    usable = usable.withColumn("hash", F.xxhash64("doc_id")).withColumn("part", F.shiftrightunsigned("hash", 52).cast("int"))
    counts = usable.groupBy("lang", "part").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("part"))
    last = F.min(F.when(F.col("upto") >= settings.docs_a_language, F.col("part")))
    limits = stored(counts.withColumn("upto", upto).groupBy("lang").agg(F.coalesce(last, F.lit(1 << 12)).alias("last_part")))
    early = usable.join(limits, "lang").filter("part <= last_part")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("part", "hash", "doc_id"))
    return early.withColumn("nth", nth).filter(F.col("nth") <= settings.docs_a_language).select("doc_id", "lang")


def learn(docs: DataFrame, settings: Fit = Fit(), vocabulary_path: str = VOCABULARY) -> Model:
    """Fits on the documents of each language whose ids have the smallest hashes, held-out ones left out."""
    # docs_a_language rows a language: bounded by the number of languages. Rows that repeat an id in a language are one sample.
    sample = stored(sample_ids(docs, settings))
    pieces = (
        docs.select("doc_id", "lang", "text").join(sample, ["doc_id", "lang"])
        .groupBy("doc_id", "lang").agg(F.min(spread_pieces(F.coalesce("text", F.lit("")), settings.pieces, settings.chars)).alias("pieces"))
    )
    return fit(sorted((r["lang"], r["pieces"]) for r in pieces.collect()), vocabulary(vocabulary_path), settings)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language, all alike beforehand, and its probability."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.value
        own, at, logs = Pieces(model.pieces), {}, np.empty((0, len(model.languages)))
        for texts in series:
            rows = []
            for part in slices(texts, 1 << 22):
                found = [words((t or "").lower()) for t in part]
                if len(at) > REMEMBERED:
                    at, logs = {}, logs[:0]
                new = sorted(set().union(*found).difference(at))
                at.update(zip(new, range(len(logs), len(logs) + len(new))))
                logs = np.concatenate([logs, model.fill(own, new, np.empty((len(new), len(model.languages))))])
                rows += [verdict(logs[[at[w] for w in of_text]].sum(axis=0) if of_text else None, model.languages) for of_text in found]
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return docs.select("doc_id", F.pandas_udf(run, "lang_pred string, score double")("text").alias("r")).select("doc_id", "r.*")


def verdict(logs: np.ndarray | None, languages: list[str]) -> tuple[str, float]:
    if logs is None or not languages:
        return "und", 0.0
    best = int(logs.argmax())
    return languages[best], float(1 / np.exp(logs - logs[best]).sum())


def language_of(docs: DataFrame, settings: Fit = Fit(), vocabulary_path: str = VOCABULARY) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row of docs (doc_id, text, lang).

    Text that is null or has no letter (numerals are none, whatever their form) is ``und`` with score 0, as
    is all text where no language can be learned. Of equally likely languages the first by name counts.
    Repeated rows give repeated results; rows without an id are predicted but not learned from. No rows: no
    rows. Other columns are ignored.
    """
    model = learn(docs.select("doc_id", "text", "lang"), settings, vocabulary_path)
    return predicted(docs.select("doc_id", "text"), model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
