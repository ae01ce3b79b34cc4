"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton finds every piece of the vocabulary that ends at a letter; the best score up
to each letter carries the number of pieces on its path. Ties go as in the tokenizer: of equal scores
the path whose last piece starts first stays, that is the longest piece.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linernotes.llm.common import VOCABULARY, read_bounded

SPACE = "▁"
#: What an uncovered letter costs below the worst piece, a constant of the tokenizer.
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000
PARTS = re.compile(f"{SPACE}[^{SPACE}]*")


def zipf_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) of a public vocabulary in its order, most frequent first.

    The public file ranks its pieces but gives no probabilities; by Zipf's rule that of rank r is in
    proportion to 1 / (r + 1).
    """
    model = sentencepiece.SentencePieceProcessor(model_proto=read_bounded(path))
    return [(model.id_to_piece(i), -math.log(i + 1)) for i in range(model.get_piece_size())]


class Counting:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        names = {p for p, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.known: dict[str, tuple[int, float]] = {}

    def part(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path through a text that starts with the space mark."""
        n = len(text)
        best, pieces, loose = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0  # letters whose best path is settled

        def uncovered(end: int, top: float | None) -> None:
            """The letter before end as an unknown: bytes, or part of a run that is one piece."""
            score = best[end - 1] + self.unknown
            if top is None or score > top:
                best[end], loose[end] = score, True
                pieces[end] = pieces[end - 1] + (len(text[end - 1].encode()) if self.bytes else not loose[end - 1])

        top: float | None = None
        single = False
        for last, (length, score) in self.automaton.iter(text):
            end = last + 1
            while done + 1 < end:  # letters at which this one's predecessors end
                if not single:
                    uncovered(done + 1, top)
                done, top, single = done + 1, None, False
            candidate = best[end - length] + score
            if top is None or candidate > top:
                top = best[end] = candidate
                pieces[end], loose[end] = pieces[end - length] + 1, False
            single = single or length == 1
        while done < n:
            if not single:
                uncovered(done + 1, top)
            done, top, single = done + 1, None, False
        return pieces[n], best[n]

    def word(self, word: str) -> tuple[int, float]:
        if (found := self.known.get(word)) is None:
            marked = word if word.startswith(SPACE) else SPACE + word
            parts = [self.part(p) for p in PARTS.findall(marked)]
            found = sum(p[0] for p in parts), math.fsum(p[1] for p in parts)
            if len(word) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = found
        return found

    def text(self, data: bytes | None) -> tuple[int, int, float]:
        """(words, pieces, score) of a whole text's bytes."""
        words = (data or b"").split()
        found = [self.word(w.decode()) for w in words]
        return len(words), sum(f[0] for f in found), math.fsum(f[1] for f in found)


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]] | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens, score) of each row: pieces of the best segmentation of all words.

    Words are parted by ASCII white space, which makes no tokens. Null and empty texts have 0 of all.
    Repeated rows and rows without an id are counted like others.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary or zipf_vocabulary())

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counting = Counting(sent.value)
        for texts in series:
            yield pd.DataFrame([counting.text(t) for t in texts], columns=["n_words", "n_tokens", "score"])

    counted = F.pandas_udf(run, "n_words long, n_tokens long, score double")
    return docs.select("doc_id", counted(F.col("text").cast("binary")).alias("r")).select("doc_id", "r.*")
