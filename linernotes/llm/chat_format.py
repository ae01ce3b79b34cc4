"""Conversations as training examples: one text, its tokens, and a mask of what is learned.

A conversation is rendered whole, noting where each turn's text begins and ends, and encoded once with
the places of its tokens. The turns' spans and the tokens' are both sorted, so binary search finds the
tokens of each span. Control strings are tokens of their own on both sides of a text, so no token reaches
over the end of a span.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linernotes.llm.common import read_bounded

#: A byte-level vocabulary in the format of the tokenizers library: it can spell any text.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: The role whose texts are learned.
LEARNED = "assistant"
TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.DOTALL)

FORMATTED = "formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"


def escaped(text: str) -> str:
    """``text`` without control strings: one more backslash between < and |."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text of a conversation, and (start, end, role) of each turn's text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escaped(role) + SEP, escaped(text)
        parts += [head, body, END]
        spans.append((at + len(head), at + len(head) + len(body), role))
        at = spans[-1][1] + len(END)
    return "".join(parts), spans


def mask_of(starts: np.ndarray, spans: list[tuple[int, int, str]]) -> np.ndarray:
    """Which tokens, by their sorted starts, lie in a span that is learned."""
    mask = np.zeros(len(starts), bool)
    wanted = np.array([(s, e) for s, e, role in spans if role == LEARNED], dtype=np.int64).reshape(-1, 2)
    for lo, hi in np.searchsorted(starts, wanted):
        mask[lo:hi] = True
    return mask


def read_back(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> tuple[list[tuple[str, str]], list[str]]:
    """From an example: its turns, and each stretch of text under the mask."""
    turns = [(unescaped(role), unescaped(text)) for role, text in TURN.findall(formatted)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(mask, dtype=np.int8), [0]])))
    learned = [unescaped(formatted[starts[lo] : ends[hi - 1]]) for lo, hi in edges.reshape(-1, 2)]
    return turns, learned


def encoder(data: bytes):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(data.decode())
    made.add_special_tokens([START, SEP, END])
    return made


#: Characters of the conversations that a task has as Python objects at a time.
SLICE = 1 << 18


def parts(chars: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """(first, number) of rows of about ``size`` characters together, as a batch has up to 10 000 rows of any length."""
    sums, at = np.asarray(chars).cumsum(), 0
    while at < len(sums):
        before = sums[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sums, before + size, "right")))
        yield at, to - at
        at = to


def example(turns: Column, tokenizer: str = TOKENIZER) -> Column:
    """The example of an array of (turn, role, text), as a struct of FORMATTED."""
    data = read_bounded(tokenizer)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encode = encoder(data).encode
        for part in (batch.slice(*p) for batch, chars in batches for p in parts(chars)):
            columns: list[list] = [[], [], [], [], []]
            for conversation in part:
                text, spans = rendered([(t["role"] or "", t["text"] or "") for t in conversation.as_py()])
                found = encode(text, add_special_tokens=False)
                places = np.array(found.offsets, dtype=np.int32).reshape(-1, 2)
                row = text, np.array(found.ids, dtype=np.int32), places[:, 0].copy(), places[:, 1].copy(), mask_of(places[:, 0], spans)
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.StructArray.from_arrays(arrays, ["formatted", "token_ids", "token_starts", "token_ends", "loss_mask"])

    chars = F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + F.coalesce(F.length(t["text"]), F.lit(0)) + 50)
    return F.arrow_udf(run, FORMATTED)(turns, chars)


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's rows by turn; rows without an id are a conversation each."""
    turn = F.struct("turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    narrow = rows.select("conv_id", turn.alias("t"))
    whole = narrow.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return whole.unionByName(narrow.filter("conv_id IS NULL").select("conv_id", F.array("t").alias("turns")))


def formatted(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(conv_id, formatted, token_ids, token_starts, token_ends, loss_mask) of each conversation.

    rows hold conv_id, turn, role and text. Null text and roles are empty; an empty text has no token. Rows
    of one turn, repeated ones too, follow by role and text; a null turn comes first. Rows without conv_id
    are a conversation each. Control strings in texts and roles are escaped and come back as they were.
    No rows: no rows. Other columns are ignored. A conversation is one example and so one row, however
    long: memory follows the longest.
    """
    made = conversations_of(rows).select("conv_id", example(F.col("turns"), tokenizer).alias("e"))
    return made.select("conv_id", "e.*")


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(made: DataFrame) -> DataFrame:
    """conv_id and DIGESTS of examples, read back from their text, tokens' places and mask."""

    @F.arrow_udf(DIGESTS)
    def read(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for *columns, chars in batches:
            for part in parts(chars):
                rows = []
                for text, *places in zip(*[c.slice(*part) for c in columns]):
                    text, places = text.as_py(), [p.values.to_numpy(zero_copy_only=False) for p in places]
                    turns, learned = read_back(text, *places)
                    said = "".join(f"{role}\n{words}\n" for role, words in turns)
                    loss = "".join(learned)
                    rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return made.select("conv_id", read("formatted", "token_starts", "token_ends", "loss_mask", F.length("formatted")).alias("d")).select("conv_id", "d.*")
