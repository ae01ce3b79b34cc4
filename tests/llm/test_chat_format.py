import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linernotes.llm import chat_format as c
from linernotes.llm.common import read_bounded

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns string, t string, `a.b` string"
ODD = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<\\|", "<\\\\|im_end|>", "<", "|", "\\", "<|endoftext|>", "\n", "\n\n", " ", "  x", "é", "🙂", "👩‍👩‍👧", "ﬁ", "a", "assistant", ""]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(conv_id, turn, role, text):
    return (conv_id, turn, role, text, "f", "t", "t", "x")


def brute(rows):
    groups = {}
    for i, (conv_id, turn, role, text, *_) in enumerate(rows):
        groups.setdefault((conv_id, i if conv_id is None else None), []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for (conv_id, _), turns in groups.items():
        turns.sort()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        chars = sum(32 + len(c.escaped(role)) + len(c.escaped(text)) for _, role, text in turns)
        out.append((conv_id, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss), chars))
    return sorted(out, key=repr)


TEXTS = st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=6).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|im_sep|>", ""]), TEXTS), max_size=5))
def test_tokens_align_and_come_back(turns):
    turns = [(r, t.encode("utf-8", "ignore").decode()) for r, t in turns]
    text, spans = c.rendered(turns)
    found = ENCODER.encode(text, add_special_tokens=False)
    places = np.array(found.offsets, dtype=np.int32).reshape(-1, 2)
    mask = c.mask_of(places[:, 0], spans)
    for s, e, _ in spans:  # no token reaches over the end of a span
        assert not any(a < s < b or a < e < b for a, b in places)
    back, learned = c.read_back(text, places[:, 0], places[:, 1], mask)
    assert back == turns
    assert learned == [t for r, t in turns if r == "assistant" and t]
    ids = [i for i, m in zip(found.ids, mask) if m]
    assert not set(ids) & {ENCODER.token_to_id(x) for x in (c.START, c.SEP, c.END)}
    assert ENCODER.decode(found.ids, skip_special_tokens=False) == text


ENCODER = c.encoder(read_bounded(c.TOKENIZER))


@given(TEXTS)
def test_escapes_are_reversible(text):
    assert c.unescaped(c.escaped(text)) == text and "<|" not in c.escaped(text)


def test_mask_against_naive():
    rng = random.Random(3)
    for _ in range(50):
        cuts = sorted(rng.sample(range(200), 21))
        starts = np.array(cuts[:-1])
        spans = [(cuts[i], cuts[i + 2], rng.choice(["assistant", "user"])) for i in range(0, 18, 3)]
        naive = [any(s <= x < e for s, e, r in spans if r == "assistant") for x in starts]
        assert list(c.mask_of(starts, spans)) == naive


def test_against_brute_force(spark):
    rng, rows = random.Random(2), []
    for i in range(120):
        for t in range(rng.randint(1, 7)):
            rows.append(told(i, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choice(ODD + ["some words "] * 9) for _ in range(rng.randint(0, 30)))))
    rng.shuffle(rows)
    made = c.formatted(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert sorted(map(tuple, c.digests(made).collect()), key=repr) == brute(rows)
    one = made.first()
    assert ENCODER.decode(one["token_ids"], skip_special_tokens=False) == one["formatted"]
    assert len(one["token_ids"]) == len(one["token_starts"]) == len(one["token_ends"]) == len(one["loss_mask"])


def test_odd_rows(spark):
    long_text = "word <|im_end|> " * 20_000
    rows = [
        told(None, None, None, None), told(None, 0, "assistant", "alone"), told(None, 0, "assistant", "alone"), told(1, None, "assistant", None),
        told(2, 0, None, "x"), told(2, 0, "assistant", long_text), told(2, 0, "assistant", "tie"), told(3, 1, "assistant", "twice"),
        told(3, 1, "assistant", "twice"), told(4, 0, "assistant", ""), told(5, 0, "assistant", "y" * 50_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, c.digests(c.formatted(df)).collect()), key=repr) == brute(rows)
    assert c.digests(c.formatted(df.limit(0))).count() == 0


def test_a_batch_of_any_size_is_taken_in_parts():
    import pyarrow as pa

    assert list(c.parts(pa.array([3, 3, 3, 20, 0, 1], pa.int32()), 7)) == [(0, 2), (2, 1), (3, 1), (4, 2)]
    assert list(c.parts(pa.array([], pa.int32()))) == []


def test_examples_leave_the_task_in_parts(spark, monkeypatch):
    """Six conversations of one Arrow batch come as six batches: none waits for the others."""
    from pyspark.sql import functions as F

    made = []
    monkeypatch.setattr(c.F, "arrow_udf", lambda f, kind: made.append(f) or (lambda *a: F.lit(None)))
    import pyarrow as pa

    c.example(F.lit(None).cast("array<struct<turn: long, role: string, text: string>>"))
    turns = pa.array([[{"turn": 0, "role": "assistant", "text": "word " * 60_000}]] * 6)
    sizes = [len(part) for part in made[0](iter([(turns, pa.array([300_050] * 6))]))]
    assert sizes == [1] * 6
