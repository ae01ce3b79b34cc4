import math
import random
import re
from collections import Counter

import sentencepiece

from linernotes.llm.common import VOCABULARY, read_bounded
from linernotes.llm.fertility import BLOCK, STEPS, Bands, Fertility, profile, quality_rules
from tests.llm.conftest import SCHEMA, prose, row

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def brute_measures(text, model):
    words = WORD.findall(text or "")
    ids = [t for w in words for t in model.encode(w)]
    if not ids:
        return 0.0, 0.0, 0.0
    blocks = [ids[i : i + BLOCK] for i in range(0, len(ids) - BLOCK + 1, BLOCK)] or [ids]
    if len(ids) > BLOCK and len(ids) % BLOCK:
        blocks.append(ids[-BLOCK:])
    entropy = lambda b: -sum(c / len(b) * math.log(c / len(b)) for c in Counter(b).values()) / math.log(len(b)) if len(b) > 1 else 1.0
    return sum(map(len, words)) / len(ids), sum(map(model.is_byte, ids)) / len(ids), sum(map(entropy, blocks)) / len(blocks)


def test_profile_against_brute_force():
    rng = random.Random(1)
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    fertility = Fertility(read_bounded(VOCABULARY))
    texts = [None, "", " \n ", "one", "a a a a", "a b a b a", "É\n\né\nÉ \nÉ", "🙂 ### | <x> 日本 \x0b\x0c\r", prose(rng, 500), prose(rng, 40) + "\n" + prose(rng, 40)]
    texts += ["\n".join(rng.choice(["same line", "other line", " ", prose(rng, 8)]) for _ in range(30)) for _ in range(20)]
    for text in texts:
        data = None if text is None else text.encode()
        fertility.learn(set((data or b"").split()))
        got = profile(data, fertility)
        assert got[:5] == brute_counts(text)
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[5:], brute_measures(text, model)))


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(2)
    good = [row(i, prose(rng, 120)) for i in range(200)]
    junk = [row(1000 + i, "### " + prose(rng, 120).replace(" ", " ### ")) for i in range(20)]
    foreign = [row(2000, "日本語" * 60 + " 漢字 " * 60), row(2001, "short")]
    got = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(good + junk + foreign, SCHEMA)).collect()}
    assert sum(got[r[0]]["kept"] for r in good) >= 196
    assert not any(got[r[0]]["kept"] for r in junk) and not got[2000]["kept"]
    assert got[2001]["base_failed"] and not got[2001]["kept"]


def test_rare_languages_are_held_to_the_bands_of_all(spark):
    rng = random.Random(3)
    docs = [row(i, prose(rng, 120)) for i in range(100)] + [row(500, prose(rng, 120), "xx"), row(501, prose(rng, 120), None)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules(spark.createDataFrame(docs, SCHEMA), Bands(min_docs=50)).collect()}
    assert got[500] and got[501]


def brute_kept(docs, settings, model):
    """(base_failed, kept) of each (doc_id, text, lang), bands by sorting every passing document's measures."""
    seen = {}
    for i, text, lang in docs:
        n, _, _, _, repeated = brute_counts(text)
        failed = n < settings.min_words or 100 * repeated > settings.max_repeat_percent * n
        seen[i] = failed, lang, brute_measures(text, model)

    def band(measures):
        sides = []
        for m in range(3):
            steps = sorted(math.floor(x[m] * STEPS + 0.5) for x in measures)
            q1, q3 = (steps[max(0, math.ceil(len(steps) * q) - 1)] / STEPS for q in (0.25, 0.75))
            unit = max(q3 - q1, settings.least[m])
            sides.append((q1 - settings.below[m] * unit, q3 + settings.above[m] * unit))
        return sides

    passing = {}
    for failed, lang, measures in seen.values():
        if not failed:
            passing.setdefault(lang, []).append(measures)
    general = band([m for of_lang in passing.values() for m in of_lang])
    own = {lang: band(ms) for lang, ms in passing.items() if len(ms) >= settings.min_docs}
    return {
        i: (failed, not failed and all(low <= x <= high for x, (low, high) in zip(m, own.get(lang, general))))
        for i, (failed, lang, m) in seen.items()
    }


def test_bands_and_verdicts_against_brute_force(spark):
    rng = random.Random(7)
    letters = "абвгдежзиклмнопрстуфхцчшщ"
    docs = []
    for i in range(260):
        lang = ["en", "en", "ru", "de", "xx"][i % 5] if i < 250 else "rare"
        if lang == "ru":
            text = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(40, 130)))
        else:
            text = prose(rng, rng.randint(40, 160))
        if rng.random() < 0.2:  # of odd measures, more or less of them
            words = text.split()
            for _ in range(rng.randint(1, 120)):
                words.insert(rng.randrange(len(words)), rng.choice(["###", "日本語漢字", "🙂🙂", "qzxj%kw", "aaaaaaaaaaaaaaaa"]))
            text = " ".join(words)
        if rng.random() < 0.05:
            text = " ".join(["same three words"] * 40)
        docs.append((i, text, lang))
    df = spark.createDataFrame([row(i, t, lang) for i, t, lang in docs], SCHEMA).repartition(4)
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    tight = Bands(below=(0.7, 1.0, 0.8), above=(0.9, 1.0, 0.6), min_docs=30)
    for settings in (Bands(), tight):
        got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules(df, settings).collect()}
        want = brute_kept(docs, settings, model)
        assert got == want
    assert 20 < sum(k for _, k in want.values()) < 220


def test_odd_rows(odd_docs, no_docs):
    got = quality_rules(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r["kept"] is not None and not (r["base_failed"] and r["kept"]) for r in got)
    assert quality_rules(no_docs).count() == 0
