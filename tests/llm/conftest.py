import random

import pytest

#: doc_id, text, lang, source, n_chars and columns whose names the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, key string, shard string, "
    "band string, words string, position string, fp string, h string, region string, block string"
)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 1.0, "k", "s", "b", "w", "p", "f", "h", "r", "x")


def prose(rng, n, vocabulary=400):
    words = [f"{a}{b}" for a in ("ba", "ko", "ri", "tu", "se", "mo", "li", "na") for b in ("ran", "tel", "mis", "dor", "ve", "lo", "pint")]
    return " ".join(rng.choice(words[:vocabulary]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a long one, repeated rows, equal texts, letters of several scripts."""
    rng = random.Random(5)
    long_text = prose(rng, 30_000)
    texts = [None, "", " \n\t\x0b ", "one", "Ä Ö", "\n\n\n", long_text, long_text, "привет мир как дела", "x" * 5000, "🙂 🙂 🙂 🙂"]
    rows = [row(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "a") for i, t in enumerate(texts)]
    rows += [rows[6], row(None, long_text), row(None, None), row(None, None, None, None), row(0, "another text of id 0")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
